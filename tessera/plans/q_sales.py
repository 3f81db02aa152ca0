"""Dimension datasets and sales summaries by product and by day; order items as
JSON arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.json import ITEMS_SCHEMA
from tessera.plans import domain
from tessera.plans.catalog import query
from tessera.sources import load


@query("dim_categories", "D1", sql="SELECT p_type AS name, count(*) AS n_items FROM part GROUP BY p_type")
def dim_categories(spark, sf_dir):
    return domain.items(spark, sf_dir).groupBy(F.col("category").alias("name")).agg(F.count(F.lit(1)).alias("n_items"))


@query("dim_locations", "D4",
       sql="""SELECT n_nationkey AS id, n_name AS city, CAST(10.0 AS DOUBLE) + n_nationkey * CAST(2.0 AS DOUBLE) AS lat,
       CAST(-120.0 AS DOUBLE) + n_nationkey * CAST(3.0 AS DOUBLE) AS lon FROM nation""")
def dim_locations(spark, sf_dir):
    return domain.locations(spark, sf_dir)


_REVENUE = "l_extendedprice * (1 - l_discount)"


@query("sales_by_product", "D19 J2 A2",
       sql=f"""WITH s AS (SELECT l_partkey, count(DISTINCT l_orderkey) AS orders, sum(l_quantity) AS quantity, sum({_REVENUE}) AS revenue
       FROM lineitem GROUP BY l_partkey)
       SELECT s.l_partkey AS product_id, p.p_name AS product, orders, quantity, revenue FROM s LEFT JOIN part p ON s.l_partkey = p.p_partkey""")
def sales_by_product(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    sums = li.groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.countDistinct("l_orderkey").alias("orders"), F.sum("l_quantity").alias("quantity"), F.sum(F.expr(_REVENUE)).alias("revenue"))
    names = domain.items(spark, sf_dir).select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    return sums.join(names, "product_id", "left").select("product_id", "product", "orders", "quantity", "revenue")


@query("sales_by_date", "D19 A8",
       sql="""SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders, count(DISTINCT o_custkey) AS customers, sum(o_totalprice) AS revenue
       FROM orders GROUP BY 1""")
def sales_by_date(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("o_custkey").alias("customers"), F.sum("o_totalprice").alias("revenue"))


@query("items_exploded", "F16 F11 F9",
       sql="SELECT l_orderkey AS order_id, l_linenumber AS pos, l_partkey AS item_id, l_extendedprice AS price, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem")
def items_exploded(spark, sf_dir):
    """Each order's items as one JSON array, parsed and exploded again."""
    item = F.struct(F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("item_id"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("int").alias("quantity"))
    body = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list(item)).alias("items"))
    schema = ITEMS_SCHEMA.simpleString().replace("struct<", "struct<pos:int,")
    rows = body.select(F.col("l_orderkey").alias("order_id"), F.explode(F.from_json("items", schema)).alias("i"))
    return rows.select("order_id", "i.pos", "i.item_id", "i.price", "i.quantity")
