"""Change-log queries T1-T6, T9 over a deterministic history of ``orders``.

History rule (md5 of the order key): every order is inserted at a version
1-5; about 30 % are updated once at version 6-8 (price +100, status 'F');
about 10 % are deleted at version 9-10. Commit time = 2024-01-01 + version
days.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import sql_uhash, uhash
from tessera.operators import changes
from tessera.plans.catalog import query
from tessera.sources import load

KEYS = ["o_orderkey"]
EPOCH = "2024-01-01 00:00:00"


def orders_change_log(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    v_ins = F.lit(1) + uhash(k, "vi") % 5
    upd = uhash(k, "vu") % 10 < 3
    v_upd = F.lit(6) + uhash(k, "vv") % 3
    dele = uhash(k, "vd") % 10 == 9
    v_del = F.lit(9) + uhash(k, "vx") % 2
    ops = F.array(
        F.struct(F.lit("I").alias("op"), v_ins.alias("v")),
        F.when(upd, F.struct(F.lit("U").alias("op"), v_upd.alias("v"))),
        F.when(dele, F.struct(F.lit("D").alias("op"), v_del.alias("v"))))
    g = o.withColumn("_c", F.explode(F.filter(ops, lambda x: x.isNotNull())))
    after_update = F.col("_c.op") != "I"
    return g.select(
        "o_orderkey", "o_custkey",
        F.when(after_update & upd, F.lit("F")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(after_update & upd, F.col("o_totalprice") + F.lit(100.0)).otherwise(F.col("o_totalprice"))
         .alias("o_totalprice"),
        "o_orderdate", "o_orderpriority",
        F.col("_c.op").alias("_op"), F.col("_c.v").cast("int").alias("_version"),
        (F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.col("_c.v").cast("int"))).alias("_committed_at"))


_H = lambda s: sql_uhash("o_orderkey", s)
CHANGE_LOG_CTE = f"""
ch AS (
  SELECT *, {_H('vu')} % 10 < 3 AS upd, {_H('vd')} % 10 = 9 AS dele,
         1 + {_H('vi')} % 5 AS v_ins, 6 + {_H('vv')} % 3 AS v_upd, 9 + {_H('vx')} % 2 AS v_del FROM orders),
ops AS (
  SELECT *, 'I' AS op, v_ins AS v FROM ch
  UNION ALL SELECT *, 'U', v_upd FROM ch WHERE upd
  UNION ALL SELECT *, 'D', v_del FROM ch WHERE dele),
change_log AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN op <> 'I' AND upd THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN op <> 'I' AND upd THEN o_totalprice + CAST(100.0 AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority, op AS _op, CAST(v AS INTEGER) AS _version,
         TIMESTAMP '{EPOCH}' + to_days(CAST(v AS INTEGER)) AS _committed_at
  FROM ops)"""

_STATE_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, _version"


def _as_of_sql(where: str) -> str:
    return "WITH " + CHANGE_LOG_CTE + f""",
latest AS (SELECT o_orderkey, max(_version) AS mv FROM change_log WHERE {where} GROUP BY o_orderkey)
SELECT {', '.join('c.' + x.strip() for x in _STATE_COLS.split(','))}
FROM change_log c JOIN latest l ON c.o_orderkey = l.o_orderkey AND c._version = l.mv WHERE c._op <> 'D'"""


@query("change_log", "T6 G2", sql="WITH " + CHANGE_LOG_CTE + " SELECT * FROM change_log")
def change_log(spark, sf_dir):
    return orders_change_log(spark, sf_dir)


@query("as_of_version", "T4", sql=_as_of_sql("_version <= 7"))
def as_of_version(spark, sf_dir):
    return changes.as_of_version(orders_change_log(spark, sf_dir), KEYS, 7)


@query("as_of_version_after_deletes", "T4", sql=_as_of_sql("_version <= 10"))
def as_of_version_after_deletes(spark, sf_dir):
    return changes.as_of_version(orders_change_log(spark, sf_dir), KEYS, 10)


AS_OF_TS = "2024-01-10 12:00:00"  # after version 9, in which the first rows are deleted


@query("as_of_timestamp", "T5", sql=_as_of_sql(f"_committed_at <= TIMESTAMP '{AS_OF_TS}'"))
def as_of_timestamp(spark, sf_dir):
    return changes.as_of_timestamp(orders_change_log(spark, sf_dir), KEYS,
                                   F.lit(AS_OF_TS).cast("timestamp_ntz"))


@query("snapshot_log", "T6",
       sql="WITH " + CHANGE_LOG_CTE + """
SELECT _version, max(_committed_at) AS committed_at,
       count(*) FILTER (WHERE _op = 'I') AS inserted, count(*) FILTER (WHERE _op = 'U') AS updated,
       count(*) FILTER (WHERE _op = 'D') AS deleted,
       sum(count(*) FILTER (WHERE _op = 'I') - count(*) FILTER (WHERE _op = 'D')) OVER (ORDER BY _version) AS live_rows
FROM change_log GROUP BY _version""")
def snapshot_log(spark, sf_dir):
    return changes.snapshot_log(orders_change_log(spark, sf_dir))


EXPIRE_OLDER_THAN = "2024-01-05 00:00:00"


@query("expire_versions", "T9",
       sql="WITH " + CHANGE_LOG_CTE + f""",
vs AS (SELECT _version, max(_committed_at) AS c, row_number() OVER (ORDER BY _version DESC) AS rk
       FROM change_log GROUP BY _version),
fl AS (SELECT min(_version) AS fv FROM vs WHERE c >= TIMESTAMP '{EXPIRE_OLDER_THAN}' OR rk <= 5),
old AS (SELECT c.* FROM change_log c, fl WHERE c._version < fl.fv),
lo AS (SELECT o_orderkey, max(_version) AS mv FROM old GROUP BY o_orderkey)
SELECT c.* FROM change_log c, fl WHERE c._version >= fl.fv
UNION ALL
SELECT o.* FROM old o JOIN lo ON o.o_orderkey = lo.o_orderkey AND o._version = lo.mv WHERE o._op <> 'D'""")
def expire_versions(spark, sf_dir):
    return changes.expire_versions(orders_change_log(spark, sf_dir), KEYS,
                                   F.lit(EXPIRE_OLDER_THAN).cast("timestamp_ntz"), retain_last=5)


@query("update_where", "T1",
       sql="""SELECT o_orderkey, o_custkey,
       CASE WHEN coalesce(o_orderpriority = '1-URGENT' AND o_totalprice > 300000, false) THEN 'X' ELSE o_orderstatus END
         AS o_orderstatus,
       CASE WHEN coalesce(o_orderpriority = '1-URGENT' AND o_totalprice > 300000, false)
            THEN o_totalprice * CAST(0.9 AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders""")
def update_where(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    p = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300000)
    return changes.update_where(o, p, {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 0.9})


@query("delete_where", "T2", sql="SELECT * FROM orders WHERE NOT coalesce(o_orderstatus = 'P', false)")
def delete_where(spark, sf_dir):
    return changes.delete_where(load(spark, sf_dir, "orders"), F.col("o_orderstatus") == "P")


@query("schema_evolution", "T3 P5",
       sql="""SELECT o_orderkey, o_custkey, o_totalprice AS total_price, CAST(NULL AS DOUBLE) AS discount
       FROM orders WHERE coalesce(o_orderstatus = 'F', false)
       UNION ALL
       SELECT o_orderkey, o_custkey, o_totalprice AS total_price, CAST(0.05 AS DOUBLE) AS discount
       FROM orders WHERE NOT coalesce(o_orderstatus = 'F', false)""")
def schema_evolution(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    old = o.filter(first).select("o_orderkey", "o_custkey", "o_totalprice")
    new = (o.filter(~first)
            .withColumn("discount", F.lit(0.05))
            .drop("o_orderstatus", "o_orderdate", "o_orderpriority"))
    return changes.evolve(old, new, {"o_totalprice": "total_price"})
