"""The order-event domain, derived by Spark from the provided tables.

* locations  = ``nation`` (id, city) with rule-based coordinates
* brands     = distinct ``part.p_brand`` (id from the number after ``#``)
* customers/orders/items = ``customer``/``orders``/``lineitem``
* order event log = every order expanded into its lifecycle (G2) with
  driver pings (G3); offsets come from md5 of the order key, so the log is
  deterministic, re-computable after executor loss, and has a SQL oracle.

The log grows linearly with ``orders``: one explode per order, no joins
between events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.constants import EVENT_TYPES, VEHICLE_TYPES
from tessera.functions.geo import distance_km
from tessera.functions.hashing import uhash
from tessera.sources import load

# --- fixed values: lifecycle timing rule (seconds) -------------------------
# stage gap = base + uhash(order, salt) % span
T_ORDER_IN_DAY = ("t0", 0, 86400)
T_TO_KITCHEN = ("ks", 60, 121)
T_PREP = ("kp", 300, 1201)
T_PACKAGING = 30
T_DRIVER_WAIT = ("dw", 60, 481)
T_PICKUP = ("pu", 30, 91)
T_DELIVERY = ("dl", 300, 2101)
N_PINGS = "(d_dl - 1) div 60"  # one for each minute of the delivery, none at its end


def _gap(key: Column, rule) -> Column:
    salt, base, span = rule
    return F.lit(base) + uhash(key, salt) % F.lit(span)


def _created_at(key: Column) -> Column:
    return F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + _gap(key, T_ORDER_IN_DAY)


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id, city, lat, lon (kitchen at the city centre)."""
    n = load(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("city"),
        (F.lit(10.0) + F.col("n_nationkey") * F.lit(2.0)).alias("lat"),
        (F.lit(-120.0) + F.col("n_nationkey") * F.lit(3.0)).alias("lon"),
    )


def brand_id_of(p_brand: Column) -> Column:
    return F.substring_index(p_brand, "#", -1).try_cast("int")


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id, name, momentum, avg_prep_time_mins (one row per brand)."""
    p = load(spark, sf_dir, "part")
    b = p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_items"))
    bid = brand_id_of(F.col("p_brand"))
    return b.select(
        bid.alias("id"),
        F.col("p_brand").alias("name"),
        F.element_at(F.array(F.lit("stable"), F.lit("growing"), F.lit("declining")),
                     (bid % 3 + 1).cast("int")).alias("momentum"),
        (F.lit(10) + bid % 11).alias("avg_prep_time_mins"),
        "n_items",
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: item per part with its brand and category (p_type)."""
    p = load(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        brand_id_of(F.col("p_brand")).alias("brand_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("category"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: key, time, total, location and brand.

    brand = brand of the order's first line item (lowest line number, ties
    broken by part key); orders without items get a NULL brand.
    """
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("location_id"))
    li = load(spark, sf_dir, "lineitem")
    first = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min_by("l_partkey", F.col("l_linenumber").cast("long") * F.lit(10**12) + F.col("l_partkey"))
        .alias("first_partkey"))
    part = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("first_partkey"), brand_id_of(F.col("p_brand")).alias("brand_id"))
    loc = locations(spark, sf_dir).select(
        F.col("id").alias("location_id"), F.col("lat").alias("kitchen_lat"), F.col("lon").alias("kitchen_lon"))
    return (o.join(first, "o_orderkey", "left")
             .join(part, "first_partkey", "left")
             .join(c, "o_custkey", "left")
             .join(loc, "location_id", "left")
             .select("o_orderkey", "o_orderdate", "o_totalprice", "location_id", "brand_id", "kitchen_lat", "kitchen_lon"))


def _iso_seconds(secs: Column) -> Column:
    """ISO-8601 text (whole seconds) from epoch seconds; the session zone is
    UTC (tessera.session), so this is the UTC wall clock."""
    return F.date_format(F.timestamp_seconds(secs), "yyyy-MM-dd'T'HH:mm:ss")


def _json(fields: list[tuple[str, Column]]) -> Column:
    """Flat JSON object text from typed columns, built with ``concat``.

    Produces the same text as ``to_json`` with NULL fields kept (numbers in
    Java's shortest form, strings quoted) but without a JSON generator per
    row. Only for the generated bodies: their strings never need escaping.
    """
    parts = []
    for i, (k, v) in enumerate(fields):
        parts.append(F.lit(("{" if i == 0 else ",") + f'"{k}":'))
        parts.append(F.coalesce(_json_value(v), F.lit("null")))
    parts.append(F.lit("}"))
    return F.concat(*parts)


def _json_value(v: Column) -> Column:
    return v.cast("string")


def _json_str(v: Column) -> Column:
    return F.concat(F.lit('"'), v, F.lit('"'))


def order_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 + G3: the bronze order event stream.

    event_id, event_type, ts (ISO text), ts_seconds, location_id, order_id,
    sequence, body (JSON text).
    """
    return events_of(order_headers(spark, sf_dir))


#: Seconds of a cell of event time; below all cells, those of events without a time.
CELL = 1800
TIMELESS = -(1 << 40)


def in_cells(h: DataFrame) -> DataFrame:
    """Order headers, one copy for each cell of time in which an order has events (two
    or three), named by the column ``cell``. Without a time each event has its own cell."""
    k = F.col("o_orderkey")
    before = sum((_gap(k, rule) for rule in (T_TO_KITCHEN, T_PREP, T_DRIVER_WAIT, T_PICKUP)), F.lit(T_PACKAGING))
    timed = h.select("*", _created_at(k).alias("first"), before.alias("o_pu"), _gap(k, T_DELIVERY).alias("d_dl"))
    last = F.col("first") + F.col("o_pu") + F.col("d_dl")
    cells = F.when(F.col("first").isNull(), F.sequence(F.lit(TIMELESS), F.expr(N_PINGS) + 6 + TIMELESS)).otherwise(
        F.sequence(F.floor(F.col("first") / CELL), F.floor(last / CELL)))
    return timed.select(*h.columns, F.explode(cells).alias("cell"))


def events_of(h: DataFrame) -> DataFrame:
    """The events of order headers (``order_headers``): a narrow pass. Of a copy of a
    header for a cell (``in_cells``) the events of that cell."""
    k = F.col("o_orderkey")
    t0 = _created_at(k)
    own = ["cell"] if "cell" in h.columns else []
    h = h.select(
        *own, "o_orderkey", "location_id", "brand_id", "o_totalprice", "kitchen_lat", "kitchen_lon",
        t0.alias("t0"),
        _gap(k, T_TO_KITCHEN).alias("d_ks"), _gap(k, T_PREP).alias("d_kp"),
        _gap(k, T_DRIVER_WAIT).alias("d_dw"), _gap(k, T_PICKUP).alias("d_pu"),
        _gap(k, T_DELIVERY).alias("d_dl"),
        ((uhash(k, "la") % 20001 - 10000) / F.lit(100000.0)).alias("j_lat"),
        ((uhash(k, "lo") % 20001 - 10000) / F.lit(100000.0)).alias("j_lon"),
        (F.lit(1) + uhash(k, "dr") % 500).alias("driver_no"),
        (uhash(k, "vt") % 3 + 1).cast("int").alias("vehicle_no"),
        (F.lit(-3) + uhash(k, "ep") % 9).alias("prep_adj"),
    )
    c = F.col
    cust_lat, cust_lon = c("kitchen_lat") + c("j_lat"), c("kitchen_lon") + c("j_lon")
    n_pings = F.expr(N_PINGS)
    # Cumulative stage offsets (seconds after creation), lifecycle order.
    o_ks = c("d_ks")
    o_kf = o_ks + c("d_kp")
    o_rd = o_kf + F.lit(30)
    o_da = o_rd + c("d_dw")
    o_pu = o_da + c("d_pu")
    o_dl = o_pu + c("d_dl")
    h = h.select("*", n_pings.alias("n_pings"), o_pu.alias("o_pu"), o_dl.alias("o_dl"), cust_lat.alias("cust_lat"), cust_lon.alias("cust_lon"),
                 F.array(F.lit(0).cast("long"), o_ks, o_kf, o_rd, o_da, o_pu, o_dl).alias("stage_offsets"))

    def tenths(num: Column, den) -> Column:
        # round(num / den, 1), half-up, with integer arithmetic only
        return F.floor((num * 20 + den) / (den * 2)) / F.lit(10.0)

    # What an order's seven stages say is made once an order, in lifecycle order: made
    # after the explode, the code for a row outgrows what the JVM compiles (8000 bytes).
    stage_bodies = F.array(
        _json([
            ("customer_lat", c("cust_lat")), ("customer_lon", c("cust_lon")),
            ("brand_id", c("brand_id")), ("total", c("o_totalprice"))]),
        _json([
            ("kitchen_id", _json_str(F.concat(F.lit("K"), F.lpad(c("location_id").cast("string"), 2, "0")))),
            ("estimated_prep_mins", (F.lit(10) + F.coalesce(c("brand_id"), F.lit(0)) % 11 + c("prep_adj")).cast("int"))]),
        _json([("actual_prep_mins", tenths(c("d_kp"), F.lit(60)))]),
        _json([("pickup_lat", c("kitchen_lat")), ("pickup_lon", c("kitchen_lon"))]),
        _json([
            ("driver_id", _json_str(F.concat(F.lit("D"), F.lpad(c("driver_no").cast("string"), 4, "0")))),
            ("vehicle_type", _json_str(F.element_at(F.array(*[F.lit(v) for v in VEHICLE_TYPES]), c("vehicle_no"))))]),
        _json([
            ("route_distance_km", distance_km(c("kitchen_lat"), c("kitchen_lon"), c("cust_lat"), c("cust_lon")))]),
        _json([
            ("delivery_lat", c("cust_lat")), ("delivery_lon", c("cust_lon")),
            ("total_mins", tenths(c("o_dl"), F.lit(60)))]),
    )
    h = h.select("*", stage_bodies.alias("stage_bodies"))

    # One generator row per event (sequence 0 .. 6 + n_pings); everything
    # after the explode is a plain projection, so it stays in codegen.
    ev = h.select("*", F.explode(F.sequence(F.lit(0), c("n_pings") + 6)).alias("seq"))
    seq = c("seq")
    last = c("n_pings") + 6
    # number of the stage; NULL for a ping, whose number is i (6 <= seq < last)
    stage = F.when(seq == last, F.lit(6)).when(seq < 6, seq.cast("int"))
    ev = ev.withColumn("stage", stage)
    stage, i = c("stage"), seq - 5
    progress = (i * 60) / c("d_dl")
    event_type = F.coalesce(F.get(F.array(*[F.lit(t) for t in EVENT_TYPES[:6]], F.lit("delivered")), stage), F.lit("driver_ping"))
    offset = F.when(stage.isNull(), c("o_pu") + i * 60).otherwise(F.get("stage_offsets", stage))
    ping = _json([
        ("lat", c("kitchen_lat") + (c("cust_lat") - c("kitchen_lat")) * progress),
        ("lon", c("kitchen_lon") + (c("cust_lon") - c("kitchen_lon")) * progress),
        ("progress_pct", tenths(i * 6000, c("d_dl")))])
    body = F.when(stage.isNull(), ping).otherwise(F.get("stage_bodies", stage))
    secs = c("t0") + offset
    if own:
        ev = ev.where(c("cell") == F.coalesce(F.floor(secs / CELL), seq + TIMELESS))
    return ev.select(
        F.concat(c("o_orderkey").cast("string"), F.lit("-"), seq.cast("string")).alias("event_id"),
        event_type.alias("event_type"),
        _iso_seconds(secs).alias("ts"),
        secs.cast("long").alias("ts_seconds"),
        c("location_id").cast("int").alias("location_id"),
        c("o_orderkey").cast("string").alias("order_id"),
        seq.cast("int").alias("sequence"),
        body.alias("body"),
    )
