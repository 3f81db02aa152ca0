"""DuckDB SQL text that recomputes our datasets from the same tables.

Used only to check results (the ``oracle_sql()`` contract and tests); the
engine work itself is the Spark code. Literals are cast to DOUBLE where the
Spark side uses doubles, since DuckDB reads ``5.0`` as DECIMAL.
"""

from __future__ import annotations

from tessera.functions.constants import EVENT_TYPES, VEHICLE_TYPES
from tessera.functions.hashing import sql_uhash


def _h(salt: str) -> str:
    return sql_uhash("o.o_orderkey", salt)


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _json(*pairs: tuple[str, str]) -> str:
    return "CAST(json_object(" + ", ".join(f"'{k}', {v}" for k, v in pairs) + ") AS VARCHAR)"


def _tenths(num: str, den: str) -> str:
    return f"(floor(({num} * 20 + {den}) / ({den} * 2)) / {_d(10.0)})"


STAGES6 = "[" + ", ".join(f"'{t}'" for t in EVENT_TYPES[:6]) + "]"
VEHICLES = "[" + ", ".join(f"'{v}'" for v in VEHICLE_TYPES) + "]"

# CTEs ending in ``order_log`` (same columns as domain.order_event_log).
ORDER_LOG_CTES = f"""
fi AS (
  SELECT l_orderkey, arg_min(l_partkey, CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey) AS first_partkey
  FROM lineitem GROUP BY l_orderkey),
hdr0 AS (
  SELECT o.o_orderkey, o.o_totalprice, c.c_nationkey AS location_id,
         TRY_CAST(regexp_extract(p.p_brand, '[^#]*$') AS INTEGER) AS brand_id,
         {_d(10.0)} + n.n_nationkey * {_d(2.0)} AS kitchen_lat,
         {_d(-120.0)} + n.n_nationkey * {_d(3.0)} AS kitchen_lon,
         CAST(epoch(o.o_orderdate) AS BIGINT) + {_h('t0')} % 86400 AS t0,
         60 + {_h('ks')} % 121 AS d_ks, 300 + {_h('kp')} % 1201 AS d_kp,
         60 + {_h('dw')} % 481 AS d_dw, 30 + {_h('pu')} % 91 AS d_pu, 300 + {_h('dl')} % 2101 AS d_dl,
         ({_h('la')} % 20001 - 10000) / {_d(100000.0)} AS j_lat,
         ({_h('lo')} % 20001 - 10000) / {_d(100000.0)} AS j_lon,
         1 + {_h('dr')} % 500 AS driver_no, CAST({_h('vt')} % 3 + 1 AS INTEGER) AS vehicle_no,
         -3 + {_h('ep')} % 9 AS prep_adj
  FROM orders o
  LEFT JOIN fi ON o.o_orderkey = fi.l_orderkey
  LEFT JOIN part p ON fi.first_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
hdr AS (
  SELECT *, (d_dl - 1) // 60 AS n_pings,
         d_ks + d_kp + 30 + d_dw + d_pu AS o_pu,
         d_ks + d_kp + 30 + d_dw + d_pu + d_dl AS o_dl,
         kitchen_lat + j_lat AS cust_lat, kitchen_lon + j_lon AS cust_lon
  FROM hdr0),
gen AS (
  SELECT *, unnest(generate_series(0, n_pings + 6)) AS seq FROM hdr),
ev AS (
  SELECT *, seq - 5 AS i, ((seq - 5) * 60) / d_dl AS progress,
         CASE WHEN seq = 0 THEN 0 WHEN seq = 1 THEN d_ks WHEN seq = 2 THEN d_ks + d_kp
              WHEN seq = 3 THEN d_ks + d_kp + 30 WHEN seq = 4 THEN d_ks + d_kp + 30 + d_dw
              WHEN seq = 5 THEN o_pu WHEN seq = n_pings + 6 THEN o_dl
              ELSE o_pu + (seq - 5) * 60 END AS off
  FROM gen),
order_log AS (
  SELECT CAST(o_orderkey AS VARCHAR) || '-' || CAST(seq AS VARCHAR) AS event_id,
         CASE WHEN seq = n_pings + 6 THEN 'delivered' WHEN seq >= 6 THEN 'driver_ping'
              ELSE {STAGES6}[seq + 1] END AS event_type,
         strftime(make_timestamp((t0 + off) * 1000000), '%Y-%m-%dT%H:%M:%S') AS ts,
         t0 + off AS ts_seconds,
         CAST(location_id AS INTEGER) AS location_id,
         CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(seq AS INTEGER) AS sequence,
         CASE
           WHEN seq = 0 THEN {_json(('customer_lat', 'cust_lat'), ('customer_lon', 'cust_lon'), ('brand_id', 'brand_id'), ('total', 'o_totalprice'))}
           WHEN seq = 1 THEN {_json(('kitchen_id', "'K' || lpad(CAST(location_id AS VARCHAR), 2, '0')"), ('estimated_prep_mins', 'CAST(10 + coalesce(brand_id, 0) % 11 + prep_adj AS INTEGER)'))}
           WHEN seq = 2 THEN {_json(('actual_prep_mins', _tenths('d_kp', '60')))}
           WHEN seq = 3 THEN {_json(('pickup_lat', 'kitchen_lat'), ('pickup_lon', 'kitchen_lon'))}
           WHEN seq = 4 THEN {_json(('driver_id', "'D' || lpad(CAST(driver_no AS VARCHAR), 4, '0')"), ('vehicle_type', f'{VEHICLES}[vehicle_no]'))}
           WHEN seq = 5 THEN {_json(('route_distance_km', f'sqrt((cust_lat - kitchen_lat) * (cust_lat - kitchen_lat) + (cust_lon - kitchen_lon) * (cust_lon - kitchen_lon)) * 111'))}
           WHEN seq = n_pings + 6 THEN {_json(('delivery_lat', 'cust_lat'), ('delivery_lon', 'cust_lon'), ('total_mins', _tenths('o_dl', '60')))}
           ELSE {_json(('lat', 'kitchen_lat + (cust_lat - kitchen_lat) * progress'), ('lon', 'kitchen_lon + (cust_lon - kitchen_lon) * progress'), ('progress_pct', _tenths('i * 6000', 'd_dl')))}
         END AS body
  FROM ev)
"""
