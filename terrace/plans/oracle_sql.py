"""Independent SQL (DuckDB dialect) for every catalogued query.

The stand-in views are inlined as CTEs over the driver's tables; each query
recomputes from them with plain SQL (window ``row_number`` for arg-max, a
``CASE`` for the null-preserving sum), so the check does not share code with
the Spark implementation.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .. import schemas
from .price_model import FEATURES

_SQL_TYPES = {
    T.StringType: "VARCHAR", T.LongType: "BIGINT", T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.IntegerType: "INTEGER",
    T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP",
}


def sql_type(dt: T.DataType) -> str:
    return _SQL_TYPES[type(dt)]


def S(x: str) -> str:
    """Null-preserving sum in SQL."""
    return (f"CASE WHEN count(*) = 1 THEN max({x}) "
            f"ELSE CAST(coalesce(sum({x}), 0) AS BIGINT) END")


GEO = """geo AS (
  SELECT n.n_nationkey, CAST(r.r_regionkey AS VARCHAR) AS district_id,
         lower(r.r_name) AS district, CAST(n.n_nationkey AS VARCHAR) AS neighborhood_id,
         replace(n.n_name, '_', ' ') AS neighborhood
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

LISTINGS = """listings AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS propertyCode, o.o_totalprice AS price,
         strftime(o.o_orderdate, '%Y_%m_%d') AS queryDate, o.o_orderpriority AS typology,
         o.o_orderstatus AS status, CAST(o.o_orderkey % 3 + 1 AS BIGINT) AS bathrooms,
         CAST(o.o_orderkey % 6 + 1 AS BIGINT) AS rooms,
         CAST(o.o_orderkey % 120 + 40 AS DOUBLE) AS size,
         CAST(o.o_custkey % 5000 AS VARCHAR) AS distance,
         CASE WHEN o.o_orderkey % 5 = 0 THEN 'bj' WHEN o.o_orderkey % 7 = 0 THEN 'en'
              ELSE CAST(o.o_orderkey % 9 AS VARCHAR) END AS floor,
         o.o_orderkey % 2 = 0 AS exterior, o.o_custkey % 3 <> 0 AS hasLift,
         g.district, g.district_id, g.neighborhood, g.neighborhood_id
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN geo g ON g.n_nationkey = c.c_nationkey)"""

MOVES = """moves AS (
  SELECT CAST(year(l.l_shipdate) AS BIGINT) AS year,
         CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE CAST(l.l_quantity AS BIGINT) END AS moved,
         gs.neighborhood AS neighborhood_name, gs.neighborhood_id,
         gs.district AS district_name, gs.district_id,
         gd.neighborhood AS dest_neighborhood_name, gd.neighborhood_id AS dest_neighborhood_id,
         gd.district AS dest_district_name, gd.district_id AS dest_district_id
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN geo gs ON gs.n_nationkey = s.s_nationkey
  JOIN geo gd ON gd.n_nationkey = c.c_nationkey)"""

INCOME = """income AS (
  SELECT min(neighborhood) AS neighborhood_name, min(district) AS district_name,
         district_id, neighborhood_id, CAST(substr(queryDate, 1, 4) AS BIGINT) AS year,
         count(*) AS pop, max(price) AS RFD
  FROM listings GROUP BY district_id, neighborhood_id, CAST(substr(queryDate, 1, 4) AS BIGINT))"""

LATEST = """latest AS (
  SELECT * FROM (
    SELECT i.*, row_number() OVER (PARTITION BY district_id, neighborhood_id
                                   ORDER BY year DESC, pop DESC, RFD DESC) AS rn
    FROM income i) t WHERE rn = 1)"""

OUT_SUM = f"""out_sum AS (
  SELECT district_id AS d, neighborhood_id AS n, year AS y, {S('moved')} AS m
  FROM moves GROUP BY district_id, neighborhood_id, year)"""

IN_SUM = f"""in_sum AS (
  SELECT dest_district_id AS d, dest_neighborhood_id AS n, year AS y, {S('moved')} AS m,
         min(dest_district_name) AS district_name,
         min(dest_neighborhood_name) AS neighbourhood_name
  FROM moves GROUP BY dest_district_id, dest_neighborhood_id, year)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


STANDIN = (GEO, LISTINGS)
ALL_VIEWS = (GEO, LISTINGS, MOVES, INCOME)

LISTING_FILLED = {"propertyCode", "price", "queryDate", "typology", "status", "district",
                  "district_id", "neighborhood", "neighborhood_id", "bathrooms", "rooms",
                  "size", "distance", "floor", "exterior", "hasLift"}


def _sales_select() -> str:
    cols = []
    for f in schemas.SALES.fields:
        if f.name == "queryDate":
            cols.append("CAST(strptime(l.queryDate, '%Y_%m_%d') AS DATE) AS queryDate")
        elif f.name in LISTING_FILLED:
            cols.append(f"l.{f.name}")
        elif f.name == "population":
            cols.append("i.pop AS population")
        elif f.name == "RFD":
            cols.append("i.RFD")
        elif f.name == "move_in":
            cols.append("a.m AS move_in")
        elif f.name == "move_out":
            cols.append("b.m AS move_out")
        else:
            cols.append(f"CAST(NULL AS {sql_type(f.dataType)}) AS {f.name}")
    return ",\n  ".join(cols)


GOLD = {
    "gold_neighbourhood": with_(*ALL_VIEWS, OUT_SUM) + """
SELECT a.m AS moved_out, i.RFD, i.year, i.district_name, i.neighborhood_name AS neighbourhood_name
FROM income i JOIN out_sum a ON a.d = i.district_id AND a.n = i.neighborhood_id AND a.y = i.year""",

    "gold_real_estate": with_(*ALL_VIEWS, IN_SUM) + """
SELECT a.m AS moved_in, l.advertisements, a.y AS year, a.district_name, a.neighbourhood_name
FROM in_sum a JOIN (
  SELECT district_id AS d, neighborhood_id AS n, CAST(substr(queryDate, 1, 4) AS BIGINT) AS y,
         count(*) AS advertisements
  FROM listings GROUP BY 1, 2, 3) l ON a.d = l.d AND a.n = l.n AND a.y = l.y""",

    "gold_sale_prices": with_(*ALL_VIEWS, LATEST) + """
SELECT l.price, i.RFD, strptime(l.queryDate, '%Y_%m_%d') AS queryDate,
       l.district AS district_name, l.neighborhood AS neighbourhood_name
FROM listings l JOIN latest i ON l.district_id = i.district_id AND l.neighborhood_id = i.neighborhood_id""",

    "gold_sales": with_(*ALL_VIEWS, LATEST, OUT_SUM, IN_SUM) + f"""
SELECT
  {_sales_select()}
FROM listings l
JOIN latest i ON l.district_id = i.district_id AND l.neighborhood_id = i.neighborhood_id
JOIN out_sum a ON a.d = l.district_id AND a.n = l.neighborhood_id
  AND a.y = CAST(substr(l.queryDate, 1, 4) AS BIGINT)
JOIN in_sum b ON b.d = l.district_id AND b.n = l.neighborhood_id
  AND b.y = CAST(substr(l.queryDate, 1, 4) AS BIGINT)""",
}

ORACLE: dict[str, str] = {}
ORACLE.update(GOLD)


def _listing_select(filled: dict[str, str]) -> str:
    cols = []
    for f in schemas.LISTING.fields:
        if f.name in filled:
            cols.append(f"{filled[f.name]} AS {f.name}")
        else:
            cols.append(f"CAST(NULL AS {sql_type(f.dataType)}) AS {f.name}")
    return ",\n  ".join(cols)


PLACES = """places AS (
  SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_regionkey, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

RAW_MOVES = """raw_moves AS (
  SELECT CAST(s.s_nationkey AS BIGINT) AS origin, CAST(c.c_nationkey AS BIGINT) AS destination,
         CAST(year(l.l_shipdate) AS BIGINT) AS year,
         CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE CAST(l.l_quantity AS BIGINT) END AS moved
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey)"""

RAW_INCOME_FLAT = """raw_income AS (
  SELECT p.n_name AS neighborhood_name, p.r_name AS district_name,
         CAST(year(o.o_orderdate) AS BIGINT) AS year, count(*) AS pop, max(o.o_totalprice) AS RFD
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN places p ON p.n_nationkey = c.c_nationkey
  GROUP BY p.n_name, p.r_name, CAST(year(o.o_orderdate) AS BIGINT))"""

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _priority_col(label: str) -> str:
    import re
    return "priority_" + re.sub(r"[^0-9A-Za-z]+", "_", label).strip("_")


MORE = {
    "scan_parquet_project": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS price,
       o_orderpriority AS priority FROM orders""",

    "scan_csv_header": """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CAST(c_acctbal AS DOUBLE) AS c_acctbal
FROM customer""",

    "scan_json_nested": """
SELECT o_orderkey AS order_key, 'status' AS kind, o_orderstatus AS value FROM orders
UNION ALL
SELECT o_orderkey, 'priority', o_orderpriority FROM orders""",

    "scan_file_provenance": """
SELECT strftime(o_orderdate, '%Y') || '_01_01' AS queryDate, count(*) AS orders
FROM orders GROUP BY 1""",

    "flatten_structs": """
SELECT l_orderkey, l_linenumber, l_quantity,
       coalesce(CASE WHEN l_linestatus = 'F' THEN 'final' END, l_returnflag) AS flag,
       l_extendedprice
FROM lineitem""",

    "align_schema": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""",

    "rename_override_drop": """
SELECT c_custkey, upper(c_name) AS customer_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       c_acctbal, c_acctbal < 0 AS in_debt
FROM customer""",

    "union_all_files": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",

    "ledger_skip_processed": """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders
WHERE year(o_orderdate) NOT IN (
  SELECT y FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) t ORDER BY y LIMIT 2)""",

    "overwrite_or_append": """
SELECT 'run1' AS state, count(*) AS rows FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'run2', count(*) FROM orders
UNION ALL SELECT 'reset_run', count(*) FROM orders""",

    "newer_than_gate": """
SELECT true AS run_first, false AS run_after_record, true AS run_after_rewrite,
       false AS fresh_first, true AS fresh_after_record, false AS fresh_after_rewrite,
       count(*) AS rows
FROM orders""",

    "publish_replace": "SELECT * FROM orders",

    "publish_status_retry": """
SELECT 'orders' AS "table", CAST(1 AS BIGINT) AS attempts, 'SUCCESS' AS status,
       (SELECT count(*) FROM orders) AS rows
UNION ALL SELECT 'supplier', 2, 'FAILED_UPDATE', NULL
UNION ALL SELECT 'customer', 2, 'SUCCESS', (SELECT count(*) FROM customer)""",

    "lookup_explode_join": with_(PLACES) + """
SELECT CAST(r_regionkey AS VARCHAR) AS district_id, r_name AS district_raw,
       lower(r_name) AS district, CAST(n_nationkey AS VARCHAR) AS neighborhood_id,
       n_name AS neighborhood_raw, replace(n_name, '_', ' ') AS neighborhood
FROM places""",

    "lookup_code_bridge": with_(PLACES) + """
SELECT CAST(n_nationkey AS BIGINT) AS code, replace(n_name, '_', ' ') AS neighborhood_name,
       CAST(n_nationkey AS VARCHAR) AS neighborhood_id, lower(r_name) AS district_name,
       CAST(r_regionkey AS VARCHAR) AS district_id
FROM places""",

    "reconcile_listings": with_(PLACES) + f"""
SELECT
  {_listing_select({
      "propertyCode": "CAST(o.o_orderkey AS VARCHAR)", "price": "o.o_totalprice",
      "status": "CASE WHEN o.o_orderstatus = 'O' THEN 'open' ELSE o.o_orderstatus END",
      "typology": "o.o_orderpriority", "district": "lower(p.r_name)",
      "district_id": "CAST(p.r_regionkey AS VARCHAR)",
      "neighborhood": "replace(p.n_name, '_', ' ')",
      "neighborhood_id": "CAST(p.n_nationkey AS VARCHAR)",
      "queryDate": "strftime(o.o_orderdate, '%Y') || '_01_01'"})}
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN places p ON p.n_nationkey = c.c_nationkey""",

    "reconcile_both_ends": with_(GEO, MOVES) + "SELECT * FROM moves",

    "reconcile_income": with_(*ALL_VIEWS) + "SELECT * FROM income",

    "sentinel_to_null": with_(RAW_MOVES) + "SELECT * FROM raw_moves",

    "explode_info": with_(PLACES, RAW_INCOME_FLAT) + "SELECT * FROM raw_income",

    "dedup_keep_first": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
                 l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
                 l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
      FROM lineitem) t
WHERE rn = 1""",

    "agg_null_preserving_sum": with_(GEO, MOVES) + f"""
SELECT neighborhood_id, dest_neighborhood_id, year, {S('moved')} AS moved
FROM moves GROUP BY neighborhood_id, dest_neighborhood_id, year""",

    "agg_sum_with_names": with_(GEO, MOVES, IN_SUM) + """
SELECT d AS district_id, n AS neighborhood_id, y AS year, m AS moved_in, district_name,
       neighbourhood_name
FROM in_sum""",

    "agg_count_per_key": with_(*STANDIN) + """
SELECT district_id, neighborhood_id, CAST(substr(queryDate, 1, 4) AS BIGINT) AS year,
       count(*) AS advertisements
FROM listings GROUP BY 1, 2, 3""",

    "latest_per_key": with_(*ALL_VIEWS, LATEST) + """
SELECT district_id, neighborhood_id, year, pop, RFD FROM latest""",

    "date_string_parse": """
SELECT o_orderkey, strftime(o_orderdate, '%Y_%m_%d') AS queryDate,
       CAST(year(o_orderdate) AS BIGINT) AS year,
       strptime(strftime(o_orderdate, '%Y_%m_%d'), '%Y_%m_%d') AS query_ts,
       CAST(strptime(strftime(o_orderdate, '%Y_%m_%d'), '%Y_%m_%d') AS DATE) AS query_day
FROM orders""",

    "clean_features": """
SELECT * FROM (
  SELECT p_partkey,
         TRY_CAST(CASE WHEN fl = 'bj' THEN '0' ELSE fl END AS DOUBLE) AS floor,
         p_size AS size, p_brand AS brand, price
  FROM (SELECT p_partkey, p_size, p_brand,
               CASE WHEN p_size % 5 = 0 THEN 'bj' WHEN p_size % 7 = 0 THEN 'en'
                    ELSE CAST(p_size AS VARCHAR) END AS fl,
               CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice END AS price
        FROM part) a) b
WHERE price IS NOT NULL AND p_partkey IS NOT NULL AND floor IS NOT NULL
  AND size IS NOT NULL AND brand IS NOT NULL""",

    "split_by_hash": """
SELECT o_orderkey,
       ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 7))::BIGINT % 5 AS bucket,
       CASE WHEN ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 7))::BIGINT % 5 = 0
            THEN 'test' ELSE 'train' END AS split
FROM orders""",

    "impute_median_mode": """
WITH g AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS priority
  FROM orders),
med AS (SELECT quantile_cont(price, 0.5) AS m FROM g),
mo AS (SELECT priority AS p FROM g WHERE priority IS NOT NULL
       GROUP BY priority ORDER BY count(*) DESC, priority ASC LIMIT 1)
SELECT o_orderkey, coalesce(price, (SELECT m FROM med)) AS price,
       coalesce(priority, (SELECT p FROM mo)) AS priority
FROM g""",

    "standardise_columns": """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders)
SELECT o_orderkey, round((o_totalprice - (SELECT m FROM s)) / (SELECT sd FROM s), 6) AS price_z
FROM orders""",

    "one_hot_categories": "SELECT o_orderkey, " + ", ".join(
        f"CASE WHEN o_orderpriority = '{p}' THEN 1.0 ELSE 0.0 END AS {_priority_col(p)}"
        for p in PRIORITIES) + " FROM orders",

    "regression_metrics": """
SELECT round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, count(*) AS entries
FROM (SELECT (o_totalprice * 0.95 + 500.0) - o_totalprice AS e FROM orders) t""",
}

ORACLE.update(MORE)

# The stream and the batch run fill one output: the same rows as either alone.
ORACLE["batch_then_stream"] = ORACLE["reconcile_listings"]

_BUCKET = "('0x' || substr(md5(propertyCode), 1, 7))::BIGINT % 5"
ORACLE["train_price_model"] = f"""
WITH sales AS ({GOLD['gold_sales']}),
typed AS (
  SELECT * REPLACE (TRY_CAST(CASE WHEN floor = 'bj' THEN '0' ELSE floor END AS DOUBLE) AS floor,
                    CAST(distance AS DOUBLE) AS distance)
  FROM sales WHERE price IS NOT NULL),
complete AS (
  SELECT {_BUCKET} AS bucket FROM typed
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FEATURES)})
SELECT (SELECT count(*) FROM typed) AS entries, count(*) FILTER (WHERE bucket <> 0) AS train_rows,
       count(*) FILTER (WHERE bucket = 0) AS test_rows,
       count(*) FILTER (WHERE bucket = 0) AS predictions, CAST(1 AS BIGINT) AS store_rows,
       true AS rmse_ge_mae, true AS reloaded_same
FROM complete"""

# A published table is read back as it was written.
ORACLE["published_scan"] = GOLD["gold_sales"]
# An incremental refresh gives what a full one gives.
ORACLE.update({f"incremental_{t}": GOLD[f"gold_{t}"] for t in ("neighbourhood", "real_estate", "sale_prices", "sales")})

# The streamed P1 run must give exactly the batch P1 result.
ORACLE["stream_listings"] = ORACLE["reconcile_listings"]

# Every fifth place is not in the lookups; all districts still are.
ORACLE["reject_counts"] = """
WITH facts AS (
  SELECT o.o_orderkey, c.c_nationkey AS d, r.r_name, n.n_name
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey),
known AS (SELECT DISTINCT n_regionkey AS k FROM nation WHERE n_nationkey % 5 <> 0),
moves AS (
  SELECT s.s_nationkey AS o, c.c_nationkey AS d
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey),
income AS (
  SELECT DISTINCT f.d, n.n_regionkey IN (SELECT k FROM known) AS has_district
  FROM facts f JOIN nation n ON n.n_nationkey = f.d)
SELECT 'idealista' AS pipe, 'place' AS step, count(*) AS rows, count(*) FILTER (WHERE d % 5 = 0) AS unknown FROM facts
UNION ALL SELECT 'padro_opendata', 'origin', count(*), count(*) FILTER (WHERE o % 5 = 0) FROM moves
UNION ALL SELECT 'padro_opendata', 'destination', count(*), count(*) FILTER (WHERE d % 5 = 0) FROM moves WHERE o % 5 <> 0
UNION ALL SELECT 'income_opendata', 'district', count(*), count(*) FILTER (WHERE NOT has_district) FROM income
UNION ALL SELECT 'income_opendata', 'neighbourhood', count(*), count(*) FILTER (WHERE d % 5 = 0) FROM income WHERE has_district"""

ORACLE["joint_median_mode"] = """
WITH o AS (
  SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price, CAST(o_custkey % 3 AS DOUBLE) AS few,
         CAST(o_orderkey AS DOUBLE) AS key,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS priority, o_orderstatus AS status FROM orders)
SELECT count(*) AS rows, CAST(median(price) AS DOUBLE) AS median_price, CAST(median(few) AS DOUBLE) AS median_few,
       CAST(median(key) AS DOUBLE) AS median_key, CAST(NULL AS DOUBLE) AS median_empty,
       (SELECT priority FROM o WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1) AS mode_priority,
       (SELECT status FROM o WHERE status IS NOT NULL GROUP BY status ORDER BY count(*) DESC, status LIMIT 1) AS mode_status,
       CAST(NULL AS VARCHAR) AS mode_nothing
FROM o"""
