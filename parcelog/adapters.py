"""The driver's tables seen as listing data, for queries and tests. Each frame has a twin in SQL in ``SQL_*``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-31"

#: An append-only log of sightings: full rows have a region, heartbeats only id, price and deal type.
OBSERVATIONS = """
SELECT event_id AS obs_id, user_id AS listing_id, ts AS scraped_at,
  CASE WHEN event_id % 50 = 49 THEN NULL ELSE cast(floor(value * 100) AS bigint) END AS price,
  CASE user_id % 10 WHEN 8 THEN 'rent_long' WHEN 9 THEN 'rent_day' WHEN 7 THEN NULL ELSE 'sale' END AS deal_type,
  CASE WHEN event_type <> 'error' THEN 'R' || cast(user_id % 5 AS string) END AS region,
  CASE WHEN event_type <> 'error' AND event_id % 7 <> 0 THEN 'M' || cast(user_id % 11 AS string) END AS municipality,
  CASE WHEN event_type <> 'error' AND event_id % 3 <> 0 THEN 'S' || cast(user_id % 4 AS string) END AS street,
  CASE WHEN event_type <> 'error' THEN 'H' || cast(user_id % 3 AS string) END AS house,
  CASE WHEN event_type <> 'error' AND user_id % 17 <> 0 THEN cast(550000 + user_id % 3 AS double) / 10000 END AS lat,
  CASE WHEN event_type <> 'error' AND user_id % 17 <> 0 THEN cast(370000 + user_id % 2 AS double) / 10000 END AS lon,
  CASE WHEN event_type <> 'error' THEN cast(user_id % 4 + 1 AS int) END AS floor,
  CASE WHEN event_type <> 'error' THEN cast(user_id % 2 + 5 AS int) END AS floors,
  CASE WHEN event_type <> 'error' AND user_id % 19 <> 0 THEN cast(300 + user_id % 2 AS double) / 10 END AS area,
  CASE WHEN event_type <> 'error' THEN cast(user_id % 6 AS int) END AS rooms,
  CASE WHEN event_type <> 'error' THEN user_id % 3 = 0 END AS is_new,
  CASE WHEN event_type <> 'error' AND user_id % 13 <> 0 THEN user_id % 9 END AS seller_id,
  event_type AS kind
FROM events"""

LISTINGS = """
SELECT o_orderkey AS listing_id, o_custkey AS seller_id, o_totalprice AS price, r_name AS region, n_name AS municipality,
  o_orderdate AS first_seen, o_orderpriority = '1-URGENT' AS is_new, cast(10 + o_orderkey % 91 AS double) AS area,
  cast(o_orderkey % 7 AS int) AS rooms, o_orderkey % 11 = 0 AS is_studio, o_orderstatus AS status, c_mktsegment AS segment,
  floor(o_totalprice / (10 + o_orderkey % 91)) AS ppm2, cast(o_orderkey % 100 AS double) / 100 + 55 AS lat, cast(o_custkey % 100 AS double) / 100 + 37 AS lon
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

SPANS = """
SELECT o_orderkey AS listing_id, o_custkey AS class, o_orderpriority AS seller, o_orderdate AS first_seen,
  o_orderdate + make_interval(0, 0, 0, cast(o_orderkey % 90 AS int)) AS last_seen, o_totalprice AS price
FROM orders"""

FLATS = """
SELECT l_orderkey AS order_id, l_linenumber AS line, l_extendedprice AS price, l_quantity AS area, p_type AS type, p_brand AS district, p_size AS floor, l_shipdate AS seen
FROM lineitem JOIN part ON l_partkey = p_partkey"""

SQL_OBSERVATIONS = f"obs AS ({OBSERVATIONS})"
SQL_LISTINGS = f"listings AS ({LISTINGS})"
SQL_SPANS = "spans AS (" + SPANS.replace("make_interval(0, 0, 0, cast(o_orderkey % 90 AS int))", "to_days(cast(o_orderkey % 90 AS int))") + ")"
SQL_FLATS = f"flats AS ({FLATS})"


def _frame(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    return spark.sql(_braced(text, names), **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def _braced(text: str, names: tuple[str, ...]) -> str:
    for n in names:
        text = text.replace(f"FROM {n}", f"FROM {{{n}}}").replace(f"JOIN {n} ", f"JOIN {{{n}}} ")
    return text


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, OBSERVATIONS, "events")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, LISTINGS, "orders", "customer", "nation", "region")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, SPANS, "orders")


def flats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, FLATS, "lineitem", "part")
