"""Queries of the matching joins, set operations and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelog import adapters as a
from parcelog.functions.values import room_key
from parcelog.operators import checks as q, lifecycle as life, matching as m
from parcelog.queries.lifecycles import ALL, FACT, NEWEST, O, S
from parcelog.queries.registry import query, table

c = F.col
L = a.SQL_LISTINGS


def on(frame, name: str, sql: str | None, f) -> None:
    query(sql, name)(lambda spark, sf_dir: f(frame(spark, sf_dir)))


on(
    a.spans,
    "interval_overlap_self_join",
    f"WITH {S} SELECT x.class, x.seller, x.listing_id AS a, y.listing_id AS b FROM spans x JOIN spans y ON x.class = y.class AND x.seller = y.seller"
    f" AND x.listing_id < y.listing_id AND x.first_seen <= y.last_seen AND y.first_seen <= x.last_seen",
    lambda d: m.overlapping_pairs(d, ["class", "seller"], "listing_id", "first_seen", "last_seen"),
)
_SEG = "(VALUES ('ASIA', ['1', '2', 'studio'], NULL), ('EUROPE', ['3', '5+'], true), ('ASIA', ['2'], false)) g(region, room_keys, wanted_new)"
SEGMENTS = [("ASIA", ["1", "2", "studio"], None), ("EUROPE", ["3", "5+"], True), ("ASIA", ["2"], False)]
on(
    a.listings,
    "segment_membership_join",
    f"""WITH {L}, s AS (SELECT *, row_number() OVER () AS no FROM {_SEG}), u AS (SELECT *, CASE WHEN is_studio THEN 'studio' WHEN rooms >= 5 THEN '5+' ELSE cast(rooms AS varchar) END AS rk FROM listings)
    SELECT listing_id, array_to_string(room_keys, ',') AS segment, wanted_new FROM u JOIN s ON s.region = u.region AND list_contains(room_keys, rk) AND (wanted_new IS NULL OR wanted_new = is_new)""",
    lambda d: m.segment_members(d.withColumn("room_key", room_key(c("rooms"), c("is_studio"))), d.sparkSession.createDataFrame(SEGMENTS, "region string, room_keys array<string>, wanted_new boolean"))
    .select("listing_id", F.array_join("room_keys", ",").alias("segment"), "wanted_new"),
)
on(
    a.observations,
    "join_inner_using",
    f"WITH {O}, {NEWEST}, p AS (SELECT listing_id, count(*) AS n FROM obs GROUP BY 1) SELECT listing_id, n, s.price AS price FROM newest"
    f" JOIN p USING (listing_id)",
    lambda o: life.latest(o).select("listing_id", "price").join(o.groupBy("listing_id").agg(F.count("*").alias("n")), "listing_id"),
)
on(
    a.observations,
    "join_left_chain",
    f"{ALL} SELECT listing_id, p.region AS region, slot, last_day FROM newest LEFT JOIN located USING (listing_id) LEFT JOIN slots USING (listing_id) LEFT"
    f" JOIN closing ON closing.region = p.region",
    lambda o: life.latest(o).select("listing_id").join(life.place_of(o).select("listing_id", "region"), "listing_id", "left").join(life.unit_identity(o).select("listing_id", "slot"), "listing_id", "left").join(life.closure_cutoff(life.region_day_census(o)), "region", "left").select("listing_id", "region", "slot", "last_day"),
)
query("SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey", "star_join")(
    lambda s, d: table(s, d, "orders").join(table(s, d, "customer"), c("o_custkey") == c("c_custkey")).join(table(s, d, "nation"), c("c_nationkey") == c("n_nationkey")).join(table(s, d, "region"), c("n_regionkey") == c("r_regionkey")).select("o_orderkey", "c_name", "n_name", "r_name"),
)
on(
    a.spans,
    "join_composite",
    f"WITH {S}, p AS (SELECT class, seller, count(*) AS n FROM spans GROUP BY 1, 2) SELECT listing_id, n FROM spans JOIN p USING (class, seller)",
    lambda d: d.join(d.groupBy("class", "seller").agg(F.count("*").alias("n")), ["class", "seller"]).select("listing_id", "n"),
)
_CARDS = """cards AS (SELECT obs_id, listing_id, scraped_at, price FROM obs WHERE scraped_at >= timestamp '2024-01-20'),
  state AS (SELECT * FROM obs WHERE scraped_at < timestamp '2024-01-20' AND listing_id % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY scraped_at DESC, obs_id DESC) = 1),
  dealt AS (SELECT c.*, s.listing_id IS NULL AS unknown, coalesce(c.price, 0) <> 0 AND c.price IS DISTINCT FROM s.price AS other FROM cards c LEFT JOIN state s USING (listing_id)),
  numbered AS (SELECT *, count(*) FILTER (WHERE unknown OR other) OVER (PARTITION BY listing_id ORDER BY scraped_at, obs_id) AS k FROM dealt),
  outcomes AS (SELECT obs_id, listing_id, price, CASE WHEN unknown AND k = 1 THEN 'new' WHEN unknown THEN 'dup' WHEN other AND k = 1 THEN 'repriced' ELSE 'known' END AS outcome FROM numbered)"""
def split(o):
    """The sightings of one run, and what was known before it."""
    cards = o.filter("scraped_at >= timestamp_ntz '2024-01-20'").select("obs_id", "listing_id", "scraped_at", "price")
    before = o.filter("scraped_at < timestamp_ntz '2024-01-20' and listing_id % 4 <> 0")
    return cards, life.latest_per_key(before, "listing_id", c("scraped_at"), c("obs_id"))


def run_counts(outcomes):
    """Sightings by outcome, and the new and repriced ones that came without a price."""
    counted = outcomes.groupBy("outcome").agg(F.count("*").alias("n"))
    return counted.unionByName(
        outcomes.agg(F.lit("no_price").alias("outcome"), F.count_if(c("outcome").isin("new", "repriced") & (F.coalesce("price", F.lit(0)) == 0)).alias("n")),
    )
on(a.observations, "state_left_join", f"WITH {O}, {_CARDS} SELECT * FROM outcomes", lambda o: m.classify_sightings(*split(o)).drop("scraped_at"))
on(
    a.observations,
    "run_counters",
    f"""WITH {O}, {_CARDS} SELECT outcome, count(*) AS n FROM outcomes GROUP BY 1
    UNION ALL SELECT 'no_price', count(*) FROM outcomes WHERE outcome IN ('new', 'repriced') AND coalesce(price, 0) = 0""",
    lambda o: run_counts(m.classify_sightings(*split(o))),
)
on(
    a.observations,
    "anti_seen_today",
    f"WITH {O} SELECT DISTINCT listing_id FROM obs WHERE scraped_at < timestamp '2024-01-30' AND listing_id NOT IN (SELECT listing_id FROM obs"
    f" WHERE scraped_at >= timestamp '2024-01-30')",
    lambda o: m.not_yet(
        o.filter("scraped_at < timestamp_ntz '2024-01-30'").select("listing_id").distinct(),
        o.filter("scraped_at >= timestamp_ntz '2024-01-30'"),
        ["listing_id"],
    ),
)
query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')", "resume_anti")(
    lambda s, d: m.not_yet(table(s, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), table(s, d, "customer").filter("c_mktsegment = 'BUILDING'"), ["c_custkey"]).select("o_orderkey"),
)
query("SELECT c_custkey, n_name FROM customer JOIN nation ON lower('nation ' || n_nationkey) = lower('Nation ' || c_nationkey)", "region_name_join")(
    lambda s, d: table(s, d, "customer")
    .withColumn("k", F.lower(F.concat(F.lit("Nation "), "c_nationkey")))
    .join(table(s, d, "nation").withColumn("k", F.lower(F.concat(F.lit("nation "), "n_nationkey"))), "k")
    .select("c_custkey", "n_name"),
)
query("SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events", "json_recordset")(
    lambda s, d: table(s, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k")),
)
query("SELECT event_id, round(value - m, 6) AS off FROM events, (SELECT avg(value) AS m FROM events)", "cross_single_row")(
    lambda s, d: (lambda e: e.crossJoin(F.broadcast(e.agg(F.avg("value").alias("m")))).select("event_id", F.round(c("value") - c("m"), 6).alias("off")))(table(s, d, "events")),
)
query("SELECT coalesce((SELECT count(*) FROM events WHERE user_id = -1 GROUP BY user_id), 0) AS n", "scalar_subquery")(
    lambda s, d: table(s, d, "events").filter("user_id = -1").agg(F.count("*").alias("n")),
)
query("SELECT r_name, segment, rooms FROM region, (SELECT DISTINCT c_mktsegment AS segment FROM customer), (VALUES (0), (1), (2)) v(rooms) WHERE segment = 'BUILDING' OR rooms > 0", "segment_grid")(
    lambda s, d: table(s, d, "region").select("r_name").crossJoin(table(s, d, "customer").select(c("c_mktsegment").alias("segment")).distinct()).crossJoin(s.createDataFrame([(0,), (1,), (2,)], "rooms int")).filter("segment = 'BUILDING' or rooms > 0"),
)
query("SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'", "score_join")(
    lambda s, d: table(s, d, "orders").filter("o_orderstatus = 'O'").join(table(s, d, "customer"), c("o_custkey") == c("c_custkey")).select("o_orderkey", "o_totalprice", "c_name"),
)
RINGS = [
    ("a", [(55.0, 37.0), (55.5, 37.0), (55.5, 37.5), (55.0, 37.5)]),
    ("b", [(55.4, 37.1), (55.9, 37.1), (55.65, 37.9)]),
    ("c", [(55.6, 37.0), (55.9, 37.0), (55.9, 37.4), (55.75, 37.1), (55.6, 37.4)]),
]
_EDGES = ", ".join(f"('{n}', {x1}::double, {y1}::double, {x2}::double, {y2}::double)" for n, r in RINGS for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1], strict=True))
on(
    a.listings,
    "spatial_pip_join",
    f"WITH {L}, p AS (SELECT listing_id, lat + 0.0033 AS x, lon + 0.0017 AS y"
    f" FROM listings), e(name, ax, ay, bx, by_) AS (VALUES {_EDGES}), h AS (SELECT listing_id, name, count(*) AS n FROM p JOIN e ON (ay > y) <> (by_ > y)"
    f" AND x < (bx - ax) * (y - ay) / (by_ - ay) + ax GROUP BY 1, 2) SELECT p.listing_id, min(name) FILTER (WHERE n % 2 = 1) AS name FROM p LEFT"
    f" JOIN h USING (listing_id) GROUP BY 1",
    lambda d: m.points_in_polygons(d.select("listing_id", (c("lat") + 0.0033).alias("x"), (c("lon") + 0.0017).alias("y")), d.sparkSession.createDataFrame(RINGS, "name string, ring array<struct<x:double,y:double>>"), "listing_id").select("listing_id", "name"),
)
query("SELECT DISTINCT o_orderpriority AS source FROM orders WHERE o_orderpriority LIKE '%HIGH' OR o_orderpriority LIKE '%LOW'", "loaded_sources")(
    lambda s, d: table(s, d, "orders").filter(c("o_orderpriority").like("%HIGH") | c("o_orderpriority").like("%LOW")).select(c("o_orderpriority").alias("source")).distinct(),
)
_UNION = " UNION ALL ".join(f"SELECT '{k}' AS source, {i} AS id FROM {t}" for k, t, i in (("o", "orders", "o_orderkey"), ("c", "customer", "c_custkey"), ("p", "part", "p_partkey")))
query(_UNION, "union_sources")(
    lambda s, d: table(s, d, "orders").select(F.lit("o").alias("source"), c("o_orderkey").alias("id")).unionByName(table(s, d, "customer").select(F.lit("c").alias("source"), c("c_custkey").alias("id"))).unionByName(
        table(s, d, "part").select(F.lit("p").alias("source"), c("p_partkey").alias("id")),
    ),
)
_REASON = "CASE WHEN url LIKE '%/en/%' THEN 'url' WHEN html LIKE '%***%' THEN 'phrase' WHEN page_id % 9 = 0 THEN 'no_price' END"
query(f"SELECT coalesce({_REASON}, 'kept') AS reason, count(*) AS n FROM pages GROUP BY 1", "skip_rules")(
    lambda s, d: table(s, d, "pages").select(F.when(c("url").contains("/en/"), "url").when(c("html").contains("***"), "phrase").when(c("page_id") % 9 == 0, "no_price").otherwise("kept").alias("reason")).groupBy("reason").agg(F.count("*").alias("n")),
)
on(
    a.listings,
    "segment_triage",
    f"WITH {L}, s AS (SELECT municipality, CASE WHEN min(region) = 'AFRICA' THEN NULL ELSE count(*) END AS n FROM listings GROUP BY 1) SELECT municipality,"
    f" CASE WHEN n IS NULL THEN 'fallback' WHEN n <= 590 THEN 'keep' ELSE 'split' END AS action, cast(CASE"
    f" WHEN n > 590 THEN ceil(n / 200.0) END AS bigint) AS k FROM s",
    lambda d: d.groupBy("municipality").agg(F.when(F.min("region") == "AFRICA", F.lit(None)).otherwise(F.count("*")).alias("n")).select(
        "municipality",
        F.when(c("n").isNull(), "fallback").when(c("n") <= 590, "keep").otherwise("split").alias("action"),
        F.when(c("n") > 590, F.ceil(c("n") / 200.0)).cast("bigint").alias("k"),
    ),
)

query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1", "dq_unique")(
    lambda s, d: q.unique(table(s, d, "lineitem"), "l_orderkey", "l_linenumber"),
)
on(a.observations, "dq_not_null", f"WITH {O} SELECT obs_id FROM obs WHERE price IS NULL", lambda o: q.not_null(o, "price").select("obs_id"))
query("SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1", "dq_accepted_values")(
    lambda s, d: q.accepted(table(s, d, "events"), "event_type", ["view", "click"]),
)
on(
    a.observations,
    "dq_field_sanity",
    f"WITH {O}, f AS (SELECT count(*) AS n, count(*) FILTER (WHERE area NOT BETWEEN 30.05"
    f" AND 3000) AS bad_area, count(*) FILTER (WHERE floor > floors - 2) AS bad_floor, count(*) FILTER (WHERE rooms NOT BETWEEN 0"
    f" AND 4) AS bad_rooms, count(*) FILTER (WHERE price <= 0) AS bad_price FROM obs) SELECT * FROM f WHERE n > 1000"
    f" AND bad_area + bad_floor + bad_rooms + bad_price > 0",
    lambda o: q.counted(
        o,
        {
            "bad_area": ~c("area").between(30.05, 3000),
            "bad_floor": c("floor") > c("floors") - 2,
            "bad_rooms": ~c("rooms").between(0, 4),
            "bad_price": c("price") <= 0,
        },
        1000,
    ),
)
on(
    a.listings,
    "dq_outlier_rate",
    f"WITH {L}, b AS (SELECT region, is_new, quantile_cont(ppm2, 0.5) AS med FROM listings"
    f" GROUP BY 1, 2 HAVING count(*) >= 150), s AS (SELECT region, count(*) AS n, count(*) FILTER (WHERE ppm2 < med / 2 OR ppm2 > med * 3) AS bad"
    f" FROM listings JOIN b USING (region, is_new) GROUP BY 1) SELECT region, n, bad, cast(round(100.0 * bad / n, 3) AS double) AS pct FROM s WHERE n > 1000"
    f" AND bad > n * 0.002",
    lambda d: q.outlier_rate(d, ["region", "is_new"], "ppm2", 2, 3, 150, 0.002, 1000, "region").withColumn("pct", c("pct").cast("double")),
)
on(
    a.observations,
    "dq_daily_volume",
    f"WITH {O}, t AS (SELECT cast(scraped_at AS date) AS d, count(DISTINCT listing_id) AS n FROM obs"
    f" GROUP BY 1), r AS (SELECT coalesce(max(n) FILTER (WHERE d = date '2024-01-30'), 0) AS last, max(n) AS peak FROM t WHERE d < date '2024-01-31'"
    f" AND d >= date '2024-01-15') SELECT * FROM r WHERE last < 1.6 * peak",
    lambda o: q.volume_drop(
        o.groupBy(F.to_date("scraped_at").alias("d")).agg(F.countDistinct("listing_id").alias("n")),
        F.lit("2024-01-31").cast("date"),
        16,
        1.6,
    ),
)
on(
    a.observations,
    "dq_fresh",
    f"WITH {O} SELECT max(scraped_at) AS newest FROM obs HAVING max(scraped_at) < timestamp '2024-01-31 20:00:00' - INTERVAL 14 HOUR",
    lambda o: q.stale(o, "scraped_at", F.lit("2024-01-31 20:00:00").cast("timestamp_ntz"), 14),
)
on(
    a.observations,
    "dq_rent_sanity",
    f"WITH {O}, r AS (SELECT * FROM obs WHERE deal_type LIKE 'rent%'), f AS (SELECT count(*) AS n, count(*) FILTER (WHERE (deal_type = 'rent_long'"
    f" AND price < 3000) OR (deal_type = 'rent_day' AND price < 300)) AS bad FROM r) SELECT n, bad, cast(round(100.0 * bad / n, 2) AS double) AS pct FROM f"
    f" WHERE n > 1000 AND bad > n * 0.02",
    lambda o: q.share(o.filter(c("deal_type").startswith("rent")), ((c("deal_type") == "rent_long") & (c("price") < 3000)) | ((c("deal_type") == "rent_day") & (c("price") < 300)), 0.02, 1000).withColumn("pct", c("pct").cast("double")),
)
_RUNS = "SELECT o_orderkey AS run_id, o_orderdate AS finished_at, o_custkey AS plan_offers, cast(o_orderkey % 3 AS bigint) AS cards, cast(o_orderkey % 2 AS bigint) AS incomplete FROM orders"
query(f"WITH r AS (SELECT cast(sum(cards) AS bigint) AS cards, max(plan_offers) AS plan_offers, cast(sum(incomplete) AS bigint) AS incomplete FROM ({_RUNS}) WHERE finished_at >= timestamp '2001-08-01' - INTERVAL 30 HOUR AND plan_offers > 0) SELECT *, cast(round(100.0 * cards / plan_offers, 1) AS double) AS pct FROM r WHERE cards < plan_offers * 0.6", "dq_coverage")(
    lambda s, d: q.coverage(table(s, d, "orders").selectExpr("o_orderkey as run_id", "o_orderdate as finished_at", "o_custkey as plan_offers", "o_orderkey % 3 as cards", "o_orderkey % 2 as incomplete"), F.expr("timestamp_ntz '2001-08-01' - interval 30 hours"), 0.6).withColumn("pct", c("pct").cast("double")),
)
on(
    a.observations,
    "dq_seller_coverage",
    f"{ALL}, {FACT}, v AS (SELECT count(*) AS n, count(*) FILTER (WHERE seller_id IS NULL) AS bad FROM fact WHERE event_closed = 0)"
    f" SELECT n, bad, cast(round(100.0 * bad / n, 2) AS double) AS pct FROM v WHERE n > 0 AND bad > n * 0.05",
    lambda o: q.share(life.fact_listing(o).filter("event_closed = 0"), c("seller_id").isNull(), 0.05, 0).withColumn("pct", c("pct").cast("double")),
)
_OVER = f"p AS (SELECT DISTINCT x.class FROM spans x JOIN spans y ON x.class = y.class AND x.seller = y.seller AND x.listing_id < y.listing_id AND x.first_seen <= y.last_seen AND y.first_seen <= x.last_seen)"
on(
    a.spans,
    "dq_slot_overlap",
    f"WITH {S}, {_OVER}, t AS (SELECT (SELECT count(*) FROM p) AS bad, (SELECT count(DISTINCT class) FROM spans) AS n) SELECT * FROM t WHERE bad > 0.01 * n",
    lambda d: m.overlapping_pairs(d, ["class", "seller"], "listing_id", "first_seen", "last_seen").select("class", F.lit(1).alias("bad")).distinct().join(d.select("class").distinct(), "class", "right").agg(F.count("bad").alias("bad"), F.count("*").alias("n")).filter("bad > 0.01 * n"),
)
on(
    a.observations,
    "dq_runner",
    f"""WITH {O} SELECT 'not_null' AS "check", count(*) FILTER (WHERE price IS NULL) AS n_violations, count(*) FILTER (WHERE price IS NULL) = 0 AS passed, false AS failed FROM obs
    UNION ALL SELECT 'unique', 0, true, false
    UNION ALL SELECT 'accepted', count(DISTINCT kind), count(*) = 0, false FROM obs WHERE kind NOT IN ('view', 'click')
    UNION ALL SELECT 'built_wrongly', NULL, false, true UNION ALL SELECT 'fails_as_it_runs', NULL, false, true""",
    lambda o: q.run_checks({
        "not_null": q.not_null(o, "price"), "unique": q.unique(o, "obs_id"), "accepted": lambda: q.accepted(o, "kind", ["view", "click"]),
        "built_wrongly": lambda: q.not_null(o, "no_such_column"), "fails_as_it_runs": o.filter(F.raise_error(F.lit("broken")).cast("string").isNotNull()),
    }, o.sparkSession).select("check", "n_violations", "passed", c("error").isNotNull().alias("failed")),
)
