"""Filters, joins, summaries and parameterised mart queries over the listing and flat frames."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from parcelog import adapters as a
from parcelog.functions.values import room_key
from parcelog.operators import summaries as s
from parcelog.operators.ranks import overall_quantiles
from parcelog.queries.registry import query, table

L, FL = a.SQL_LISTINGS, a.SQL_FLATS
c = F.col


def on(frame, name: str, sql: str, f) -> None:
    query(sql, name)(lambda spark, sf_dir: f(frame(spark, sf_dir)))


def listings(name: str, sql: str, f) -> None:
    on(a.listings, name, f"WITH {L} {sql}", f)


def flats(name: str, sql: str, f) -> None:
    on(a.flats, name, f"WITH {FL} {sql}", f)


SANE = "status <> 'F' AND area BETWEEN 20 AND 90 AND price BETWEEN 20000 AND 400000"
sane = lambda df: df.filter(SANE)
_BAND = "b AS (SELECT region, is_new, quantile_cont(ppm2, 0.5) AS med, count(*) AS n FROM listings GROUP BY 1, 2)"
_INSIDE = "(n < 150 OR ppm2 BETWEEN med / 1.5 AND med * 2.5)"

listings("sane_sale", f"SELECT listing_id, price, region FROM listings WHERE {SANE}", lambda d: sane(d).select("listing_id", "price", "region"))
listings(
    "sane_unit",
    "SELECT listing_id FROM listings WHERE status = 'O' AND area BETWEEN 10 AND 60 AND price BETWEEN 300000 AND 2000000000",
    lambda d: d.filter((c("status") == "O") & c("area").between(10, 60) & c("price").between(3e5, 2e9)).select("listing_id"),
)
listings(
    "sane_rent",
    "SELECT listing_id FROM listings WHERE ((segment = 'BUILDING' AND price BETWEEN 30000 AND 300000) OR (segment = 'MACHINERY' AND price BETWEEN 3000"
    " AND 50000)) AND area BETWEEN 5 AND 80",
    lambda d: d.filter((((c("segment") == "BUILDING") & c("price").between(30000, 300000)) | ((c("segment") == "MACHINERY") & c("price").between(3000, 50000))) & c("area").between(5, 80)).select("listing_id"),
)
listings(
    "median_band",
    f", {_BAND} SELECT region, is_new, round(med, 4) AS med, n FROM b",
    lambda d: s.median_band(d, ["region", "is_new"], "ppm2").withColumn("med", F.round("med", 4)),
)
listings(
    "band_filter",
    f", {_BAND} SELECT listing_id, ppm2 FROM listings JOIN b USING (region, is_new) WHERE {_INSIDE} OR segment = 'BUILDING'",
    lambda d: s.band_filter(d, ["region", "is_new"], "ppm2", 1.5, 2.5, 150, c("segment") == "BUILDING").select("listing_id", "ppm2"),
)
_SB = _BAND.replace("FROM listings", f"FROM listings WHERE {SANE}")
listings(
    "current_listings",
    f", {_SB} SELECT listing_id, region, municipality, price, area, rooms, is_studio, is_new, ppm2 FROM listings JOIN b USING (region, is_new) WHERE {SANE}"
    f" AND {_INSIDE}",
    lambda d: s.band_filter(sane(d), ["region", "is_new"], "ppm2", 1.5, 2.5, 150).select(
        "listing_id",
        "region",
        "municipality",
        "price",
        "area",
        "rooms",
        "is_studio",
        "is_new",
        "ppm2",
    ),
)
_RB = "b AS (SELECT region, segment, quantile_cont(price, 0.5) AS med, count(*) AS n FROM listings WHERE segment IN ('BUILDING', 'MACHINERY') GROUP BY 1, 2)"
listings(
    "current_rentals",
    f", {_RB} SELECT listing_id, segment, price FROM listings JOIN b USING (region, segment) WHERE n < 150 OR price BETWEEN med / 1.5"
    f" AND med * 2.5 OR segment = 'MACHINERY'",
    lambda d: s.band_filter(d.filter(c("segment").isin("BUILDING", "MACHINERY")), ["region", "segment"], "price", 1.5, 2.5, 150, c("segment") == "MACHINERY").select("listing_id", "segment", "price"),
)
listings(
    "join_expr_key",
    ", f AS (SELECT *, coalesce(nullif(is_new, is_studio), false) AS nb FROM listings) SELECT f.listing_id, k.label FROM f"
    " JOIN (VALUES (true, 'new'), (false, 'old')) k(nb, label) ON k.nb = f.nb",
    lambda d: d.withColumn("nb", F.coalesce(F.nullif("is_new", "is_studio"), F.lit(False))).join(d.sparkSession.createDataFrame([(True, "new"), (False, "old")], "nb boolean, label string"), "nb").select("listing_id", "label"),
)
listings(
    "optional_predicates",
    "SELECT listing_id FROM listings WHERE region = 'ASIA' AND price >= 100000",
    lambda d: d.filter(s.every([c("region") == "ASIA", None, c("price") >= 100000])).select("listing_id"),
)
listings(
    "bbox_filter",
    "SELECT listing_id FROM listings WHERE lat BETWEEN 55.2 AND 55.6 AND lon BETWEEN 37.1 AND 37.5",
    lambda d: d.filter(c("lat").between(55.2, 55.6) & c("lon").between(37.1, 37.5)).select("listing_id"),
)
listings(
    "null_or_range",
    "SELECT listing_id FROM listings WHERE nullif(area, 10) IS NULL OR area BETWEEN 50 AND 60",
    lambda d: d.filter(F.nullif("area", F.lit(10.0)).isNull() | c("area").between(50, 60)).select("listing_id"),
)
listings(
    "in_list_filter",
    "SELECT listing_id FROM listings WHERE region IN ('ASIA', 'EUROPE')",
    lambda d: d.filter(c("region").isin("ASIA", "EUROPE")).select("listing_id"),
)
listings("drop_columns", "SELECT listing_id, price FROM listings", lambda d: d.drop(*[x for x in d.columns if x not in ("listing_id", "price")]))
listings(
    "positional_rename",
    "SELECT listing_id AS c0_listing_id, seller_id AS c1_seller_id FROM listings",
    lambda d: (x := d.toDF(*[f"c{i}_{n}" for i, n in enumerate(d.columns)])).select(x.columns[:2]),
)
listings(
    "cast_types",
    "SELECT listing_id, cast(first_seen AS date) AS d, cast(rooms AS bigint) AS rooms, cast(is_new AS int) AS is_new FROM listings",
    lambda d: d.select(
        "listing_id",
        c("first_seen").cast("date").alias("d"),
        c("rooms").cast("bigint").alias("rooms"),
        c("is_new").cast("int").alias("is_new"),
    ),
)
listings(
    "valid_closed_rows",
    "SELECT listing_id FROM listings WHERE status = 'F' AND area >= 10 AND price > 0",
    lambda d: d.filter("status = 'F' and area >= 10 and price > 0").select("listing_id"),
)
listings(
    "score_filter",
    "SELECT listing_id FROM listings WHERE status = 'O' AND area > 0 AND price > 0 AND region = 'ASIA'",
    lambda d: d.filter(s.every([c("status") == "O", c("area") > 0, c("price") > 0, c("region") == "ASIA"])).select("listing_id"),
)
listings(
    "region_medians",
    "SELECT region, round(quantile_cont(ppm2, 0.5), 4) AS median_ppm2, count(*) AS n_active FROM listings WHERE status = 'O' GROUP BY 1",
    lambda d: s.median_band(d.filter("status = 'O'"), ["region"], "ppm2").select("region", F.round("med", 4).alias("median_ppm2"), c("n").alias("n_active")),
)
on(
    a.listings,
    "q_regions",
    f"WITH {L} SELECT region, round(quantile_cont(ppm2, 0.5), 4) AS median_ppm2, count(*) AS n_active FROM listings WHERE status = 'O' GROUP BY 1"
    f" ORDER BY 2 DESC",
    lambda d: s.median_band(d.filter("status = 'O'"), ["region"], "ppm2").select("region", F.round("med", 4).alias("median_ppm2"), c("n").alias("n_active")).orderBy(F.desc_nulls_first("median_ppm2")),
)
_GEO = "SELECT municipality, round(quantile_cont(ppm2, 0.5), 4) AS median_ppm2, count(*) AS n, round(avg(lat), 4) AS lat, round(avg(lon), 4) AS lon FROM listings WHERE region = 'ASIA' GROUP BY 1"
geo = lambda d: d.filter("region = 'ASIA'").groupBy("municipality").agg(
    F.round(F.percentile("ppm2", F.lit(0.5)), 4).alias("median_ppm2"),
    F.count("*").alias("n"),
    F.round(F.avg("lat"), 4).alias("lat"),
    F.round(F.avg("lon"), 4).alias("lon"),
)
listings("municipality_geo", _GEO, geo)
listings("q_geo", _GEO, geo)
_ROOM = "CASE WHEN is_studio THEN 'studio' WHEN rooms IS NULL THEN 'unknown' WHEN rooms >= 5 THEN '5+' ELSE cast(rooms AS varchar) END"
AT = {"p05": 0.05, "q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95}
_QS = ", ".join(f"round(quantile_cont(ppm2, {v}), 4) AS {k}" for k, v in AT.items())


def segmentation(d):
    from parcelog.functions.values import room_group

    return s.quantiles(d.filter(c("ppm2").between(500, 20000)).withColumn("room_group", room_group(c("rooms"), c("is_studio"))), ["room_group"], "ppm2", AT, 50)


_SEGMENT = f"SELECT {_ROOM} AS room_group, {_QS}, count(*) AS n FROM listings WHERE ppm2 BETWEEN 500 AND 20000 GROUP BY 1 HAVING count(*) > 50"
listings("quantile_segments", _SEGMENT, segmentation)


def both_segmentations(d, region=None):
    """Quantiles by rooms (groups of more than 50) and by new and other buildings, of a region or of all."""
    kept = d.filter(s.every([c("ppm2").between(500, 20000), c("region") == region if region else None]))
    by_rooms = segmentation(kept).select(F.lit("by_rooms").alias("table"), c("room_group").alias("segment"), *AT, "n")
    by_age = s.quantiles(kept, ["is_new"], "ppm2", AT).select(F.lit("new_vs_secondary").alias("table"), c("is_new").cast("string").alias("segment"), *AT, "n")
    return by_rooms.unionByName(by_age)


def _both_sql(where: str) -> str:
    kept = f"FROM listings WHERE ppm2 BETWEEN 500 AND 20000{where} GROUP BY ALL"
    return f"""SELECT 'by_rooms' AS "table", {_ROOM} AS segment, {_QS}, count(*) AS n {kept} HAVING count(*) > 50
    UNION ALL SELECT 'new_vs_secondary', cast(is_new AS varchar), {_QS}, count(*) {kept}"""


listings("q_segmentation", f"SELECT 'all' AS area, * FROM ({_both_sql('')}) UNION ALL SELECT 'ASIA', * FROM ({_both_sql(" AND region = 'ASIA'")})",
    lambda d: both_segmentations(d).withColumn("area", F.lit("all")).unionByName(both_segmentations(d, "ASIA").withColumn("area", F.lit("ASIA"))))
listings(
    "sorted_groups",
    "SELECT is_new, count(*) AS n FROM listings GROUP BY 1",
    lambda d: d.groupBy("is_new").agg(F.count("*").alias("n")).orderBy(F.asc_nulls_last("is_new")),
)
_MONTHLY = """, m AS (SELECT listing_id, region, municipality, is_new, date_trunc('month', first_seen) AS month, quantile_cont(ppm2, 0.5) AS ppm2 FROM listings GROUP BY 1, 2, 3, 4, 5),
idx AS (SELECT region, municipality, is_new, cast(month AS date) AS month, cast(round_even(quantile_cont(ppm2, 0.5), 0) AS bigint) AS median_ppm2, count(*) AS n_points FROM m GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3)"""


def monthly(d):
    listing = d.groupBy("listing_id", "region", "municipality", "is_new", F.trunc("first_seen", "month").alias("month")).agg(F.percentile("ppm2", F.lit(0.5)).alias("ppm2"))
    return listing.groupBy("region", "municipality", "is_new", "month").agg(F.rint(F.percentile("ppm2", F.lit(0.5))).cast("bigint").alias("median_ppm2"), F.count("*").alias("n_points")).filter("n_points >= 3")


listings("monthly_index", f"{_MONTHLY} SELECT * FROM idx", monthly)
_WI = "SELECT month, cast(round_even(sum(median_ppm2 * n_points) / nullif(sum(n_points), 0), 0) AS bigint) AS value, cast(sum(n_points) AS bigint) AS points FROM idx WHERE month >= date '1996-01-01'"
listings(
    "weighted_index",
    f"{_MONTHLY} {_WI} GROUP BY 1",
    lambda d: s.weighted_index(monthly(d).filter("month >= date '1996-01-01'"), "month", "median_ppm2", "n_points"),
)
listings(
    "q_price_index",
    f"{_MONTHLY} {_WI} AND region = 'ASIA' AND NOT is_new GROUP BY 1 ORDER BY 1",
    lambda d: s.weighted_index(monthly(d).filter(s.every([c("month") >= "1996-01-01", c("region") == "ASIA", None, ~c("is_new")])), "month", "median_ppm2", "n_points").orderBy("month"),
)
_HIST = "SELECT cast(floor((ppm2 - 500) / (20500 - 500) * 24) AS int) + 1 AS bucket, 500.0::double + (cast(floor((ppm2 - 500) / (20500 - 500) * 24) AS int)) * (20000 / 24) AS start, count(*) AS n FROM listings WHERE ppm2 BETWEEN 500 AND 20500 GROUP BY 1, 2"
listings("histogram_fixed", _HIST, lambda d: s.width_buckets(d, "ppm2", 500.0, 20500.0, 24))
listings(
    "q_distribution",
    _HIST.replace("WHERE", "WHERE region = 'ASIA' AND"),
    lambda d: s.width_buckets(d.filter("region = 'ASIA'"), "ppm2", 500.0, 20500.0, 24),
)
listings(
    "histogram_equal",
    ", r AS (SELECT min(price) AS lo, max(price) AS hi FROM listings)"
    " SELECT least(cast(floor((price - lo) / ((hi - lo) / 30)) AS int), 29) AS bin, count(*) AS n FROM listings, r GROUP BY 1",
    lambda d: s.histogram_equal(d, "price", 30),
)
_K = ", x AS (SELECT *, cast(3 + ascii(region) % 5 AS int) AS k FROM listings)"
_CUTS = f"{_K}, o AS (SELECT region, k, price, row_number() OVER (PARTITION BY region ORDER BY price) AS rn, count(*) OVER (PARTITION BY region) AS n FROM x), cuts AS (SELECT region, k, cast(i AS int) AS i, price AS cut, n FROM o, range(1, 8) t(i) WHERE i < k AND rn = ceil(cast(i AS double) / k * n))"
with_k = lambda d: d.withColumn("k", (F.ascii("region") % 5 + 3).cast("int"))
cuts = lambda d: s.equi_depth_cuts(with_k(d), ["region"], "price", "k")
listings("equi_depth_bands", f"{_CUTS} SELECT region, i, cut, n FROM cuts", lambda d: cuts(d).select("region", "i", "cut", c("n")))
#: A request for bands, as JSON: segments of several regions that overlap, one of a single band and one that nothing is in.
_REQUEST = """[{"region":"ASIA","rkey":"asia/small","rks":["1","studio"],"isnew":null,"k":4},{"region":"ASIA","rkey":"asia/large","rks":["5+","4","1"],"isnew":false,"k":3},
{"region":"EUROPE","rkey":"europe/new","rks":["2","3","4","5+"],"isnew":true,"k":7},{"region":"AFRICA","rkey":"africa/one","rks":["2"],"isnew":null,"k":1},{"region":"ATLANTIS","rkey":"none","rks":["1"],"isnew":null,"k":2}]"""
_WANTED = """(VALUES ('ASIA', 'asia/small', ['1', 'studio'], NULL, 4), ('ASIA', 'asia/large', ['5+', '4', '1'], false, 3), ('EUROPE', 'europe/new', ['2', '3', '4', '5+'], true, 7),
  ('AFRICA', 'africa/one', ['2'], NULL, 1), ('ATLANTIS', 'none', ['1'], NULL, 2)) w(region, rkey, rks, isnew, k)"""
_KEYED = "CASE WHEN is_studio THEN 'studio' WHEN rooms >= 5 THEN '5+' ELSE cast(rooms AS varchar) END"
listings(
    "q_price_bands",
    f""", p AS (SELECT region, is_new, price, {_KEYED} AS rk FROM listings WHERE price > 0),
    j AS (SELECT rkey, k, price FROM {_WANTED} JOIN p ON p.region = w.region AND list_contains(rks, rk) AND (isnew IS NULL OR isnew = is_new)),
    b AS (SELECT rkey, k, count(*) AS n, list(price ORDER BY price) AS all_prices FROM j GROUP BY ALL)
    SELECT rkey, cast(i AS int) AS i, all_prices[cast(ceil(cast(i AS double) / k * n) AS int)] AS cut, n FROM b, range(1, 10) t(i) WHERE i < k UNION ALL SELECT rkey, NULL, NULL, n FROM b WHERE k = 1""",
    lambda d: s.price_bands(d.withColumn("room_key", room_key(c("rooms"), c("is_studio"))), s.segments_of(d.sparkSession.createDataFrame([(_REQUEST,)], "request string"), "request")),
)
_EDGE = f"{_CUTS}, e AS (SELECT region, i, cast(floor(cut) AS bigint) AS lo, n, k FROM cuts) SELECT region, lo, lead(lo) OVER (PARTITION BY region ORDER BY i) - 1 AS hi, cast(ceil(n / k) AS bigint) AS expected FROM e UNION ALL SELECT region, NULL, min(lo) - 1, cast(ceil(max(n) / max(k)) AS bigint) FROM e GROUP BY 1"
listings(
    "band_edges",
    _EDGE,
    lambda d: s.band_edges(s.equi_depth_cuts(with_k(d), ["region"], "price", "k").join(with_k(d).select("region", "k").distinct(), "region"), ["region"]),
)
listings(
    "group_size_having",
    "SELECT municipality, count(*) AS n FROM listings GROUP BY 1 HAVING count(*) > 600",
    lambda d: d.groupBy("municipality").agg(F.count("*").alias("n")).filter("n > 600"),
)
listings(
    "filtered_counts",
    "SELECT count(*) AS n, count(*) FILTER (WHERE price < 50000) AS cheap, count(*) FILTER (WHERE area > 90) AS large, count(*) FILTER (WHERE rooms IS NULL) AS no_rooms"
    " FROM listings",
    lambda d: d.agg(
        F.count("*").alias("n"),
        F.count_if(c("price") < 50000).alias("cheap"),
        F.count_if(c("area") > 90).alias("large"),
        F.count_if(c("rooms").isNull()).alias("no_rooms"),
    ),
)
listings(
    "global_max_having",
    "SELECT max(first_seen) AS newest FROM listings HAVING max(first_seen) < timestamp '2030-01-01'",
    lambda d: d.agg(F.max("first_seen").alias("newest")).filter("newest < timestamp_ntz '2030-01-01'"),
)
listings(
    "score_summary",
    "SELECT count(*) AS n, round(avg(price / 500000), 6) AS mean, count(*) FILTER (WHERE price / 500000 >= 0.5) AS hot FROM listings",
    lambda d: d.agg(F.count("*").alias("n"), F.round(F.avg(c("price") / 500000), 6).alias("mean"), F.count_if(c("price") / 500000 >= 0.5).alias("hot")),
)
_TARGET = " UNION ALL ".join(
    f"SELECT '{x}' AS feature, cast({x} AS varchar) AS value, " + ", ".join(f"round(quantile_cont(price, {q}), 1) AS {k}" for k, q in {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}.items()) + ", count(*) AS n FROM listings GROUP BY 2 HAVING count(*) >= 200" for x in ("region", "segment", "rooms")
)
listings("target_by_category", _TARGET, lambda d: s.target_by_category(d, ["region", "segment", "rooms"], "price", 200))
listings(
    "lambda_aggregates",
    "SELECT segment, round(quantile_cont(price, 0.1), 4) AS p10, round(quantile_cont(price, 0.9), 4) AS p90, count(*) AS n FROM listings GROUP BY 1",
    lambda d: s.quantiles(d, ["segment"], "price", {"p10": 0.1, "p90": 0.9}),
)
listings(
    "box_stats",
    "SELECT municipality, round(quantile_cont(price, 0.25), 4) AS q1, round(quantile_cont(price, 0.5), 4) AS median, round(quantile_cont(price, 0.75), 4) AS q3, count(*) AS n"
    " FROM listings WHERE municipality IN (SELECT municipality FROM listings GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10) GROUP BY 1",
    lambda d: s.quantiles(
        d.join(
            d.groupBy("municipality").agg(F.count("*").alias("m")).orderBy(F.desc("m"), "municipality").limit(10).select("municipality"),
            "municipality",
            "left_semi",
        ),
        ["municipality"],
        "price",
        {"q1": 0.25, "median": 0.5, "q3": 0.75},
    ),
)
listings(
    "lowest_median_top",
    "SELECT municipality, round(quantile_cont(price, 0.5), 4) AS median, count(*) AS n FROM listings WHERE municipality <> 'NATION_1'"
    " GROUP BY 1 HAVING count(*) >= 100 ORDER BY 2, 1 LIMIT 10",
    lambda d: s.quantiles(d.filter("municipality <> 'NATION_1'"), ["municipality"], "price", {"median": 0.5}, 99).orderBy("median", "municipality").limit(10),
)
listings(
    "profile_table",
    " UNION ALL ".join(f"SELECT '{x}' AS feature, count(*) - count({x}) AS nulls, count(DISTINCT {x}) AS distinct FROM listings" for x in ("region", "rooms", "price")).replace("AS distinct", 'AS "distinct"'),
    lambda d: s.null_counts(d.select("region", "rooms", "price")),
)
listings(
    "top_categories",
    "SELECT feature, value, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rank FROM (" + " UNION ALL ".join(f"SELECT '{x}' AS feature, cast({x} AS varchar) AS value, count(*) AS n FROM listings GROUP BY 2" for x in ("municipality", "rooms")) + ")) WHERE rank <= 5",
    lambda d: s.top_values(d, ["municipality", "rooms"], 5),
)
_MIXED = {"price": 1, "area": 1, "rooms": 1, "lat": 1, "lon": 1, "region": 0, "municipality": 0, "segment": 0, "status": 0, "is_new": 0, "is_studio": 0}


def _association_sql() -> str:
    """Cramér's V of each pair from its own contingency table, with the cells that are empty."""
    code = lambda x: f"cast(least(floor(({x} - min({x}) OVER ())::double / (max({x}) OVER () - min({x}) OVER ()) * 10), 9) AS varchar)" if _MIXED[x] else f"cast({x} AS varchar)"
    names = list(_MIXED)
    halves = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {a} AS x, {b} AS y FROM coded" for i, a in enumerate(names) for b in names[i + 1 :])
    return f""", coded AS (SELECT {', '.join(f'{code(x)} AS {x}' for x in names)} FROM listings), long AS ({halves}),
    px AS (SELECT a, b, x, count(*)::double AS nx FROM long GROUP BY ALL), py AS (SELECT a, b, y, count(*)::double AS ny FROM long GROUP BY ALL), pn AS (SELECT a, b, count(*)::double AS n FROM long GROUP BY ALL),
    seen AS (SELECT a, b, x, y, count(*)::double AS o FROM long GROUP BY ALL),
    chi AS (SELECT a, b, any_value(n) AS n, sum(pow(coalesce(o, 0) - nx * ny / n, 2) / (nx * ny / n)) AS chi2, count(DISTINCT x)::double AS r, count(DISTINCT y)::double AS k
      FROM px JOIN py USING (a, b) JOIN pn USING (a, b) LEFT JOIN seen USING (a, b, x, y) GROUP BY a, b),
    half AS (SELECT a, b, round(sqrt(greatest(0, chi2 / n - (k - 1) * (r - 1) / (n - 1)) / (least(r - pow(r - 1, 2) / (n - 1), k - pow(k - 1, 2) / (n - 1)) - 1)), 6) AS v FROM chi)
    SELECT a, b, v FROM half UNION ALL SELECT b, a, v FROM half UNION ALL SELECT c, c, 1.0::double FROM (SELECT unnest([{', '.join(f"'{x}'" for x in names)}]) AS c)"""


listings("association_matrix", _association_sql(), lambda d: s.association_matrix(d, list(_MIXED)))
listings("hexbin_median", """, h AS (SELECT ppm2, (lon * (sqrt(3.0) / 3) - lat / 3.0) / 0.05 AS q, lat * (2.0::double / 3) / 0.05 AS r FROM listings), y AS (SELECT *, round_even(q, 0) AS x, round_even(-q - r, 0) AS y, round_even(r, 0) AS z FROM h),
  w AS (SELECT *, abs(x - q) AS dx, abs(y + q + r) AS dy, abs(z - r) AS dz FROM y) SELECT cast(CASE WHEN dx > dy AND dx > dz THEN -y - z ELSE x END AS int) AS q, cast(CASE WHEN dz >= dx AND dz >= dy THEN -x - y ELSE z END AS int) AS r, round(quantile_cont(ppm2, 0.5), 4) AS median, count(*) AS n FROM w GROUP BY 1, 2""", lambda d: (lambda cell: s.quantiles(d.select("ppm2", cell[0].alias("q"), cell[1].alias("r")), ["q", "r"], "ppm2", {"median": 0.5}))(s.hex_cell(c("lat"), c("lon"), 0.05)))
listings(
    "train_top_recent",
    "SELECT listing_id, first_seen FROM listings ORDER BY first_seen DESC, listing_id LIMIT 1600",
    lambda d: s.newest(d.select("listing_id", "first_seen"), "first_seen", "listing_id", 1600),
)
_HOT = "SELECT listing_id, price / 500000 AS score FROM listings WHERE municipality = 'NATION_3' AND rooms = 2 ORDER BY 2 DESC, 1 LIMIT 20"
hot = lambda d: d.filter(s.every([c("municipality") == "NATION_3", c("rooms") == 2, None])).select("listing_id", (c("price") / 500000).alias("score")).orderBy(F.desc("score"), "listing_id").limit(20)
listings("hot_top_n", _HOT, hot)
listings("q_hot", _HOT, hot)
listings(
    "custom_order",
    "SELECT segment, n, list_position(['MACHINERY', 'BUILDING'], segment) AS place FROM (SELECT segment, count(*) AS n FROM listings GROUP BY 1)",
    lambda d: d.groupBy("segment").agg(F.count("*").alias("n")).withColumn("place", F.nullif(F.array_position(F.array(F.lit("MACHINERY"), F.lit("BUILDING")), c("segment")), F.lit(0).cast("bigint")).cast("int")).orderBy("place"),
)
listings("distinct_rows", "SELECT DISTINCT region, municipality FROM listings", lambda d: d.select("region", "municipality").distinct())
listings(
    "q_region_names",
    "SELECT DISTINCT region FROM listings WHERE region IS NOT NULL",
    lambda d: d.filter("region is not null").select("region").distinct(),
)
listings(
    "id_set_union",
    "SELECT listing_id FROM listings WHERE rooms = 1 UNION SELECT listing_id FROM listings WHERE is_new",
    lambda d: d.filter("rooms = 1").select("listing_id").union(d.filter("is_new").select("listing_id")).distinct(),
)
listings(
    "make_target",
    "SELECT listing_id, coalesce(cast(rooms < 3 AS int), 0) AS target FROM listings",
    lambda d: d.select("listing_id", F.coalesce((c("rooms") < 3).cast("int"), F.lit(0)).alias("target")),
)
listings(
    "recency_holdout",
    "SELECT listing_id, row_number() OVER (ORDER BY first_seen DESC, listing_id) <= 0.2 * count(*) OVER () AS is_test FROM listings",
    lambda d: s.newest_share(d, "first_seen", "listing_id", 0.2).select("listing_id", "is_test"),
)
listings(
    "group_median_transform",
    "SELECT listing_id, round(quantile_cont(ppm2, 0.5) OVER (PARTITION BY region, rooms), 4) AS med FROM listings",
    lambda d: d.join(s.median_band(d, ["region", "rooms"], "ppm2"), ["region", "rooms"]).select("listing_id", F.round("med", 4).alias("med")),
)
listings(
    "ratio_to_group_median",
    ", m AS (SELECT region, rooms, quantile_cont(ppm2, 0.5) AS med FROM listings GROUP BY 1, 2) SELECT listing_id, round(ppm2 / nullif(med, 0), 6) AS ratio"
    " FROM listings JOIN m USING (region, rooms)",
    lambda d: d.join(s.median_band(d, ["region", "rooms"], "ppm2"), ["region", "rooms"]).select(
        "listing_id",
        F.round(c("ppm2") / F.nullif("med", F.lit(0.0)), 6).alias("ratio"),
    ),
)
listings(
    "lookup_left",
    ", m AS (SELECT region, rooms, quantile_cont(area, 0.5) AS med FROM listings WHERE rooms > 1 GROUP BY 1, 2) SELECT listing_id, med FROM listings LEFT"
    " JOIN m USING (region, rooms)",
    lambda d: d.join(s.median_band(d.filter("rooms > 1"), ["region", "rooms"], "area").drop("n"), ["region", "rooms"], "left").select("listing_id", "med"),
)
listings(
    "ratio_features",
    ", m AS (SELECT municipality, rooms, quantile_cont(ppm2, 0.5) AS med FROM listings GROUP BY 1, 2), g AS (SELECT quantile_cont(ppm2, 0.5) AS all_med"
    " FROM listings) SELECT listing_id, round(ppm2 / nullif(coalesce(med, all_med), 0), 6) AS ratio FROM listings LEFT"
    " JOIN m USING (municipality, rooms), g",
    lambda d: d.join(s.median_band(d, ["municipality", "rooms"], "ppm2"), ["municipality", "rooms"], "left").select(
        "listing_id",
        F.round(c("ppm2") / F.nullif(F.coalesce("med", F.lit(overall_quantiles(d, "ppm2", 0.5)[0])), F.lit(0.0)), 6).alias("ratio"),
    ),
)

flats(
    "quantile_clip",
    ", q AS (SELECT quantile_cont(price, 0.99) AS cap FROM flats) SELECT order_id, line, round(least(price, cap), 4) AS price FROM flats, q",
    lambda d: s.quantile_clip(d, "price").select("order_id", "line", F.round("price", 4).alias("price")),
)
flats(
    "quantile_trim",
    ", q AS (SELECT quantile_cont(price, 0.01) AS a, quantile_cont(price, 0.99) AS b FROM flats), x AS (SELECT flats.* FROM flats, q WHERE price BETWEEN a"
    " AND b), r AS (SELECT quantile_cont(area, 0.01) AS a, quantile_cont(area, 0.99) AS b FROM x) SELECT order_id, line, price, area FROM x, r"
    " WHERE area BETWEEN a AND b",
    lambda d: s.quantile_trim(d, ["price", "area"]).select("order_id", "line", "price", "area"),
)
flats(
    "mode_fill",
    ", x AS (SELECT order_id, line, nullif(type, 'PROMO') AS type FROM flats), m AS (SELECT type FROM x WHERE type IS NOT NULL GROUP BY 1"
    " ORDER BY count(*) DESC, 1 LIMIT 1) SELECT order_id, line, coalesce(x.type, m.type) AS type FROM x, m",
    lambda d: s.mode_fill(d.select("order_id", "line", F.nullif("type", F.lit("PROMO")).alias("type")), "type"),
)
flats(
    "hier_impute",
    ", x AS (SELECT order_id, line, type, district, CASE WHEN floor % 5 <> 0 THEN price END AS price"
    " FROM flats), m AS (SELECT type, district, quantile_cont(price, 0.5) AS m FROM x WHERE price IS NOT NULL"
    " GROUP BY 1, 2), n AS (SELECT type, quantile_cont(price, 0.5) AS n FROM x WHERE price IS NOT NULL"
    " GROUP BY 1), g AS (SELECT quantile_cont(price, 0.5) AS g FROM x) SELECT order_id, line, round(coalesce(price, m, n, g), 4) AS price FROM x LEFT"
    " JOIN m USING (type, district) LEFT JOIN n USING (type), g",
    lambda d: s.hierarchical_fill(d.select("order_id", "line", "type", "district", F.when(c("floor") % 5 != 0, c("price")).alias("price")), "price", [["type", "district"], ["type"]]).select("order_id", "line", F.round("price", 4).alias("price")),
)
flats(
    "global_fill",
    ", x AS (SELECT order_id, line, nullif(floor, 3) AS floor FROM flats), g AS (SELECT quantile_cont(floor, 0.5) AS m FROM x)"
    " SELECT order_id, line, coalesce(floor, m) AS floor FROM x, g",
    lambda d: s.hierarchical_fill(d.select("order_id", "line", F.nullif("floor", F.lit(3)).cast("double").alias("floor")), "floor", []),
)
