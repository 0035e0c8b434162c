"""Queries of staging, rents, samples, densities, features and file scans."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from parcelog import adapters as a
from parcelog.functions.text import count_before
from parcelog.functions.values import mapped
from parcelog.ml import features
from parcelog.operators import lifecycle as life, summaries as s
from parcelog.plans import staging
from parcelog.queries.lifecycles import ALL, DAYS, FACT, HISTORY, LOCATED, NEWEST, UNIT, O, covered
from parcelog.queries.registry import query, table
from parcelog.sources import files, flats
from parcelog.storage import scratch_path, spread

c = F.col
L = a.SQL_LISTINGS


def log(name: str, sql: str, f) -> None:
    query(sql, name)(lambda spark, sf_dir: f(a.observations(spark, sf_dir)))


log(
    "stg_sale",
    f"WITH {O} SELECT obs_id, listing_id, price FROM obs WHERE coalesce(deal_type, 'sale') = 'sale'",
    lambda o: staging.stg_sale(o).select("obs_id", "listing_id", "price"),
)
log(
    "stg_rent",
    f"WITH {O} SELECT obs_id, listing_id, price FROM obs WHERE deal_type IN ('rent_long', 'rent_day')",
    lambda o: staging.stg_rent(o).select("obs_id", "listing_id", "price"),
)
_R = O.replace("obs AS (", "every AS (", 1) + ", obs AS (SELECT * FROM every WHERE deal_type LIKE 'rent%')"
log(
    "fact_rent",
    f"""WITH {_R}, {NEWEST}, {LOCATED}, {HISTORY}, {DAYS}, {covered('p.region', 'p.deal_type')}
    SELECT listing_id, s.deal_type AS deal_type, p.region AS region, p.municipality AS municipality, s.price AS price, s.area AS area, price_first, price_last, price_points,
      cast(cast(last_seen AS date) - cast(first_seen AS date) AS int) AS days_on_market, CASE WHEN cast(last_seen AS date) < last_day THEN 1 ELSE 0 END AS event_closed
    FROM newest JOIN history USING (listing_id) LEFT JOIN located USING (listing_id) LEFT JOIN closing ON closing.region = p.region AND closing.deal_type = s.deal_type""",
    lambda o: staging.fact_rent(staging.stg_rent(o)),
)
log(
    "current_units",
    f"""{ALL}, {FACT}, {UNIT} SELECT unit_sk, listing_id, region, price, area, cast(round_even(price / area, 0) AS bigint) AS ppm2
    FROM unit WHERE live AND area BETWEEN 10 AND 400 AND price BETWEEN 300 AND 2000000000""",
    lambda o: life.fact_unit(life.fact_listing(o)).filter("live and area between 10 and 400 and price between 300 and 2000000000").select("unit_sk", "listing_id", "region", "price", "area", F.rint(c("price") / c("area")).cast("bigint").alias("ppm2")),
)


def _sample(spark, sf_dir):
    return a.listings(spark, sf_dir).orderBy(F.md5(c("listing_id").cast("string")), "listing_id").limit(600).select("listing_id", "lat", "lon")


for _name in ("random_sample", "q_geo_points"):
    query(f"WITH {L} SELECT listing_id, lat::double AS lat, lon::double AS lon FROM listings ORDER BY md5(cast(listing_id AS varchar)), listing_id LIMIT 600", _name)(
        lambda sp, d: _sample(sp, d).select("listing_id", c("lat").cast("double"), c("lon").cast("double")),
    )


@query(f"WITH {L}, b AS (SELECT segment, floor(area / 5) * 5 + 2.5 AS x, count(*) AS n FROM listings GROUP BY 1, 2), t AS (SELECT segment, sum(n) AS m FROM b GROUP BY 1), g AS (SELECT segment, i * 10 AS spot, x, n, m FROM b JOIN t USING (segment), range(1, 11) r(i)) SELECT segment, cast(spot AS int) AS spot, round(sum(n * exp(-0.5 * pow((spot - x) / 8, 2))) / max(m) / (8 * sqrt(2 * pi())), 6) AS density FROM g GROUP BY 1, 2")
def density_curve(spark, sf_dir):
    """Gaussian kernel density of area by segment from counts in bins of five, at ten places."""
    bins = a.listings(spark, sf_dir).groupBy("segment", (F.floor(c("area") / 5) * 5 + 2.5).alias("x")).agg(F.count("*").alias("n"))
    at = bins.withColumn("spot", F.explode(F.sequence(F.lit(10), F.lit(100), F.lit(10)))).withColumn("x", c("x").cast("double"))
    kernel = c("n") * F.exp(-0.5 * F.pow((c("spot") - c("x")) / 8, 2))
    return at.groupBy("segment", "spot").agg(F.round(F.sum(kernel) / F.sum("n") / (8 * F.sqrt(2 * F.pi())), 6).alias("density"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN -1 ELSE p_size % 4 END AS n FROM part")
def row_lambdas(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        count_before(F.when(c("p_size") % 3 != 0, F.concat((c("p_size") % 4).cast("string"), F.lit(" совм."))), "совм").alias("n"),
    )


#: A model with other constants than its defaults.
OTHER = life.Params(census_floor=0.9, closure_days=2)


@query(f"WITH {O}, {LOCATED}, {DAYS}, {covered('p.region')}, best AS (SELECT region, max(n) AS most FROM covered GROUP BY region) SELECT region, list_min(list_reverse_sort(list(d))[1:2]) AS last_day FROM covered JOIN best USING (region) WHERE n >= 0.9 * most GROUP BY region")
def model_vars(spark, sf_dir):
    obs = a.observations(spark, sf_dir)
    return life.closure_cutoff(life.region_day_census(obs, OTHER), OTHER)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'marts' WHEN o_orderkey % 3 = 1 AND trim(o_orderpriority) <> '' THEN trim(o_orderpriority) ELSE 'default' END AS schema_name FROM orders")
def macro_schema_name(spark, sf_dir):
    """Schemas of models that name their own (by constant or by row), or none."""
    given = F.when(c("o_orderkey") % 3 == 0, " marts ").when(c("o_orderkey") % 3 == 1, c("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", staging.schema_of(given).alias("schema_name"))


@query("SELECT o_custkey, count(*) AS n, max(o_totalprice) AS most FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1")
def materialize_layer(spark, sf_dir):
    """A layer of views, and one of tables made from it."""
    views = staging.materialize_layer(spark, {"stg_orders": table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")}, "", as_views=True)
    by_customer = views["stg_orders"].groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("most"))
    return staging.materialize_layer(spark, {"by_customer": by_customer}, scratch_path(spark, "layer"))["by_customer"]


def _registry(spark, sf_dir):
    path = scratch_path(spark, "registry")
    table(spark, sf_dir, "part").select(F.floor("p_retailprice").alias("price"), F.lit(77).alias("id_region"), F.lit(55.5).alias("geo_lat"), F.lit(37.5).alias("geo_lon"), c("p_size").alias("level"), F.lit(60).alias("levels"), F.lit(-1).alias("rooms"), F.lit(30).alias("area"), F.lit(2).alias("object_type"), F.lit(3).alias("building_type")).coalesce(1).write.csv(f"{path}/deep/er", header=True, sep=";")
    return files.scan_registry(spark, "flats_b", path, "price long, id_region int, geo_lat double, geo_lon double, level int, levels int, rooms int, area double, object_type int, building_type int").select("price", c("floor").cast("int"), "city", "building_type")


query("SELECT cast(floor(p_retailprice) AS bigint) AS price, p_size AS floor, 'Москва' AS city, 'Кирпичный' AS building_type FROM part", "scan_registry")(_registry)


def _plugin(df):
    """A source that isn't built in: prices in thousands, rooms as words."""
    return flats.align(df, {"price": (c("thousands") * 1000).cast("bigint"), "rooms": mapped(c("size"), {"one": 1, "two": 2}).cast("int"), "city": c("town")})


@query("SELECT cast(p_size * 1000 AS bigint) AS price, CASE p_partkey % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 END::int AS rooms, p_brand AS city FROM part")
def transform_plugins(spark, sf_dir):
    """A transform registered at run time, found by its name."""
    if "flats_own" not in flats.REGISTRY:
        flats.register("flats_own", "\t", _plugin)
    path = scratch_path(spark, "plugin")
    own = table(spark, sf_dir, "part")
    own.select(c("p_size").alias("thousands"), F.when(c("p_partkey") % 3 == 1, "one").when(c("p_partkey") % 3 == 2, "two").otherwise("many").alias("size"), c("p_brand").alias("town")).coalesce(1).write.csv(path, header=True, sep="\t")
    return files.scan_registry(spark, "flats_own", path, "thousands long, size string, town string").select("price", c("rooms").cast("int"), "city")


def _write_documents(docs, path: str) -> None:
    """A folder with one file for each (doc, value): written by the tasks at once, as a committer would move each file on its own
    on the driver. A task that is repeated writes the same files."""

    def write(batches):
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for doc, value in zip(batch.column("doc").to_pylist(), batch.column("value").to_pylist(), strict=True):
                fs.create_dir(f"{root}/doc={doc}", recursive=True)
                with fs.open_output_stream(f"{root}/doc={doc}/part.txt") as sink:
                    sink.write(f"{value}\n".encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    docs.mapInArrow(write, "n long").agg(F.sum("n")).collect()


@query("SELECT 'doc=' || s_suppkey AS doc_id, s_name FROM supplier WHERE s_suppkey % 10 <> 3")
def scan_json_docs(spark, sf_dir):
    path = scratch_path(spark, "docs")
    own = table(spark, sf_dir, "supplier").select(
        c("s_suppkey").cast("string").alias("doc"),
        F.when(c("s_suppkey") % 10 == 3, "{broken").otherwise(F.to_json(F.struct("s_name"))).alias("value"),
    )
    _write_documents(spread(own), path)
    return files.scan_json_docs(spark, path, "s_name string", "*.txt")[0]


@query("SELECT s_name AS name, CASE s_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS rings, 4 AS points FROM supplier")
def scan_geojson(spark, sf_dir):
    """Plain areas, areas with a hole, and areas of two parts of which one has a hole; a feature a line."""
    path = scratch_path(spark, "polygons")
    x = c("s_suppkey").cast("double")

    def square(at: float, size: float):
        return F.array(*[F.array(x + at + dx * size, F.lit(at + dy * size)) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1))])

    whole, hole, far = square(0.0, 1.0), square(0.25, 0.5), square(5.0, 1.0)
    geometry = F.when(c("s_suppkey") % 3 == 0, F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(whole).alias("coordinates"))))
    geometry = geometry.when(c("s_suppkey") % 3 == 1, F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(whole, hole).alias("coordinates"))))
    geometry = geometry.otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(whole, hole), F.array(far)).alias("coordinates"))))
    text = F.concat(F.lit('{"features":[{"properties":{"name":"'), "s_name", F.lit('"},"geometry":'), geometry, F.lit("}]}"))
    table(spark, sf_dir, "supplier").select(text.alias("value")).write.text(path)
    return files.scan_geojson(spark, path, lines=True).select("name", F.size("rings").alias("rings"), F.size("ring").alias("points"))


def flat_inputs(spark, sf_dir):
    """Listings with the columns that features are made from."""
    own = a.listings(spark, sf_dir)
    id_ = c("listing_id")
    return own.select(
        "listing_id", c("price").alias("price_first"), c("area").alias("total_area"), "is_studio", "region", "municipality", F.nullif("segment", F.lit("BUILDING")).alias("building_type"),
        F.when(id_ % 13 != 0, c("rooms")).alias("rooms"), F.when(id_ % 3 != 0, c("area") / 4).alias("kitchen_area"), F.when(id_ % 4 != 0, 1480 + id_ % 500).alias("year_built"),
        (id_ % 2).alias("is_new_building"), F.when(id_ % 7 < 4, F.concat((id_ % 4 + 1).cast("string"), F.lit(" кв. "), (2000 + id_ % 7).cast("string"))).alias("completion_date"),
        (id_ % 9).alias("floor"), F.lit(8).alias("total_floors"), F.when(id_ % 5 == 0, "1 разд., 2 совм.").alias("bathrooms"),
    )


#: Fitted on four fifths of the listings, applied to all.
_FLAT_INPUTS = f"""WITH {L}, x AS (
  SELECT listing_id, price / area AS ppm, area, municipality, coalesce(nullif(segment, 'BUILDING'), 'unknown') AS kind, CASE WHEN is_studio THEN 0 WHEN listing_id % 13 <> 0 THEN rooms END AS rooms,
    CASE WHEN listing_id % 3 <> 0 THEN area / 4 END AS kitchen, CASE WHEN listing_id % 4 <> 0 AND listing_id % 500 >= 20 THEN 1480 + listing_id % 500 END AS built, floor(area / 5) AS bin, listing_id % 5 <> 0 AS known
  FROM listings),
y AS (SELECT x.* EXCLUDE (rooms), coalesce(rooms, (SELECT median(rooms) FROM x WHERE known))::double AS rooms FROM x),
kitchens AS (SELECT kind, bin, median(kitchen) AS k FROM y WHERE known GROUP BY ALL),
ages AS (SELECT kind, median(built) AS b FROM y WHERE known GROUP BY ALL),
usual AS (SELECT municipality, rooms, median(ppm) AS u FROM y WHERE known GROUP BY ALL)"""


@query(
    f"""{_FLAT_INPUTS} SELECT listing_id, kind AS building_type, rooms, round(coalesce(kitchen, k, (SELECT median(kitchen) FROM y WHERE known)), 4) AS kitchen_area, round(2002 - coalesce(built, b), 4) AS building_age,
    round(ppm / coalesce(u, (SELECT median(ppm) FROM y WHERE known)), 6) AS ppm2_to_municipality, round(area / greatest(rooms, CASE WHEN rooms = 0 THEN 1 ELSE rooms END), 6) AS area_per_room,
    CASE WHEN listing_id % 5 = 0 THEN 2 ELSE -1 END::double AS bath_combined
    FROM y LEFT JOIN kitchens USING (kind, bin) LEFT JOIN ages USING (kind) LEFT JOIN usual USING (municipality, rooms)"""
)
def feature_builder(spark, sf_dir):
    """Features fitted on some listings and applied to all."""
    own = flat_inputs(spark, sf_dir)
    made = features.fit(own.filter("listing_id % 5 <> 0"), 2002).transform(own, "listing_id")
    rounded = {"kitchen_area": 4, "building_age": 4, "ppm2_to_municipality": 6, "area_per_room": 6}
    return made.select("listing_id", "building_type", "rooms", "bath_combined", *[F.round(k, n).alias(k) for k, n in rounded.items()])


@query(
    f"""WITH {L} SELECT listing_id, CASE WHEN listing_id % 7 < 4 THEN 2000 + listing_id % 7 END::double AS completion_year, CASE WHEN listing_id % 7 < 4 THEN listing_id % 7 - 2 END::double AS years_to_completion,
    CASE WHEN listing_id % 7 = 3 THEN 1 ELSE 0 END::double AS is_presale, CASE WHEN listing_id % 7 < 4 THEN 1 ELSE 0 END::double AS has_completion,
    CASE WHEN listing_id % 7 = 3 AND listing_id % 2 = 1 THEN 0 ELSE 1 END::double AS is_ready FROM listings"""
)
def temporal_features(spark, sf_dir):
    own = flat_inputs(spark, sf_dir)
    return features.fit(own, 2002).transform(own, "listing_id").select(
        "listing_id",
        "completion_year",
        "years_to_completion",
        "is_presale",
        "has_completion",
        "is_ready",
    )


@query(
    f"""WITH {L} SELECT listing_id, (listing_id % 9 = 1)::int::double AS is_first_floor, (listing_id % 9 = 8)::int::double AS is_last_floor, round(listing_id % 9 / 8, 6)::double AS floor_ratio,
    CASE WHEN listing_id % 3 <> 0 THEN 0.25 END::double AS kitchen_to_total, 0::double AS has_lift FROM listings"""
)
def layout_features(spark, sf_dir):
    made = flat_inputs(spark, sf_dir).select(
        "listing_id",
        *[c(k).cast("double").alias(k) for k in ("floor", "total_floors", "total_area", "kitchen_area", "rooms")],
    )
    none = F.lit(None).cast("double")
    own = features.layout_features(c("floor"), c("total_floors"), c("total_area"), none, c("kitchen_area"), c("rooms"), (none, none))
    return made.select(
        "listing_id",
        *[F.round(own[k].cast("double"), 6).alias(k) for k in ("is_first_floor", "is_last_floor", "floor_ratio", "kitchen_to_total", "has_lift")],
    )
