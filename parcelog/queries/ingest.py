"""Queries of sources and sinks: driver tables dressed as the source shapes, read back through files where it matters."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelog.functions import values as v
from parcelog.queries.registry import query, table
from parcelog.sources import files, flats, offers
from parcelog.storage import scratch_path, spread

c = F.col
_A = """SELECT p_partkey AS k, cast(floor(p_retailprice) AS bigint) AS price, CASE p_partkey % 4 WHEN 0 THEN 81 WHEN 1 THEN 3 ELSE 7 END AS region, 54.0 + p_size / 10 AS geo_lat, 34.5 + p_size / 8 AS geo_lon,
  p_size AS level, CASE WHEN p_size % 9 = 0 THEN 70000 ELSE 50 END AS levels, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size * 11 END AS area, p_partkey % 5 - 1 AS rooms, p_partkey % 3 AS object_type, p_partkey % 7 AS building_type, p_name AS date FROM part"""
_BT = "CASE building_type " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in flats.BUILDING_TYPES.items()) + " END"


def _coded(name: str, region: str, codes: tuple[int, int]) -> None:
    source = _A.replace(" AS region", f" AS {region}").replace("WHEN 0 THEN 81 WHEN 1 THEN 3", f"WHEN 0 THEN {codes[0]} WHEN 1 THEN {codes[1]}").replace("p_size / 10", "cast(p_size AS double) / 10").replace("p_size / 8", "cast(p_size AS double) / 8")
    sql = f"SELECT price, CASE {region} WHEN {codes[0]} THEN '{flats.CITY}' ELSE '{flats.AROUND}' END AS city, cast(level AS int) AS floor, cast(CASE WHEN levels < 32768 THEN levels END AS int) AS total_floors, cast(area AS double) AS total_area, cast(CASE WHEN rooms >= 0 THEN rooms END AS int) AS rooms, {_BT} AS building_type, object_type = 2 AS is_new_building, '{name}' AS source FROM ({source}) WHERE {region} IN {codes} AND geo_lat BETWEEN 54.2 AND 57.0 AND geo_lon BETWEEN 35.0 AND 40.5 AND price > 0 AND (area IS NULL OR area BETWEEN 5 AND 500)"

    @query(sql, name)
    def run(spark, sf_dir):
        own = spark.sql(source.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part")).drop("k")
        return flats.REGISTRY[name][1](own).select(
            "price",
            "city",
            c("floor").cast("int"),
            c("total_floors").cast("int"),
            c("total_area").cast("double"),
            c("rooms").cast("int"),
            "building_type",
            "is_new_building",
            "source",
        )


_coded("flats_a", "region", (81, 3))
_coded("flats_b", "id_region", (77, 50))


@query(f"SELECT cast(p_retailprice AS bigint) AS price, p_size AS rooms, coalesce(CASE p_type WHEN 'ECONOMY' THEN 'Косметический' END, p_type) AS renovation, CASE WHEN p_size % 2 = 0 THEN '{flats.CITY}' ELSE 'Other' END AS city FROM part")
def flats_c(spark, sf_dir):
    own = table(spark, sf_dir, "part").select(
        F.bround("p_retailprice").cast("bigint").alias("Price"),
        c("p_size").alias("Number of rooms"),
        F.lit(1).alias("Area"),
        F.lit(1).alias("Living area"),
        F.lit(1).alias("Kitchen area"),
        F.lit(1).alias("Floor"),
        F.lit(1).alias("Number of floors"),
        F.when(c("p_type") == "ECONOMY", "Cosmetic").otherwise(c("p_type")).alias("Renovation"),
        F.when(c("p_size") % 2 == 0, "Moscow").otherwise("Other").alias("Region"),
    )
    return flats.flats_c(own).select("price", c("rooms").cast("int"), "renovation", "city")


@query("SELECT 'http://x/' || p_partkey AS url, p_size AS total_floors, p_partkey % 3 = 1 AS is_new_building, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 4 = 1 END AS is_apartments FROM part")
def flats_d(spark, sf_dir):
    own = table(spark, sf_dir, "part").select(
        F.concat(F.lit("http://x/"), "p_partkey").alias("link"),
        c("p_retailprice").alias("price"),
        c("p_size").alias("number_of_floors"),
        F.lit(2000).alias("construction_year"),
        F.lit(2).alias("number_of_rooms"),
        F.lit("r").alias("region_of_moscow"),
        (c("p_partkey") % 3).alias("is_new"),
        F.when(c("p_partkey") % 4 != 0, c("p_partkey") % 4).alias("is_apartments"),
    )
    return flats.flats_d(own).select("url", c("total_floors").cast("int"), "is_new_building", "is_apartments")


@query(f"SELECT p_size AS floor, 60 AS total_floors, CASE p_partkey % 3 WHEN 0 THEN 'Панельный' WHEN 1 THEN NULL ELSE 'X' END AS building_type, CASE WHEN p_partkey % 2 = 1 THEN 1990 END AS year_built, p_partkey % 5 = 0 AS is_new_building FROM part WHERE p_partkey % 7 <> 0")
def flats_e(spark, sf_dir):
    own = table(spark, sf_dir, "part").select(
        F.when(c("p_partkey") % 7 != 0, flats.CITY).otherwise("x").alias("city"),
        c("p_retailprice").alias("price"),
        F.concat(c("p_size").cast("string"), F.lit("/60")).alias("level"),
        F.lit(1).alias("area"),
        F.when(c("p_partkey") % 3 == 0, "Панель").when(c("p_partkey") % 3 == 1, "0").otherwise("X").alias("material"),
        F.lit("9").alias("price_by_meter"),
        F.lit(1).alias("longitude"),
        F.lit(1).alias("latitude"),
        F.lit("d").alias("published"),
        (c("p_partkey") % 2 * 1990).alias("build_year"),
        F.when(c("p_partkey") % 5 == 0, "Новостройка").alias("object_type"),
    )
    return flats.flats_e(own).select(c("floor").cast("int"), c("total_floors").cast("int"), "building_type", c("year_built").cast("int"), "is_new_building")


_SHEET_SQL = "SELECT cast(floor(p_retailprice) AS bigint) AS price, p_size AS rooms, CASE WHEN p_partkey % 2 = 1 THEN 'Кирпичный' END AS building_type, CASE WHEN p_partkey % 3 = 1 THEN 'Есть' END AS balcony, p_partkey % 4 = 1 AS is_new_building, 9 AS total_floors, 3 AS floor FROM part"


def _sheet(spark, sf_dir):
    values = {2: c("p_size"), 3: F.floor("p_retailprice"), 10: c("p_partkey") % 2, 12: c("p_partkey") % 3, 14: c("p_partkey") % 4, 15: F.lit(9), 16: F.lit(3)}
    return table(spark, sf_dir, "part").select(*[values.get(i, F.lit(1)).alias("repeated") for i in range(18)])


def _flat_sheet(own):
    return flats.flats_f(own).select(
        "price",
        c("rooms").cast("int"),
        "building_type",
        "balcony",
        "is_new_building",
        c("total_floors").cast("int"),
        c("floor").cast("int"),
    )


query(_SHEET_SQL, "flats_f")(lambda s, d: _flat_sheet(_sheet(s, d)))


@query(_SHEET_SQL)
def scan_sheet(spark, sf_dir):
    """A sheet's CSV whose header is no help."""
    path, own = scratch_path(spark, "sheet"), _sheet(spark, sf_dir)
    own.toDF(*[f"h{i % 2}_{i}" for i in range(len(own.columns))]).write.csv(path, header=True, sep=";")
    numbers = {2: "int", 3: "bigint", 10: "bigint", 12: "bigint", 14: "bigint", 15: "int", 16: "int"}
    read = files.scan_sheet(spark, path, 18, ";")
    return _flat_sheet(read.select(*[c(k).cast(numbers.get(i, "int")).alias("repeated") for i, k in enumerate(read.columns)]))


@query(
    """SELECT 'flats_g_' || p_partkey AS url, cast(floor(p_retailprice) AS bigint) AS price, cast(p_size * 1000 AS bigint) AS price_per_m2, p_size % 5 AS rooms, p_size + 0.5::double AS total_area,
      p_size AS floor, CASE WHEN p_size % 2 = 0 THEN 50 END AS total_floors, 1950 + p_size AS year_built, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_new_building,
      'Тула' AS city, CASE WHEN p_size % 3 = 0 THEN 'р-н Южный' END AS district, 'улица Мира' AS street, cast(p_size AS varchar) AS house_number, p_brand AS parking, 'free' AS deal_conditions,
      CASE WHEN p_partkey % 4 > 0 THEN '[["S \\"1\\"",' || p_size || '],["",null]]' END AS metro_stations FROM part"""
)
def flats_g(spark, sf_dir):
    size = c("p_size").cast("string")
    summary = {
        "Общая площадь": F.concat(size, F.lit(",5 м²")),
        "Этаж": F.when(c("p_size") % 2 == 0, F.concat(size, F.lit(" из 50"))).otherwise(F.concat(F.lit("этаж "), size)),
        "Год постройки": F.concat(F.lit("дом "), (c("p_size") + 1950).cast("string"), F.lit(" года")),
        "Тип жилья": F.when(c("p_partkey") % 3 == 0, "Новостройка").when(c("p_partkey") % 3 == 1, "Вторичка").otherwise(""),
        "Парковка": c("p_brand"),
    }
    details = {"Цена за метр": F.concat(size, F.lit(" 000 ₽/м²")), "Условия сделки": F.lit("free"), "Этаж": F.lit("99 из 99")}
    as_map = lambda x: F.create_map(*[y for k, v in x.items() for y in (F.lit(k), v)])
    station = lambda name, time: F.struct(name.alias("station_name"), time.alias("station_time"))
    none = F.lit(None).cast("string")
    stations = F.array(station(F.lit('S "1"'), F.concat(size, F.lit(" мин."))), station(none, none))
    own = spread(table(spark, sf_dir, "part")).select(
        c("p_partkey").cast("string").alias("doc_id"),
        F.concat(F.floor("p_retailprice").cast("string"), F.lit(" ₽")).alias("price"),
        F.when(c("p_size") % 5 == 0, "Продажа студии").otherwise(F.concat((c("p_size") % 5).cast("string"), F.lit(" комн. кв."))).alias("title"),
        as_map(summary).alias("offer_summary"),
        as_map(details).alias("offer_details"),
        F.concat(F.lit("Тула, "), F.when(c("p_size") % 3 == 0, "р-н Южный, ").otherwise(""), F.lit("улица Мира, "), size).alias("address"),
        F.when(c("p_partkey") % 4 > 0, stations).otherwise(F.slice(stations, 1, 0)).alias("nearest_stations"),
        c("p_name").alias("description"),
    )
    kept = ["url", "price", "price_per_m2", "is_new_building", "city", "district", "street", "house_number", "parking", "deal_conditions", "metro_stations"]
    whole = [c(k).cast("int").alias(k) for k in ("rooms", "floor", "total_floors", "year_built")]
    return flats.flats_g(own).select(*kept, *whole, c("total_area").cast("double"))


@query("SELECT cast(p_retailprice AS bigint) AS price, cast(CASE WHEN p_size < 40 THEN p_size END AS int) AS rooms FROM part")
def align_schema(spark, sf_dir):
    own = table(spark, sf_dir, "part").select(
        F.bround("p_retailprice").cast("bigint").alias("price"),
        F.when(c("p_size") < 40, c("p_size").cast("string")).otherwise("many").alias("rooms"),
    )
    return flats.align(own, {k: c(k) for k in own.columns}).select("price", c("rooms").cast("int"))


#: Offer documents over events as JSON text, in the shape of a page's document and of the search interface.
_PLACES = """CASE event_id % 4
  WHEN 0 THEN '{"type":"location","name":"B0"},{"type":"location","shortName":"мкр Север"},{"type":"raion","name":"р-н Южный"}'
  WHEN 1 THEN '{"type":"okrug","fullName":"O1"},{"type":"location","name":"B1"}'
  WHEN 2 THEN '{"type":"location","name":"B2"},{"type":"okrug","shortName":"O2"}'
  ELSE '{"type":"mikroraion","name":"M3"},{"type":"location","name":"B3"},{"type":"location","name":""}' END"""
_OFFER = f"""concat('"id":', event_id, ',"category":"', CASE event_id % 3 WHEN 0 THEN 'dailyFlatRent' WHEN 1 THEN 'flatRent' ELSE 'flatSale' END,
  '","dealType":"', CASE WHEN event_id % 3 < 2 THEN 'rent' ELSE 'sale' END, '","totalArea":"', event_id % 90, ',5","roomsCount":', user_id % 40, ',"floorNumber":', user_id % 30,
  ',"separateWcsCount":', event_id % 2, ',"bargainTerms":{{"price":', CASE WHEN event_id % 7 = 0 THEN 0 ELSE event_id * 100 END,
  '}},"geo":{{"coordinates":{{"lat":', 40 + event_id % 5, ',"lng":37.5}},"address":[{{"type":"location","name":"A","fullName":"A full"}},', {_PLACES},
  ',{{"type":"street","name":"S"}},{{"type":"house","name":"', event_id % 9, '","id":', event_id, '}}],"undergrounds":[{{"name":"","travelTime":1}},{{"name":"U","travelTime":', event_id % 20,
  ',"travelType":"walk"}},{{"name":"V"}}],"railways":[{{"name":"R","time":5,"travelType":"transport","distance":"', event_id % 8, '"}}],"highways":[{{"name":null,"distance":"9"}}]}},"building":{{"floorsCount":20',
  CASE WHEN event_id % 6 = 0 THEN ',"demolishedInMoscowProgramm":true' ELSE '' END, '}}')"""
_AGENT = """concat('{"accountType":"', CASE WHEN event_id % 4 = 0 THEN 'homeowner' ELSE 'agency' END, '","isAgent":', CASE WHEN event_id % 4 = 0 THEN 'false' ELSE 'true' END, '}')"""
_STATS = """concat('{"totalViewsFormattedString":"', event_id % 50, ' просмотров, ', event_id % 5, ' за сегодня"}')"""
_CHANGES = """concat('[{"changeTime":"2024-01-02T10:11:12","priceData":{"price":', event_id, '}},{"changeTime":"2024-01-03","priceData":{}},{"priceData":{"price":7}}]')"""
_DOC = f"""concat('{{"offer":{{', {_OFFER}, '}},"agent":', {_AGENT}, ',"stats":', {_STATS}, ',"priceChanges":', {_CHANGES}, '}}')"""
_API = f"""concat('{{', {_OFFER}, ',"user":', {_AGENT}, ',"statistic":', {_STATS}, ',"priceChanges":', {_CHANGES}, '}}')"""


def documents(spark, sf_dir):
    own = table(spark, sf_dir, "events").select("event_id", F.expr(_DOC).alias("text"))
    return own.select("event_id", F.from_json("text", offers.DOCUMENT).alias("document"))


def api_offers(spark, sf_dir):
    own = table(spark, sf_dir, "events").select("event_id", F.expr(_API).alias("text"))
    return own.select("event_id", F.from_json("text", offers.API_OFFER).alias("offer"))


_AREA = "(event_id % 90 + 0.5::double)"
_PRICED = "FROM events WHERE event_id % 7 <> 0"
_MUNICIPALITY = "['B0', 'O1', 'O2', 'B3'][event_id % 4 + 1]"
_MAPPED = f"""event_id, ['rent_day', 'rent_long', 'sale'][event_id % 3 + 1] AS deal_type, event_id * 100 AS price, cast(floor(event_id * 100 / {_AREA}) AS bigint) AS price_per_m2,
  'A full' AS region, {_MUNICIPALITY} AS municipality, CASE WHEN event_id % 4 = 0 THEN 'Южный' END AS district, ['мкр Север', 'B1', NULL, 'M3'][event_id % 4 + 1] AS microdistrict,
  cast(event_id % 9 AS varchar) AS house, event_id AS house_id, cast(user_id % 40 AS int) AS rooms, CASE WHEN event_id % 2 = 1 THEN '1 разд.' END AS bathrooms,
  '[["U",' || event_id % 20 || ',"walk"],["V",null,null]]' AS metro_stations, '[["R",5,"transport","' || event_id % 8 || '"]]' AS railways, cast(NULL AS varchar) AS highways,
  CASE WHEN event_id % 4 = 0 THEN 'homeowner' ELSE 'agency' END AS seller_type, event_id % 4 <> 0 AS is_agent, cast(event_id % 50 AS int) AS views_total, cast(event_id % 5 AS int) AS views_today"""
_MAPPED_COLUMNS = [
    "event_id",
    "deal_type",
    "price",
    "price_per_m2",
    "region",
    "municipality",
    "district",
    "microdistrict",
    "house",
    "house_id",
    "rooms",
    "bathrooms",
    "metro_stations",
    "railways",
    "highways",
    "seller_type",
    "is_agent",
    "views_total",
    "views_today",
]
query(f"SELECT {_MAPPED}, cast(NULL AS boolean) AS seller_is_owner, cast(NULL AS boolean) AS demolished_in_renovation {_PRICED}", "map_offer")(
    lambda s, d: offers.map_offers(documents(s, d)).select(*_MAPPED_COLUMNS, "seller_is_owner", "demolished_in_renovation")
)
query(f"SELECT {_MAPPED}, event_id % 4 = 0 AS seller_is_owner, CASE WHEN event_id % 6 = 0 THEN true END AS demolished_in_renovation {_PRICED}", "map_offer_api")(
    lambda s, d: offers.map_api_offers(api_offers(s, d)).select(*_MAPPED_COLUMNS, "seller_is_owner", "demolished_in_renovation")
)
query(f"SELECT event_id, 'A full' AS region, {_MUNICIPALITY} AS municipality, 'S' AS street FROM events", "geo_address_fold")(
    lambda s, d: documents(s, d).select("event_id", v.folded_address(c("document.offer.geo.address")).alias("a")).select("event_id", "a.region", "a.municipality", "a.street")
)
query("""SELECT event_id, '[["U",' || event_id % 20 || ',"walk"],["V",null,null]]' AS metro, '[["R",5,"transport","' || event_id % 8 || '"]]' AS rail, cast(NULL AS varchar) AS road FROM events""", "transit_arrays")(
    lambda s, d: documents(s, d).select("event_id", *[v.rows_json(c(f"document.offer.geo.{source}"), *fields).alias(k) for k, source, fields in (("metro", "undergrounds", ("name", "travelTime", "travelType")), ("rail", "railways", ("name", "time", "travelType", "distance")), ("road", "highways", ("name", "distance")))])
)
query("SELECT event_id, event_id AS price, '2024-01-02' AS date FROM events", "price_history_array")(
    lambda s, d: documents(s, d).select("event_id", F.explode(v.price_history(c("document.priceChanges"))).alias("h")).select("event_id", "h.price", "h.date")
)
query(
    f"""WITH x AS (SELECT event_id, CASE WHEN event_id % 90 + 0.5 >= 5 THEN {_AREA} END AS total_area, CASE WHEN event_id % 5 > 0 THEN 40.0::double + event_id % 5 END AS lat,
      CASE WHEN event_id % 5 > 0 THEN 37.5::double END AS lon, cast(CASE WHEN user_id % 40 <= 30 THEN user_id % 40 END AS int) AS rooms, cast(user_id % 30 AS int) AS floor,
      cast(CASE WHEN user_id % 30 <= 20 THEN 20 END AS int) AS total_floors, event_id * 100 AS price {_PRICED})
    SELECT *, cast(floor(price / total_area) AS bigint) AS price_per_m2 FROM x""",
    "sanitize_rules",
)(lambda s, d: offers.sanitize(offers.map_offers(documents(s, d)).select("event_id", "total_area", "lat", "lon", "rooms", "floor", "total_floors", "price", "price_per_m2"), 2024))
query("SELECT event_id, 9 AS total, event_id + i AS id FROM events, (VALUES (0), (1)) t(i)", "explode_offers")(
    lambda s, d: offers.explode_offers(table(s, d, "events").select("event_id", F.concat(F.lit('{"offerCount":9,"offersSerialized":[{"id":'), "event_id", F.lit('},{"id":'), c("event_id") + 1, F.lit("}]}")).alias("response"))).select("event_id", "total", c("offer.id").alias("id")),
)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal").write.csv(path, header=True, sep=";")
    return files.scan_csv(spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double", ";")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 3 <> 0", "quarantine_bad_rows")
def quarantine(spark, sf_dir):
    own = table(spark, sf_dir, "customer").select(
        F.when(c("c_custkey") % 3 == 0, "x").otherwise(c("c_custkey").cast("string")).alias("c_custkey"),
        c("c_acctbal").cast("string").alias("c_acctbal"),
    )
    return files.quarantine(own, "c_custkey long, c_acctbal double")[0]


def _appended(spark, sf_dir):
    path = scratch_path(spark, "append")
    own = table(spark, sf_dir, "orders").select(
        (c("o_orderkey") % 9000).alias("url"),
        F.lit("s").alias("source"),
        F.when(c("o_orderkey") % 10 != 0, c("o_custkey")).alias("price"),
    )
    first = files.append_new(own.filter("url < 5000"), path, ["url", "source", "price"])
    second = files.append_new(own, path, ["url", "source", "price"])
    return path, first, second


_KEYS = "SELECT DISTINCT o_orderkey % 9000 AS url, 's' AS source, o_custkey AS price FROM orders WHERE o_orderkey % 10 <> 0 AND o_custkey <> 0"
query(_KEYS, "sink_append_dedup")(lambda s, d: s.read.parquet(_appended(s, d)[0]))


@query("""WITH runs AS (SELECT o_orderkey % 700 AS run_id, o_custkey AS cards, o_orderkey AS seen, o_orderkey % 2 AS batch FROM orders)
SELECT run_id, arg_min(cards, (batch, seen)) AS cards, min(batch) AS batch FROM runs GROUP BY run_id""")
def sink_insert_ignore(spark, sf_dir):
    """Statistics of runs: the first report of a run stays."""
    path = scratch_path(spark, "run-stats")
    own = table(spark, sf_dir, "orders").select(
        (c("o_orderkey") % 700).alias("run_id"),
        c("o_custkey").alias("cards"),
        c("o_orderkey").alias("seen"),
        (c("o_orderkey") % 2).alias("batch"),
    )
    for batch in (0, 1):
        files.insert_ignore(own.filter(c("batch") == batch), path, "run_id", "seen")
    return spark.read.parquet(path).drop("seen")


query(f"WITH k AS ({_KEYS}), z AS (SELECT count(*) AS p, count(*) FILTER (WHERE o_orderkey % 10 = 0 OR o_custkey = 0) AS np FROM orders), n AS (SELECT count(*) AS n FROM k WHERE url >= 5000) SELECT p AS processed, np AS no_price, n AS inserted, p - np - n AS skipped FROM z, n", "load_stats")(lambda s, d: _appended(s, d)[2])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'O'", "sink_replace_swap")
def swapped(spark, sf_dir):
    """A table published twice: the second version counts."""
    path, own = scratch_path(spark, "mart"), table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    files.publish(own.drop("o_orderstatus"), path)
    files.publish(own.filter("o_orderstatus <> 'O'").drop("o_orderstatus"), path)
    return files.published(spark, path)


@query("SELECT c_custkey, c_nationkey > 5 AS flag FROM customer", "export_csv")
def exported(spark, sf_dir):
    path = scratch_path(spark, "export")
    files.export_flat(table(spark, sf_dir, "customer").select("c_custkey", "c_name", (c("c_nationkey") > 5).alias("flag")), path, ("c_name",))
    return spark.read.csv(path, header=True, schema="c_custkey long, flag int").withColumn("flag", c("flag") == 1)


@query("SELECT o_orderkey, o_totalprice >= 250000 AS is_hot, 'https://example.com/' || o_orderkey AS link FROM orders JOIN customer ON o_custkey = c_custkey", "export_flat")
def exported_flat(spark, sf_dir):
    path = scratch_path(spark, "flat")
    own = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey")).select(
        "o_orderkey",
        (c("o_totalprice") >= 250000).alias("is_hot"),
        F.concat(F.lit("https://example.com/"), "o_orderkey").alias("link"),
        "o_orderdate",
    )
    files.export_flat(own, path, ("o_orderdate",))
    return spark.read.csv(path, header=True, schema="o_orderkey long, is_hot int, link string").withColumn("is_hot", c("is_hot") == 1)


@query("SELECT c_custkey AS id, c_name AS name, NULL::bigint AS size FROM customer UNION ALL SELECT p_partkey, p_name, p_size FROM part")
def schema_evolve(spark, sf_dir):
    return files.evolve(
        [
            table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name")),
            table(spark, sf_dir, "part").select(c("p_partkey").cast("int").alias("id"), c("p_name").alias("name"), c("p_size").alias("size")),
        ],
        "id long, name string, size long",
    )


@query(r"""SELECT page_id, url, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title, cast(len(regexp_extract_all(html, '(?i)<a\s[^>]*href=')) AS int) AS n_links, length(html) AS length FROM pages""")
def scan_html(spark, sf_dir):
    return files.scan_html(table(spark, sf_dir, "pages"))


@query("SELECT n_name, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY 1")
def scan_table(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter("c_acctbal > 0").join(table(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))


@query("SELECT obs_id, run_id, d FROM (SELECT event_id AS obs_id, 7 AS run_id, cast(ts AS date) AS d FROM events)")
def sink_observations(spark, sf_dir):
    path = scratch_path(spark, "observations")
    own = table(spark, sf_dir, "events").select(c("event_id").alias("obs_id"), F.lit(7).alias("run_id"), F.to_date("ts").alias("d"))
    own.repartition("d").write.partitionBy("d").mode("append").parquet(path)
    return spark.read.parquet(path)


@query("SELECT o_custkey AS run_id, count(*) AS cards, count(DISTINCT o_orderpriority) AS kinds FROM orders GROUP BY 1")
def sink_run_stats(spark, sf_dir):
    """A summary of each run, inserted unless the run has one: a second report of all runs adds those that are new only."""
    path = scratch_path(spark, "runs")
    runs = table(spark, sf_dir, "orders").groupBy(c("o_custkey").alias("run_id")).agg(
        F.count("*").alias("cards"),
        F.countDistinct("o_orderpriority").alias("kinds"),
    )
    files.insert_ignore(runs.filter("run_id % 3 = 0"), path, "run_id", "cards")
    files.insert_ignore(runs, path, "run_id", "cards")
    return spark.read.parquet(path)
