"""Offer documents with known flat rows, written out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from parcelog.functions import text as t, values as v
from parcelog.sources import offers


def address(spark, items):
    rows = [([(x.get("type"), x.get("name"), x.get("shortName"), x.get("fullName"), x.get("id")) for x in items] if items is not None else None,)]
    df = spark.createDataFrame(rows, f"items {offers.ADDRESS}")
    return df.select(v.folded_address(F.col("items")).alias("a")).select("a.*").first().asDict()


EMPTY = dict.fromkeys(("region", "municipality", "district", "microdistrict", "street", "house", "house_id"))


@pytest.mark.parametrize("items, known", [
    (None, {}),
    ([], {}),
    ([{"type": "location", "shortName": "Москва", "fullName": "город Москва"}, {"type": "okrug", "name": "ЦАО"}, {"type": "raion", "name": "р-н Арбат район"}, {"type": "street", "name": "Арбат"}, {"type": "house", "name": "5", "id": 77}],
     {"region": "город Москва", "municipality": "ЦАО", "district": "Арбат", "street": "Арбат", "house": "5", "house_id": 77}),
    ([{"type": "location", "name": "Область"}, {"type": "location", "name": "Химки"}, {"type": "location", "name": "Сходня"}], {"region": "Область", "municipality": "Химки", "microdistrict": "Сходня"}),
    ([{"type": "location", "name": "Область"}, {"type": "location", "name": "Жилой Комплекс Лес"}, {"type": "location", "name": "Химки"}], {"region": "Область", "municipality": "Химки", "microdistrict": "Жилой Комплекс Лес"}),
    ([{"type": "location", "name": "R"}, {"type": "location", "name": "A"}, {"type": "okrug", "name": "B"}, {"type": "okrug", "name": "C"}, {"type": "settlement", "name": "D"}, {"type": "newobject", "name": "E"}], {"region": "R", "municipality": "C", "microdistrict": "D"}),
    ([{"type": "location", "name": ""}, {"type": "location", "fullName": "F"}, {"type": None, "name": "x"}, {"type": "unknown", "name": "y"}, {"type": "house"}], {"region": "F"}),
    ([{"type": "okrug", "name": "O"}, {"type": "location", "name": "R"}, {"type": "location", "name": "A"}], {"region": "R", "municipality": "O", "microdistrict": "A"}),
])
def test_address(spark, items, known):
    assert address(spark, items) == EMPTY | known


def test_views(spark):
    texts = ["1 234 просмотра, 56 за сегодня", "1\u00a0234\u00a0просмотра, 1\u00a0002 за сегодня", "7 просмотров", "нет", "", None, ", 5 за сегодня"]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    assert [tuple(r) for r in df.select(*t.view_counts(F.col("x"))).collect()] == [(1234, 56), (1234, 1002), (7, None), (None, None), (None, None), (None, None), (None, 5)]


def test_completion(spark):
    rows = [("first", 2027, None, None, "x"), ("лето", 2027, None, None, None), (None, 2027, "2", 2030, None), (None, None, "2", 2030, "x"), (None, 0, None, 2030, "x"), ("first", None, None, None, "скоро"), (None, None, None, None, "")]
    df = spark.createDataFrame(rows, "q string, y int, fq string, fy int, i string")
    assert [r[0] for r in df.select(t.completion_text(*map(F.col, df.columns))).collect()] == ["1 кв. 2027", "лето кв. 2027", "2027", "2 кв. 2030", "2030", "скоро", None]


def test_deal_types(spark):
    df = spark.createDataFrame([("dailyFlatRent", "rent"), ("dailyRoomRent", "rent"), ("flatRent", None), ("flatSale", "sale"), (None, "rent"), (None, None)], "c string, d string")
    assert [r[0] for r in df.select(offers.deal_type(F.col("c"), F.col("d"))).collect()] == ["rent_day", "rent_long", "sale", "sale", "rent_long", "sale"]


OFFER = {
    "category": "flatSale", "dealType": "sale", "totalArea": "60,5", "livingArea": "30", "flatType": "studio", "roomsCount": 2, "floorNumber": 3, "combinedWcsCount": 1, "separateWcsCount": 2, "loggiasCount": 1,
    "repairType": "", "decoration": "fine", "passengerLiftsCount": 2, "photos": [{"id": 1}, {"id": 2}], "phones": [{"number": "1"}], "cianUserId": 9, "isByHomeowner": None, "hasFurniture": True,
    "bargainTerms": {"price": 5, "priceRur": 6050000, "currency": "rur", "mortgageAllowed": True, "utilitiesTerms": {"includedInPrice": True, "price": 12.5}},
    "geo": {"coordinates": {"lat": 55.7, "lng": 37.6}, "address": [{"type": "location", "name": "Москва"}], "undergrounds": [{"name": 'A "q"', "travelTime": 5, "travelType": "walk"}, {"name": ""}], "highways": [{"name": "H", "distance": "3.5"}], "jk": {"name": "Лес"}},
    "building": {"floorsCount": 9, "buildYear": 2001, "ceilingHeight": "2,7", "parking": {"type": "ground"}, "cargoLiftsCount": 1, "demolishedInMoscowProgramm": True, "seriesName": "П-44"},
    "newbuilding": {"name": "", "house": {"id": 4, "finishDate": {"year": 2025, "quarter": 3}}},
}
AGENT, STATS, CHANGES = {"accountType": "homeowner", "isAgent": False}, {"totalViewsFormattedString": "10 просмотров, 2 за сегодня"}, [{"changeTime": "2024-05-06T07:08", "priceData": {"price": 7}}, {"changeTime": "2024-05-07"}]
KNOWN = {
    "deal_type": "sale", "price": 6050000, "price_per_m2": 100000, "currency": "rur", "mortgage_allowed": True, "utilities_included": True, "region": "Москва", "lat": 55.7, "metro_stations": '[["A \\"q\\"",5,"walk"]]', "railways": None,
    "highways": '[["H","3.5"]]', "is_studio": True, "total_area": 60.5, "living_area": 30.0, "ceiling_height": 2.7, "renovation": "fine", "bathrooms": "2 разд., 1 совм.", "balcony": "1 лодж.", "parking": "ground", "passenger_lifts": 2, "cargo_lifts": 1,
    "is_new_building": True, "nb_house_id": 4, "developer": None, "residential_complex": "Лес", "completion_date": "3 кв. 2025", "phone_protected": False, "photos_count": 2, "views_total": 10, "views_today": 2, "seller_type": "homeowner",
    "is_agent": False, "series_name": "П-44", "has_furniture": True, "price_history": '[{"price":7,"date":"2024-05-06"}]', "total_floors": 9, "floor": 3,
}


def test_page_document(spark):
    texts = [json.dumps({"offer": OFFER, "agent": AGENT, "stats": STATS, "priceChanges": CHANGES}), json.dumps({"offer": {"bargainTerms": {"price": 0}}}), "{}", None, json.dumps({"offer": {"bargainTerms": {"price": 3}}})]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumns({"document": F.from_json("text", offers.DOCUMENT), "region": F.lit("mine")})
    full, bare = sorted(offers.map_offers(df).collect(), key=lambda r: r.id)
    assert {k: full[k] for k in KNOWN} == KNOWN and (full.seller_is_owner, full.demolished_in_renovation) == (None, None)
    assert (bare.id, bare.price, bare.deal_type, bare.region, bare.is_studio, bare.is_new_building, bare.phone_protected, bare.photos_count) == (4, 3, "sale", None, False, False, True, None)


def test_search_offer(spark):
    api = OFFER | {"user": AGENT, "statistic": STATS, "priceChanges": CHANGES}
    rows = [json.dumps(api), json.dumps(api | {"isByHomeowner": False, "demolishedInMoscowProgramm": False}), json.dumps({"bargainTerms": {"price": 3}})]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, text string").withColumn("offer", F.from_json("text", offers.API_OFFER))
    first, second, bare = sorted(offers.map_api_offers(df).collect(), key=lambda r: r.id)
    assert {k: first[k] for k in KNOWN} == KNOWN and (first.seller_is_owner, first.demolished_in_renovation) == (True, True)
    assert (second.seller_is_owner, second.demolished_in_renovation) == (False, False) and (bare.seller_is_owner, bare.demolished_in_renovation) == (False, None)
