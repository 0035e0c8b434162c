"""Scalar rules, with a literal for each branch."""

import pytest
from pyspark.sql import functions as F

from parcelog.functions import text as t


def values(spark, kind, given, f):
    """What ``f`` gives for each of some values of column x."""
    rows = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(given)], f"i int, {kind}")
    return [r.y for r in rows.select("i", f.alias("y")).orderBy("i").collect()]


def test_floor_pairs(spark):
    given = ["5 из 9", "этаж 5 из 9", "12 из 25", "7", "этаж 3, последний", "цоколь", "", None]
    assert [tuple(v) for v in values(spark, "x string", given, F.struct(*t.floor_pair(F.col("x"))))] == [(5, 9), (5, 9), (12, 25), (7, None), (3, None), (None, None), (None, None), (None, None)]
    assert [tuple(v) for v in values(spark, "x string", ["5/9", "5", "x/9", None], F.struct(*t.slash_pair(F.col("x"))))] == [(5, 9), (5, None), (None, 9), (None, None)]


def test_rooms_of_titles(spark):
    given = ["Студия, 25 м²", "Продажа студии", "2-комн. квартира", "2 комн. квартира", "3 - комн", "КОМНАТА", "1комн.", None]
    assert values(spark, "x string", given, t.rooms_of_title(F.col("x"))) == [0, 0, 2, 2, 3, None, 1, None]


def test_region_keys(spark):
    given = ["Москва", "Московская область", "Санкт-Петербург", "Ленинградская область", "Еврейская автономная область", "Ханты-Мансийский автономный округ - Югра", "Республика Татарстан", "Алтайский край", "Респ. Коми", "Тульская область", None]
    want = ["msk", "mo", "spb", "lo", "еврейская", "ханты_мансийский_югра", "татарстан", "алтайский", "коми", "тульская", None]
    assert values(spark, "x string", given, t.region_key(F.col("x"))) == want


def test_room_keys(spark):
    given = ["room1=1&room2=1", "room9=1&room2=1", "room2=0&room7=1&room5=1&room2=1", "room01=1", "price=5", None]
    assert values(spark, "x string", given, t.room_keys(F.col("x"))) == [["1", "2"], ["studio"], ["2", "5+"], ["1"], [], None]


def test_price_labels(spark):
    given = [(2_500_000, 6_000_000), (None, 3_000_000), (800_000, None), (None, None), (999_999, 1_000_000), (1_234_567, 12_345_678), (0, 123_456_789), (10_000_000, 1_500_000_000)]
    want = ["2.5M-6M", "-3M", "800K-+", "-+", "999K-1M", "1.23457M-12.3457M", "0K-123.457M", "10M-1500M"]
    assert values(spark, "x long, z long", given, t.price_label(F.col("x"), F.col("z"))) == want


def test_page_classes(spark):
    given = [(503, "", ""), (429, "", ""), (403, None, None), (200, "<b>Site_WAF_Block</b>", ""), (200, "x waf_rate_limit", ""), (200, "fine", "https://e.com/showCaptcha?x"), (200, "SmartCaptcha", ""), (200, "Подтвердите, что вы не робот", ""), (200, "Похоже, у вас включен VPN", ""), (200, "use no vpn, no captcha", ""), (200, "x" * 32_768 + "smartcaptcha", ""), (200, None, None)]
    want = ["waf"] * 5 + ["captcha"] * 3 + ["vpn", "ok", "ok", "ok"]
    assert values(spark, "s int, x string, u string", given, t.page_class(F.col("s"), F.col("x"), F.col("u"))) == want


@pytest.mark.parametrize(
    ("line", "city", "region", "district", "street", "house"),
    [
        ("Москва, ЦАО, р-н Арбат, Новинский бульвар, 12", "Москва", "ЦАО", "р-н Арбат", "Новинский бульвар", "12"),
        ("Москва, наб. Тараса Шевченко, 3к2, 5", "Москва", None, None, "наб. Тараса Шевченко", "3к2"),
        ("Москва, проезд Серебрякова, 4", "Москва", None, None, "проезд Серебрякова", "4"),
        ("Москва, ЗАО, Район Раменки, Мосфильмовская, 8с1", "Москва", "ЗАО", "Район Раменки", "Мосфильмовская", "8с1"),  # no mark: the first free parts
        ("Москва, 5, ул. Мира, 7", "Москва", None, None, "ул. Мира", "7"),  # a number before the street is no house
        ("Москва, ул. Мира, ул. Труда, 7", "Москва", None, None, "ул. Труда", "7"),  # the later mark counts
        ("Москва, Арбат", "Москва", None, None, None, None),  # one part: no fallback
        ("Москва, МО, СВАО, Арбат", "Москва", "СВАО", None, "МО", "Арбат"),  # the region is the last; the other one is free
        (" Тула ,, Южный , 9", "Тула", None, None, "Южный", "9"),
        ("Тула", "Тула", None, None, None, None),
        ("", None, None, None, None, None),
        (None, None, None, None, None, None),
    ],
)
def test_addresses(spark, line, city, region, district, street, house):
    (got,) = values(spark, "x string", [line], t.address(F.col("x")))
    assert (got and tuple(got)) == (None if not line else (city, region, district, street, house))
