"""Scalar functions applied to whole driver tables. Inputs are written in SQL that both engines share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from parcelog.functions import text as t, values as v
from parcelog.queries.registry import query, table
from parcelog.sources.offers import deal_type

c = F.col
MOSCOW = "INTERVAL 3 HOUR"


def scalar(name: str, source: str, key: str, inputs: dict[str, str], outputs: Callable[[], dict], sql: dict[str, str], where: str | None = None) -> None:
    """Register ``outputs`` (gives columns over ``inputs``) on a table; ``sql`` has the same outputs for the oracle."""
    given = ", ".join(f"{e} AS {k}" for k, e in inputs.items())
    own = ", ".join(f"{e} AS {k}" for k, e in sql.items())

    @query(f"SELECT {key}, {own} FROM (SELECT {key}, {given} FROM {source}{f' WHERE {where}' if where else ''}) x", name)
    def run(spark, sf_dir):
        df = table(spark, sf_dir, source)
        df = df.filter(where) if where else df
        return df.select(key, *[F.expr(e).alias(k) for k, e in inputs.items()]).select(key, *[x.alias(k) for k, x in outputs().items()])


O = {"n": "o_orderkey", "p": "cast(floor(o_totalprice) as bigint)"}  # noqa: E741
orders = lambda name, inputs, outputs, sql: scalar(name, "orders", "o_orderkey", inputs, outputs, sql)

scalar(
    "surrogate_key",
    "customer",
    "c_custkey",
    {"a": "c_name", "b": "nullif(c_nationkey, 3)", "d": "c_mktsegment"},
    lambda: {"sk": t.surrogate_key(c("a"), c("b"), c("d"))},
    {"sk": "md5(coalesce(a,'') || '|' || coalesce(cast(b as varchar),'') || '|' || coalesce(d,''))"},
)
scalar(
    "macro_surrogate_key",
    "part",
    "p_partkey",
    {"a": "p_brand", "b": "nullif(p_size, 7)"},
    lambda: {"sk": t.surrogate_key(c("a"), c("b"))},
    {"sk": "md5(coalesce(a,'') || '|' || coalesce(cast(b as varchar),''))"},
)
scalar(
    "synthetic_url",
    "part",
    "p_partkey",
    {"a": "p_name", "b": "p_size"},
    lambda: {"url": t.content_url("flats://", c("a"), c("b"))},
    {"url": "'flats://' || md5(a || '|' || cast(b as varchar))"},
)
orders(
    "parse_price_digits",
    {
        "a": "case when o_orderkey % 9 = 0 then 'no price' when o_orderkey % 10 = 0 then null else 'от ' || cast(cast(floor(o_totalprice) as bigint) as string) || ' 000 руб.' end"
    },
    lambda: {"price": t.price_digits(c("a"))},
    {"price": "try_cast(nullif(regexp_replace(a, '[^0-9]', '', 'g'), '') as bigint)"},
)
orders(
    "parse_decimal_text",
    {"a": "case when o_orderkey % 9 = 0 then 'none' when o_orderkey % 5 = 0 then null else 'area ' || cast(o_orderkey % 300 as string) || ',5 m2' end"},
    lambda: {"area": t.decimal_number(c("a"))},
    {"area": "try_cast(replace(nullif(regexp_extract(a, '([0-9]+(?:[.,][0-9]+)?)', 1), ''), ',', '.') as double)"},
)
_floors = {
    "a": """case o_orderkey % 7 when 0 then cast(o_orderkey % 30 as string) || ' из 30' when 1 then 'ground' when 2 then cast(o_orderkey % 9 as string)
      when 3 then 'этаж ' || cast(o_orderkey % 20 as string) || ' из 25, лифт' when 4 then 'этаж ' || cast(o_orderkey % 20 as string) when 5 then '' end"""
}
orders(
    "parse_floor_pair",
    _floors,
    lambda: dict(zip(("floor", "floors"), t.floor_pair(c("a")), strict=True)),
    {
        "floor": "case o_orderkey % 7 when 0 then o_orderkey % 30 when 2 then o_orderkey % 9 when 3 then o_orderkey % 20 when 4 then o_orderkey % 20 end::int",
        "floors": "case o_orderkey % 7 when 0 then 30 when 3 then 25 end",
    },
)
orders(
    "parse_rooms_title",
    {"a": """case o_orderkey % 6 when 0 then 'Студия, 25 м²' when 1 then cast(o_orderkey % 6 as string) || '-комн. квартира' when 2 then 'house'
      when 3 then 'Продажа студии' when 4 then cast(o_orderkey % 5 as string) || ' комн. квартира' end"""},
    lambda: {"rooms": t.rooms_of_title(c("a"))},
    {"rooms": "case o_orderkey % 6 when 0 then 0 when 1 then 1 when 3 then 0 when 4 then o_orderkey % 5 end::int"},
)
orders(
    "parse_year",
    {"a": "case when o_orderkey % 6 = 0 then 'soon' else 'built ' || cast(o_orderdate as string) end"},
    lambda: {"y": t.first_year(c("a"))},
    {"y": "try_cast(nullif(regexp_extract(a, '([0-9]{4})', 1), '') as int)"},
)
orders(
    "extract_id_from_url",
    {"a": "'https://example.com/' || case o_orderkey % 3 when 0 then 'flat' else 'room' end || '/' || cast(o_orderkey as string) || '/?a=1'"},
    lambda: {"id": t.id_of_url(c("a"))},
    {"id": "try_cast(nullif(regexp_extract(a, '/flat/([0-9]+)', 1), '') as bigint)"},
)
scalar(
    "normalize_district",
    "customer",
    "c_custkey",
    {"a": "case c_custkey % 4 when 0 then 'р-н ' || c_name when 1 then c_name || ' район' when 2 then 'район ' || c_name else c_name end"},
    lambda: {"district": t.district_name(c("a"))},
    {"district": "trim(regexp_replace(regexp_replace(a, '^(?:р-н|район)\\s+', ''), '\\s+район$', ''))"},
)
_REGION_NAMES = [
    "Москва",
    "Московская область",
    "Санкт-Петербург",
    "Ленинградская область",
    "Еврейская автономная область",
    "Ханты-Мансийский автономный округ - Югра",
    "Республика Татарстан",
    "Алтайский край",
    "Тульская область",
]
_REGION_KEYS = ["msk", "mo", "spb", "lo", "еврейская", "ханты_мансийский_югра", "татарстан", "алтайский", "тульская"]
scalar(
    "normalize_region", "customer", "c_custkey",
    {"a": "case " + " ".join(f"when c_custkey % 10 = {i} then '{x}'" for i, x in enumerate(_REGION_NAMES)) + " else c_name end"},
    lambda: {"key": t.region_key(c("a"))},
    {"key": "case " + " ".join(f"when c_custkey % 10 = {i} then '{x}'" for i, x in enumerate(_REGION_KEYS)) + " else replace(replace(lower(a), '#', '_'), ' ', '_') end"},
)
orders(
    "room_keys",
    {"a": "'room' || cast(o_orderkey % 10 as string) || '=1&room' || cast(o_orderkey % 7 as string) || '=0&x=2'"},
    lambda: {"keys": F.array_join(t.room_keys(c("a")), ",")},
    {"keys": """case when o_orderkey % 10 = 9 then 'studio' when least(o_orderkey % 10, 5) = least(o_orderkey % 7, 5) then replace(cast(least(o_orderkey % 7, 5) as varchar), '5', '5+')
      else replace(concat_ws(',', least(o_orderkey % 10, o_orderkey % 7, 5), least(greatest(o_orderkey % 10, o_orderkey % 7), 5)), '5', '5+') end"""},
)
_label = lambda x: f"case when {x} >= 1000000 then cast({x} // 1000000 as varchar) || case when {x} % 1000000 > 0 then '.5' else '' end || 'M' else cast({x} // 1000 as varchar) || 'K' end"
orders(
    "price_label",
    {"lo": "case when o_orderkey % 5 = 0 then null else (o_orderkey % 9) * 500000 end", "hi": "case when o_orderkey % 7 = 0 then null else (o_orderkey % 9 + 1) * 500000 end"},
    lambda: {"label": t.price_label(c("lo"), c("hi"))},
    {"label": f"coalesce({_label('lo')}, '') || '-' || coalesce({_label('hi')}, '+')"},
)
orders(
    "parse_views",
    {"a": "case when o_orderkey % 8 = 0 then 'nobody' when o_orderkey % 8 = 1 then '7 просмотров' else '1\u00a0' || cast(100 + o_orderkey % 900 as string) || ' просмотров, 2 ' || cast(100 + o_orderkey % 50 as string) || ' за сегодня' end"},
    lambda: dict(zip(("total", "today"), t.view_counts(c("a")), strict=True)),
    {"total": "case when o_orderkey % 8 = 1 then 7 when o_orderkey % 8 > 1 then 1100 + o_orderkey % 900 end::int", "today": "case when o_orderkey % 8 > 1 then 2100 + o_orderkey % 50 end::int"},
)
orders(
    "completion_text",
    {"q": "case o_orderkey % 5 when 0 then 'first' when 1 then 'third' when 2 then 'fourth' when 3 then 'spring' end", "y": "case when o_orderkey % 3 = 0 then null else 2020 + o_orderkey % 9 end", "fq": "case when o_orderkey % 4 = 1 then '2' end", "fy": "case when o_orderkey % 4 < 2 then 2030 end", "f": "case when o_orderkey % 2 = 0 then o_orderpriority end"},
    lambda: {"done": t.completion_text(c("q"), c("y"), c("fq"), c("fy"), c("f"))},
    {"done": """case when o_orderkey % 3 <> 0 and o_orderkey % 5 < 4 then ['1', '3', '4', 'spring'][o_orderkey % 5 + 1] || ' кв. ' || (2020 + o_orderkey % 9)
      when o_orderkey % 3 <> 0 then cast(2020 + o_orderkey % 9 as varchar) when o_orderkey % 4 = 1 then '2 кв. 2030' when o_orderkey % 4 = 0 then '2030' else f end"""},
)
orders(
    "format_counts",
    {"a": "o_orderkey % 3", "b": "case when o_orderkey % 4 = 0 then null else o_orderkey % 2 end"},
    lambda: {"baths": t.counts_text([(c("a"), "разд."), (c("b"), "совм.")])},
    {"baths": "nullif(concat_ws(', ', case when a > 0 then cast(a as varchar) || ' разд.' end, case when b > 0 then cast(b as varchar) || ' совм.' end), '')"},
)
orders(
    "count_token",
    {"a": "case o_orderkey % 4 when 0 then null when 1 then '2 совм., 1 разд.' when 2 then cast(o_orderkey % 9 as string) || ' разд.' else 'none' end"},
    lambda: {"n": t.count_before(c("a"), "разд")},
    {"n": "case when a is null then -1 else coalesce(try_cast(nullif(regexp_extract(a, '([0-9]+)\\s*разд', 1), '') as int), 0) end"},
)
orders(
    "contains_flag",
    {"a": "case o_orderkey % 4 when 0 then null when 1 then 'Apartments' when 2 then '  ' else o_orderpriority end"},
    lambda: {"is_apartments": t.contains_flag(c("a"), "apartment")},
    {"is_apartments": "case when lower(a) like '%apartment%' then true when trim(a) <> '' then false end"},
)
scalar("strip_query", "pages", "page_id", {"a": "url"}, lambda: {"url": t.without_query(c("a"))}, {"url": "split_part(a, '?', 1)"})
orders(
    "make_link",
    {"a": "o_orderkey"},
    lambda: {"link": F.format_string("https://example.com/flat/%d/", c("a"))},
    {"link": "'https://example.com/flat/' || cast(a as varchar) || '/'"},
)
scalar(
    "extract_links",
    "pages",
    "page_id",
    {"a": "html"},
    lambda: {"links": F.array_join(t.links(c("a"), 'href="([^"]+)"'), " ")},
    {
        "links": "(select coalesce(string_agg(u, ' ' order by i), '') from (select u, min(i) as i from (select unnest(list_transform(regexp_extract_all(a, 'href=\"([^\"]+)\"', 1), lambda z: split_part(z, '?', 1))) as u, generate_subscripts(regexp_extract_all(a, 'href=\"([^\"]+)\"', 1), 1) as i) group by u))"
    },
)
scalar(
    "block_flags", "pages", "page_id",
    {
        "s": "case page_id % 11 when 0 then 403 when 1 then 429 when 2 then 503 else 200 end",
        "h": """case page_id % 7 when 0 then '<p>SmartCaptcha' || html when 1 then 'Похоже, у вас включен VPN' || html when 2 then html || ' site_WAF_block'
          when 3 then 'Вы не робот?' || html when 4 then 'no vpn, no captcha here' else html end""",
        "u": "case when page_id % 13 = 0 then url || '/showCaptcha' else url end",
    },
    lambda: {"kind": t.page_class(c("s"), c("h"), c("u"))},
    {"kind": f"""case when page_id % 11 in (0, 1, 2) or (page_id % 7 = 2 and length(h) <= {t.HEAD}) then 'waf' when page_id % 13 = 0 or page_id % 7 in (0, 3) then 'captcha'
      when page_id % 7 = 1 then 'vpn' else 'ok' end"""},
)
#: Lines of an address, o_orderkey standing for the house, and their parts.
_ADDRESSES = (
    ("Москва, ЦАО, р-н Арбат, Новинский бульвар, #", "Москва", "ЦАО", "р-н Арбат", "Новинский бульвар", "#"),
    ("Тула, #, наб. Дрейера, #, 5", "Тула", None, None, "наб. Дрейера", "#"),
    ("Москва, ЗАО, Район Раменки, Мосфильмовская, #", "Москва", "ЗАО", "Район Раменки", "Мосфильмовская", "#"),
    ("Мытищи, улица Мира, проезд Труда", "Мытищи", None, None, "проезд Труда", None),
    ("Москва, Арбат", "Москва", None, None, None, None),
)
_line = lambda x: "null" if x is None else "'" + x.replace("#", "' || cast(o_orderkey % 90 as varchar(9)) || '") + "'"
_of_line = lambda k: "case " + " ".join(f"when o_orderkey % 6 = {i} then {_line(x[k])}" for i, x in enumerate(_ADDRESSES)) + " end"
orders(
    "parse_address",
    {"a": _of_line(0)},
    lambda: t.address_parts(c("a")),
    dict(zip(("city", "region", "district", "street", "house_number"), map(_of_line, range(1, 6)), strict=True)),
)

orders(
    "days_between",
    {"a": "o_orderdate", "b": "timestamp '2000-01-01 12:00:00'"},
    lambda: {"days": v.days_between(c("a"), c("b"))},
    {"days": "date_diff('day', cast(a as date), cast(b as date))"},
)
orders("month_trunc", {"a": "o_orderdate"}, lambda: {"m": v.month_of(c("a"))}, {"m": "cast(date_trunc('month', a) as date)"})
orders("year_part", {"a": "o_orderdate"}, lambda: {"y": F.year("a")}, {"y": "cast(extract(year from a) as int)"})
scalar("tz_convert", "events", "event_id", {"a": "ts"}, lambda: {"d": v.local_date(c("a"))}, {"d": f"cast(a + {MOSCOW} as date)"})
scalar("relative_window", "events", "event_id", {"a": "value"}, lambda: {"a": c("a")}, {"a": "a"}, where="ts >= timestamp '2024-01-31' - interval '2' day")
orders(
    "guarded_ts_cast",
    {"a": "case o_orderkey % 4 when 0 then 'today' when 1 then null else '2024-0' || cast(1 + o_orderkey % 9 as string) || '-02 10:00:00' end"},
    lambda: {"ts": v.guarded_timestamp(c("a")).cast("timestamp_ntz")},
    {"ts": f"case when regexp_matches(a, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') then try_cast(a as timestamp) - {MOSCOW} end"},
)
orders(
    "to_timestamp_coerce",
    {"a": "case o_orderkey % 3 when 0 then 'bad' else cast(o_orderdate as string) end"},
    lambda: {"ts": F.try_to_timestamp("a").cast("timestamp_ntz")},
    {"ts": "try_cast(a as timestamp)"},
)
scalar("strip_tz", "events", "event_id", {"a": "ts"}, lambda: {"ts": c("a").cast("timestamp").cast("timestamp_ntz")}, {"ts": "a"})

scalar(
    "haversine_center",
    "embeddings",
    "vec_id",
    {"a": "55 + cast(vec_id % 100 as double) / 100", "b": "37 + cast(vec_id % 77 as double) / 100"},
    lambda: {"km": F.round(v.haversine_km(c("a").cast("double"), c("b").cast("double"), F.lit(55.7558), F.lit(37.6173)), 4)},
    {
        "km": "round(2 * 6371.0 * asin(sqrt(pow(sin((radians(55.7558) - radians(cast(a as double))) / 2), 2) + cos(radians(cast(a as double))) * cos(radians(55.7558)) * pow(sin((radians(37.6173) - radians(cast(b as double))) / 2), 2))), 4)"
    },
)
orders(
    "round_half_even_int",
    {"a": "(o_orderkey % 41) / 2.0"},
    lambda: {"r": v.nearest_int(c("a").cast("double"))},
    {"r": "cast(round_even(cast(a as double), 0) as bigint)"},
)
orders(
    "round_half_up_dec",
    {"a": "o_totalprice"},
    lambda: {"r": v.rounded_decimal(c("a"), 1).cast("double")},
    {"r": "cast(round(cast(a as decimal(30,7)), 1) as double)"},
)
scalar("bin_floor", "part", "p_partkey", {"a": "p_size"}, lambda: {"b": v.bin_floor(c("a"), 5).cast("bigint")}, {"b": "cast(floor(a / 5) * 5 as bigint)"})
scalar(
    "safe_ratio",
    "part",
    "p_partkey",
    {"a": "p_retailprice", "b": "cast(p_size % 4 as double)"},
    lambda: {"r": F.round(v.safe_ratio(c("a"), c("b")), 6)},
    {"r": "round(a / nullif(b, 0), 6)"},
)
scalar(
    "price_per_m2",
    "part",
    "p_partkey",
    {"a": "p_retailprice", "b": "cast(p_size % 9 as double)"},
    lambda: {"ppm2": v.safe_ratio(c("a"), c("b")).cast("bigint")},
    {"ppm2": "cast(trunc(a / nullif(b, 0)) as bigint)"},
)
scalar(
    "price_dynamics",
    "part",
    "p_partkey",
    {"f": "p_retailprice", "l": "p_retailprice - p_size + 25", "a": "p_retailprice - 30", "b": "p_retailprice + p_size"},
    lambda: {k: F.round(x, 6) if k != "had_discount" else x for k, x in v.price_dynamics(c("f"), c("l"), c("a"), c("b")).items()},
    {"had_discount": "cast(l < f as int)", "drop_pct": "round((f - l) / nullif(f, 0) * 100, 6)", "range_pct": "round((b - a) / nullif(a, 0) * 100, 6)"},
)
scalar("bool_to_int", "part", "p_partkey", {"a": "nullif(p_size, 9)"}, lambda: {"f": v.flag(c("a") < 20)}, {"f": "coalesce(cast(a < 20 as int), 0)"})
orders(
    "coerce_numeric",
    {"a": "case o_orderkey % 5 when 0 then 'NaN' when 1 then 'x' when 2 then 'Infinity' else cast(o_orderkey as string) || '.5' end"},
    lambda: {"x": v.number_or_null(c("a"))},
    {"x": "case when isfinite(try_cast(a as double)) then try_cast(a as double) end"},
)
orders(
    "nan_inf_to_null",
    {"a": "case o_orderkey % 4 when 0 then cast('NaN' as double) when 1 then cast('-Infinity' as double) else o_totalprice end"},
    lambda: {"x": v.finite(c("a"))},
    {"x": "case when isfinite(a) then a end"},
)
orders(
    "tolerant_int",
    {"a": "case o_orderkey % 3 when 0 then 'x1' else cast(o_orderkey as string) end"},
    lambda: {"x": c("a").try_cast("int")},
    {"x": "try_cast(a as int)"},
)
orders(
    "coalesce_chain",
    {"a": "case when o_orderkey % 2 = 0 then o_custkey end", "b": "case when o_orderkey % 3 = 0 then o_orderkey end"},
    lambda: {"seller": F.coalesce(c("a"), c("b"), -c("o_orderkey"))},
    {"seller": "coalesce(a, b, -o_orderkey)"},
)
orders(
    "bool_normalize",
    {"a": "case o_orderkey % 6 when 0 then 't' when 1 then 'F' when 2 then 'True' when 3 then '0' when 4 then 'maybe' end"},
    lambda: {"b": v.normalized_flag(c("a"))},
    {"b": "case when lower(trim(a)) in ('t','true','1') then 1 when lower(trim(a)) in ('f','false','0') then 0 end"},
)
orders(
    "blank_to_null",
    {"a": "case o_orderkey % 5 when 0 then ' NaN ' when 1 then '' when 2 then 'None' else o_orderpriority end"},
    lambda: {"x": v.blank_to_null(c("a"))},
    {"x": "case when lower(trim(a)) not in ('', 'nan', 'none') then a end"},
)
orders(
    "fill_unknown",
    {"a": "case when o_orderkey % 3 = 0 then null else o_orderpriority end"},
    lambda: {"x": F.coalesce(c("a"), F.lit("unknown"))},
    {"x": "coalesce(a, 'unknown')"},
)
orders(
    "room_group",
    {"r": "case when o_orderkey % 8 = 7 then null else o_orderkey % 8 end", "s": "o_orderkey % 5 = 0"},
    lambda: {"g": v.room_group(c("r"), c("s"))},
    {"g": "case when s then 'studio' when r is null then 'unknown' when r >= 5 then '5+' else cast(r as varchar) end"},
)
scalar(
    "map_lookup_default",
    "customer",
    "c_custkey",
    {"a": "case c_custkey % 4 when 0 then 'ASIA' when 1 then 'EUROPE' when 2 then null else c_mktsegment end"},
    lambda: {"lat": v.mapped(c("a"), {"ASIA": 55.75, "EUROPE": 59.9}, 56.0)},
    {"lat": "cast(case a when 'ASIA' then 55.75 when 'EUROPE' then 59.9 else 56.0 end as double)"},
)
scalar(
    "label_map_join",
    "customer",
    "c_custkey",
    {"a": "case c_custkey % 3 when 0 then 'ASIA' when 1 then null else c_mktsegment end"},
    lambda: {"label": F.coalesce(v.mapped(c("a"), {"ASIA": "Asia (map)"}), c("a"))},
    {"label": "case a when 'ASIA' then 'Asia (map)' else a end"},
)
scalar(
    "value_map",
    "part",
    "p_partkey",
    {"a": "p_size % 6"},
    lambda: {"kind": v.mapped(c("a"), {1: "panel", 2: "monolith", 3: "brick"}, "other")},
    {"kind": "case a when 1 then 'panel' when 2 then 'monolith' when 3 then 'brick' else 'other' end"},
)
scalar(
    "series_fractions",
    "part",
    "p_partkey",
    {"k": "p_size % 5"},
    lambda: {"f": F.array_join(F.transform(v.fractions(c("k")), lambda x: F.round(x, 4).cast("string")), ",")},
    {"f": "coalesce(array_to_string(list_transform(range(1, k), lambda i: cast(round(i / k, 4) as varchar)), ','), '')"},
)
_stations = "case event_id % 4 when 0 then null when 1 then '[]' else '[[\"S' || cast(user_id as string) || '\",' || cast(event_id % 30 as string) || ',\"' || case when event_id % 3 = 0 then 'walk' else 'bus' end || '\"],[\"B\",7,\"walk\"]]' end"
scalar(
    "json_array_len",
    "events",
    "event_id",
    {"a": _stations},
    lambda: {"n": v.station_fields(c("a"))["n"]},
    {"n": "cast(coalesce(json_array_length(a), 0) as int)"},
)
scalar(
    "json_path",
    "events",
    "event_id",
    {"a": _stations},
    lambda: {k: v.station_fields(c("a"))[k] for k in ("name", "minutes", "walk")},
    {
        "name": "json_extract_string(a, '$[0][0]')",
        "minutes": "cast(json_extract_string(a, '$[0][1]') as int)",
        "walk": "json_extract_string(a, '$[0][2]') = 'walk'",
    },
)
scalar(
    "array_len_or_null",
    "embeddings",
    "vec_id",
    {"a": "case when vec_id % 3 = 0 then null else embedding end"},
    lambda: {"n": F.nullif(v.array_len(c("a")), F.lit(0)), "none": v.array_len(c("a")) == 0},
    {"n": "nullif(coalesce(len(a), 0), 0)", "none": "coalesce(len(a), 0) = 0"},
)
scalar(
    "html_embedded_json",
    "pages",
    "page_id",
    {
        "h": "case page_id % 3 when 0 then html when 1 then html || '\"offerData\":{\"id\":' || cast(page_id as string) || ',\"s\":{\"t\":\"}\"}} tail }' else '\"offerData\":{\"id\":' end"
    },
    lambda: {"id": v.embedded_json(c("h"), '"offerData":', "id long, s struct<t:string>")["id"]},
    {"id": "case when page_id % 3 = 1 then page_id end"},
)
orders(
    "sentinel_to_null",
    {"r": "o_orderkey % 5 - 1", "y": "case when o_orderkey % 4 = 0 then 0 else 1990 end"},
    lambda: {"rooms": F.when(c("r") >= 0, c("r")), "year": F.nullif(c("y"), F.lit(0))},
    {"rooms": "case when r >= 0 then r end", "year": "nullif(y, 0)"},
)
orders(
    "recode_region",
    {"a": "o_orderpriority"},
    lambda: {"r": F.when(c("a") == "5-LOW", "LOW").otherwise(c("a"))},
    {"r": "case a when '5-LOW' then 'LOW' else a end"},
)
orders(
    "derive_deal_type",
    {"k": "case o_orderkey % 5 when 0 then 'dailyFlatRent' when 1 then 'dailyRoomRent' when 2 then 'flatRent' when 3 then 'flatSale' end", "d": "case when o_orderkey % 7 < 4 then 'rent' when o_orderkey % 7 < 6 then 'sale' end"},
    lambda: {"deal": deal_type(c("k"), c("d"))},
    {"deal": "case when o_orderkey % 5 = 0 then 'rent_day' when o_orderkey % 7 in (0, 1, 2, 3) then 'rent_long' else 'sale' end"},
)
orders(
    "alias_fallback",
    {"a": "case when o_orderkey % 2 = 0 then true end", "b": "o_orderkey % 3 = 0"},
    lambda: {"is_apartments": F.coalesce(c("a"), c("b"))},
    {"is_apartments": "coalesce(a, b)"},
)
orders("null_out_of_range", {"a": "o_orderkey % 13"}, lambda: {"x": F.when(c("a").between(2, 8), c("a"))}, {"x": "case when a between 2 and 8 then a end"})
scalar(
    "cross_field_null",
    "part",
    "p_partkey",
    {"t": "p_size", "l": "nullif(p_partkey % 40, 3)", "k": "p_partkey % 20"},
    lambda: {n: F.when(~(F.coalesce("l", F.lit(0)) + F.coalesce("k", F.lit(0)) > c("t")), c(s)) for n, s in (("living", "l"), ("kitchen", "k"))},
    {n: f"case when not (coalesce(l, 0) + coalesce(k, 0) > t) then {s} end" for n, s in (("living", "l"), ("kitchen", "k"))},
)
