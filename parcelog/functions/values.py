"""Dates, numbers, flags and nested values: column builders. Null in, null out unless stated."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parcelog.functions.text import district_name, let

EARTH_KM = 6371.0


def guarded_timestamp(text: Column, zone: str = "Europe/Moscow") -> Column:
    """Timestamp of a text that begins with a date, read in ``zone``; other text is null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.to_utc_timestamp(F.try_to_timestamp(text), zone))


def days_between(start: Column, end: Column) -> Column:
    """Whole days from the date of ``start`` to that of ``end``."""
    return F.datediff(F.to_date(end), F.to_date(start))


def month_of(ts: Column) -> Column:
    return F.trunc(ts, "month")


def local_date(ts: Column, zone: str = "Europe/Moscow") -> Column:
    """Date in ``zone`` of a UTC timestamp."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def haversine_km(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Great-circle distance of two places in degrees."""
    a, b = F.radians(lat), F.radians(to_lat)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(to_lon) - F.radians(lon)) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def nearest_int(x: Column) -> Column:
    """Nearest whole number, halves to the even one."""
    return F.rint(x).cast("bigint")


def rounded_decimal(x: Column, places: int) -> Column:
    """Rounded as a decimal, halves away from zero."""
    return F.round(x.cast(f"decimal(30,{places + 6})"), places)


def bin_floor(x: Column, width: float) -> Column:
    return F.floor(x / width) * width


def safe_ratio(x: Column, y: Column) -> Column:
    """x / y, null for a zero divisor."""
    return x / F.nullif(y, F.lit(0).cast("double"))


def flag(condition: Column) -> Column:
    """1 or 0, 0 where the condition is null."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def number_or_null(text: Column) -> Column:
    """Number of a text; null for other text, NaN and infinities."""
    x = text.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def price_dynamics(first: Column, last: Column, low: Column, high: Column) -> dict[str, Column]:
    return {
        "had_discount": flag(last < first),
        "drop_pct": (first - last) / F.nullif(first, F.lit(0).cast("double")) * 100,
        "range_pct": (high - low) / F.nullif(low, F.lit(0).cast("double")) * 100,
    }


def normalized_flag(value: Column) -> Column:
    """1 for t, true, 1; 0 for f, false, 0; null for anything else."""
    text = F.lower(F.trim(value.cast("string")))
    return F.when(text.isin("t", "true", "1"), 1).when(text.isin("f", "false", "0"), 0)


def blank_to_null(text: Column) -> Column:
    return F.when(~F.lower(F.trim(text)).isin("", "nan", "none"), text)


def mapped(value: Column, table: dict, default: object = None) -> Column:
    """Value of a constant map; ``default`` for others and null."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def room_group(rooms: Column, is_studio: Column) -> Column:
    return F.when(is_studio, "studio").when(rooms.isNull(), "unknown").when(rooms >= 5, "5+").otherwise(rooms.cast("string"))


def room_key(rooms: Column, is_studio: Column) -> Column:
    """The key that price bands go by: studio, 5+ or the number of rooms; null where that isn't known."""
    return F.when(is_studio, "studio").when(rooms >= 5, "5+").otherwise(rooms.cast("string"))


def fractions(k: Column) -> Column:
    """i / k for i from 1 to k - 1; none for k of 1 or less."""
    return F.when(k > 1, F.transform(F.sequence(F.lit(1), k - 1), lambda i: i / k)).otherwise(F.array().cast("array<double>"))


def array_len(array: Column) -> Column:
    return F.coalesce(F.size(array), F.lit(0))


def station_fields(json: Column) -> dict[str, Column]:
    """Name, minutes and walk flag of the first of ``[[name, minutes, mode], ...]``, and how many there are."""
    return {
        "n": F.coalesce(F.json_array_length(json), F.lit(0)),
        "name": F.get_json_object(json, "$[0][0]"),
        "minutes": F.get_json_object(json, "$[0][1]").try_cast("int"),
        "walk": F.get_json_object(json, "$[0][2]") == "walk",
    }


def embedded_json(html: Column, marker: str, schema: str) -> Column:
    """The object behind a marker in a page, parsed; null without marker or with broken text."""
    at = F.instr(html, marker)
    return F.when(at > 0, F.from_json(F.substr(html, at + len(marker)), schema))


def _given(text: Column) -> Column:
    """Text that isn't empty."""
    return F.when(text != "", text)


def compact_stations(stations: Column) -> Column:
    """Stations with a name only; null if none is left."""
    named = F.filter(stations, lambda s: F.coalesce(s["name"], F.lit("")) != "")
    return F.when(F.size(named) > 0, named)


def rows_json(items: Column, *fields: str, numbers: tuple[str, ...] = ()) -> Column:
    """JSON text ``[[name, minutes, ...], ...]`` of the named items' fields, of which some are whole numbers; null if no item has a name."""

    def value(x: Column) -> Column:  # an array of one value, without its brackets; nulls are written
        text = F.to_json(F.array(x), {"ignoreNullFields": "false"})
        return F.substring(text, 2, F.length(text) - 2)

    row = lambda s: F.concat(
        F.lit("["),
        F.concat_ws(",", *[F.coalesce(s[f].cast("string") if f in numbers else value(s[f]), F.lit("null")) for f in fields]),
        F.lit("]"),
    )
    return F.concat(F.lit("["), F.array_join(F.transform(compact_stations(items), row), ","), F.lit("]"))


def station_pairs(stations: Column) -> Column:
    """JSON text ``[[name, minutes], ...]`` of stations (station_name, station_time), the first number of the time being the
    minutes; a station without name has an empty one; null without stations."""
    minutes = lambda s: F.regexp_extract(F.coalesce(s["station_time"].cast("string"), F.lit("")), "([0-9]+)", 1).try_cast("int").cast("string")
    name = lambda s: F.regexp_replace(F.to_json(F.array(F.coalesce(s["station_name"], F.lit("")))), r"\]$", "")
    rows = F.transform(stations, lambda s: F.concat(name(s), F.lit(","), F.coalesce(minutes(s), F.lit("null")), F.lit("]")))
    return F.when(F.size(stations) > 0, F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]")))


def price_history(changes: Column) -> Column:
    """[{price, date}] of changes with a price and a time, the date being the time's day; null if there is none."""
    own = F.filter(changes, lambda c: c["priceData"]["price"].isNotNull() & (F.coalesce(c["changeTime"], F.lit("")) != ""))
    own = F.transform(own, lambda c: F.struct(c["priceData"]["price"].alias("price"), F.substring(c["changeTime"], 1, 10).alias("date")))
    return F.when(F.size(own) > 0, own)


#: Item types of small places, and words in the names of housing estates (fixed values).
SMALL_PLACES = ("mikroraion", "microdistrict", "newobject", "settlement", "poselenie")
ESTATE = "(?iu)жилой комплекс|жилой кв|квартал|микрорайон|мкр"


def folded_address(items: Column) -> Column:
    """Region, municipality, district, microdistrict, street, house and house_id from ordered typed address items.

    Items without any name don't count. The first location is the region, by its full name. The municipality is the last
    ``okrug``, else the first later location that isn't an estate. The microdistrict is the first of: small places, later
    locations that are estates, and other later locations once the municipality is known. Of districts (``raion``), streets
    and houses the last counts.
    """
    name = lambda x: F.coalesce(_given(x["shortName"]), _given(x["fullName"]), _given(x["name"]))
    named = F.transform(
        F.filter(items, lambda x: name(x).isNotNull()),
        lambda x: F.struct(x["type"].alias("type"), name(x).alias("name"), F.coalesce(_given(x["fullName"]), name(x)).alias("full"), x["id"].alias("id")),
    )

    def roles(own: Column) -> Column:
        """Each item with its role: region, place, small, or its type."""
        first = F.array_position(F.transform(own, lambda x: x["type"]), F.lit("location"))

        def role(x: Column, i: Column) -> Column:
            later = x["type"] == "location"
            small = x["type"].isin(*SMALL_PLACES) | (later & x["name"].rlike(ESTATE))
            return F.when(i + 1 == first, "region").when(small, "small").when(later, "place").otherwise(x["type"])

        return F.transform(own, lambda x, i: F.struct(role(x, i).alias("role"), x["name"].alias("name"), x["full"].alias("full"), x["id"].alias("id")))

    def fields(own: Column) -> Column:
        at = lambda role: F.array_position(F.transform(own, lambda x: F.coalesce(x["role"], F.lit(""))), F.lit(role))
        of = lambda role, k: F.try_element_at(F.filter(own, lambda x: x["role"] == role), F.lit(k))
        # The first place names the municipality unless an okrug stands before it.
        names = (at("okrug") == 0) | (at("okrug") > at("place"))
        small = F.filter(own, lambda x, i: (x["role"] == "small") | ((x["role"] == "place") & ~(names & (i + 1 == at("place")))))
        return F.struct(
            of("region", 1)["full"].alias("region"), F.coalesce(of("okrug", -1)["name"], of("place", 1)["name"]).alias("municipality"), district_name(of("raion", -1)["name"]).alias("district"),
            F.try_element_at(small, F.lit(1))["name"].alias("microdistrict"), of("street", -1)["name"].alias("street"), of("house", -1)["name"].alias("house"), of("house", -1)["id"].alias("house_id"),
        )

    return let(roles(F.coalesce(named, F.array().cast("array<struct<type:string,name:string,full:string,id:long>>"))), fields)
