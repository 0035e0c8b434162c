"""Historical flat tables of seven shapes, each projected to one schema.

A transform is a filter and a mapping of target columns to expressions over the source's
columns; ``align`` casts what is there, adds the rest as typed nulls and fixes the order.
Values that don't fit become null; rows without a price go. Rows without an address of
their own get one from their content, so that de-duplication by it is repeatable.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parcelog.functions.text import address, content_url, decimal_number, first_year, floor_pair, price_digits, rooms_of_title, slash_pair
from parcelog.functions.values import mapped, station_pairs

#: Target columns and types (fixed values).
COLUMNS = {
    "url": "string",
    "source": "string",
    "price": "long",
    "price_per_m2": "long",
    "discount_pct": "short",
    "deal_conditions": "string",
    "city": "string",
    "region": "string",
    "district": "string",
    "street": "string",
    "house_number": "string",
    "lat": "float",
    "lon": "float",
    "metro_stations": "string",
    "transport_score": "float",
    "rooms": "short",
    "total_area": "float",
    "living_area": "float",
    "kitchen_area": "float",
    "floor": "short",
    "total_floors": "short",
    "ceiling_height": "float",
    "renovation": "string",
    "bathrooms": "string",
    "balcony": "string",
    "window_view": "string",
    "is_apartments": "boolean",
    "year_built": "short",
    "building_type": "string",
    "parking": "string",
    "elevators": "string",
    "is_new_building": "boolean",
    "developer": "string",
    "residential_complex": "string",
    "completion_date": "string",
    "description": "string",
    "publication_date": "string",
}
#: Codes and labels of the sources (fixed values).
BUILDING_TYPES = {1: "Панельный", 2: "Монолитный", 3: "Кирпичный", 4: "Блочный", 5: "Деревянный"}
MATERIALS = {"Монолит": "Монолитный", "Панель": "Панельный", "Кирпич": "Кирпичный", "Блоки": "Блочный", "Дерево": "Деревянный"}
RENOVATIONS = {
    "Cosmetic": "Косметический",
    "European-style renovation": "Евроремонт",
    "Without renovation": "Без ремонта",
    "Designer renovation": "Дизайнерский",
    "Designer": "Дизайнерский",
}
CITY, AROUND = "Москва", "Московская область"
LABELS = {
    "renovation": "Ремонт", "bathrooms": "Санузел", "balcony": "Балкон/лоджия", "window_view": "Вид из окон", "building_type": "Тип дома",
    "parking": "Парковка", "elevators": "Количество лифтов", "completion_date": "Год сдачи",
}
BOX = {"lat": (54.2, 57.0), "lon": (35.0, 40.5)}

c = F.col


def align(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The target columns in order; casts that fail, and columns that aren't given, are null."""
    return df.select(*[(columns[k].try_cast(t) if k in columns else F.lit(None).cast(t)).alias(k) for k, t in COLUMNS.items()])


def _named(df: DataFrame, source: str, columns: dict[str, Column]) -> DataFrame:
    """Aligned rows with a price; an address from the content where the source has none."""
    out = align(df, columns | {"source": F.lit(source)}).filter("price is not null")
    made = content_url(f"{source}_", *[c(k) for k in COLUMNS if k != "url"])
    return out.withColumn("url", F.coalesce("url", made))


def _as_it_is(df: DataFrame) -> dict[str, Column]:
    """Columns of a source that bear a target column's name already."""
    return {k: c(k) for k in COLUMNS if k in df.columns}


def _coded(source: str, region: str, city: int, around: int) -> Callable[[DataFrame], DataFrame]:
    """The shape with region codes, building codes and a box around the city."""

    def transform(df: DataFrame) -> DataFrame:
        kept = df.filter(
            c(region).isin(city, around) & c("geo_lat").between(*BOX["lat"]) & c("geo_lon").between(*BOX["lon"]) & (c("price") > 0) & (c("area").isNull() | c("area").between(5, 500)),
        )
        return _named(kept, source, _as_it_is(df) | {
            "region": F.lit(None) if region == "region" else _as_it_is(df).get("region", F.lit(None)), "price": c("price"), "city": F.when(c(region) == city, CITY).otherwise(AROUND), "lat": c("geo_lat"), "lon": c("geo_lon"), "floor": c("level"), "total_floors": c("levels"), "total_area": c("area"),
            "rooms": F.when(c("rooms") >= 0, c("rooms")), "building_type": F.try_element_at(F.create_map(*[F.lit(x) for kv in BUILDING_TYPES.items() for x in kv]), c("building_type").cast("int")),
            "is_new_building": F.coalesce(c("object_type") == 2, F.lit(False)), **({"publication_date": c("date")} if region == "region" and "date" in df.columns else {}),
        })

    return transform


def flats_c(df: DataFrame) -> DataFrame:
    return _named(
        df,
        "flats_c",
        _as_it_is(df)
        | {
            "price": c("Price"),
            "rooms": c("Number of rooms"),
            "total_area": c("Area"),
            "living_area": c("Living area"),
            "kitchen_area": c("Kitchen area"),
            "floor": c("Floor"),
            "total_floors": c("Number of floors"),
            "renovation": F.coalesce(mapped(c("Renovation"), RENOVATIONS), c("Renovation")),
            "city": F.coalesce(mapped(c("Region"), {"Moscow": CITY, "Moscow region": AROUND}), c("Region")),
        },
    )


def flats_d(df: DataFrame) -> DataFrame:
    return _named(
        df,
        "flats_d",
        _as_it_is(df)
        | {
            "url": c("link"),
            "price": c("price"),
            "total_floors": c("number_of_floors"),
            "year_built": c("construction_year"),
            "rooms": c("number_of_rooms"),
            "region": c("region_of_moscow"),
            "is_new_building": F.coalesce(c("is_new") == 1, F.lit(False)),
            "is_apartments": c("is_apartments") == 1,
            "city": F.lit(CITY),
        },
    )


def flats_e(df: DataFrame) -> DataFrame:
    floor, floors = slash_pair(c("level"))
    material = F.coalesce(mapped(c("material"), MATERIALS), F.nullif(c("material"), F.lit("0")))
    return _named(
        df.filter((c("city") == CITY) & (c("price") > 0)),
        "flats_e",
        _as_it_is(df)
        | {
            "price": c("price"),
            "city": F.lit(CITY),
            "floor": floor,
            "total_floors": floors,
            "total_area": c("area"),
            "building_type": material,
            "price_per_m2": c("price_by_meter").try_cast("double"),
            "lon": c("longitude"),
            "lat": c("latitude"),
            "publication_date": c("published"),
            "year_built": F.nullif(c("build_year").try_cast("int"), F.lit(0)),
            "is_new_building": F.coalesce(c("object_type") == "Новостройка", F.lit(False)),
        },
    )


def flats_f(df: DataFrame) -> DataFrame:
    """Columns by position, as headers repeat."""
    own = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return _named(
        own,
        "flats_f",
        {
            "rooms": c("c2"),
            "price": c("c3"),
            "total_area": c("c4"),
            "living_area": c("c5"),
            "kitchen_area": c("c6"),
            "building_type": F.when(c("c10") == 1, "Кирпичный"),
            "balcony": F.when(c("c12") == 1, "Есть"),
            "is_new_building": F.coalesce(c("c14") == 1, F.lit(False)),
            "total_floors": c("c15"),
            "floor": c("c16"),
            "city": F.lit(CITY),
        },
    )


def flats_g(df: DataFrame) -> DataFrame:
    """Nested documents: a price and a title, an address line, stations, and labelled details in two maps."""
    # The address and both maps' look-ups are columns of their own, worked out once.
    df = df.withColumn("address_", address(c("address")))
    summary = lambda k: F.try_element_at("offer_summary", F.lit(k))
    details = lambda k: F.try_element_at("offer_details", F.lit(k))
    floor, floors = floor_pair(summary("Этаж"))
    kind = summary("Тип жилья")
    return _named(
        df,
        "flats_g",
        {
            "url": F.concat(F.lit("flats_g_"), "doc_id"),
            "price": price_digits(c("price")),
            "price_per_m2": price_digits(details("Цена за метр")),
            "deal_conditions": details("Условия сделки"),
            **{k: c(f"address_.{k}") for k in ("city", "region", "district", "street", "house_number")},
            "metro_stations": station_pairs(c("nearest_stations")),
            "rooms": rooms_of_title(c("title")),
            "total_area": decimal_number(summary("Общая площадь")),
            "living_area": decimal_number(summary("Жилая площадь")),
            "kitchen_area": decimal_number(summary("Площадь кухни")),
            "floor": floor,
            "total_floors": floors,
            "ceiling_height": decimal_number(summary("Высота потолков")),
            "year_built": first_year(summary("Год постройки")),
            "is_new_building": F.when(F.lower(kind).contains("новостройка"), True).when(kind != "", False),
            "description": c("description"),
            **{k: summary(label) for k, label in LABELS.items()},
        },
    )


#: Separators and transforms by name: the extension point for new sources.
REGISTRY: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "flats_a": (",", _coded("flats_a", "region", 81, 3)),
    "flats_b": (";", _coded("flats_b", "id_region", 77, 50)),
    "flats_c": (",", flats_c),
    "flats_d": (",", flats_d),
    "flats_e": (",", flats_e),
    "flats_f": (",", flats_f),
    "flats_g": ("", flats_g),
}
#: The file of each source that comes as one, below the folder that it was downloaded to.
FILES: dict[str, str] = {
    "flats_a": "all_v2.csv",
    "flats_b": "input_data.csv",
    "flats_c": "moscow_dataset.csv",
    "flats_d": "moscow_flats_dataset.csv",
    "flats_e": "selling_apartments.csv",
}


def register(name: str, sep: str, transform: Callable[[DataFrame], DataFrame], file: str | None = None) -> None:
    """Add a source: its files' separator, its transform to the target schema and its file's name. A known name is an error."""
    if name in REGISTRY:
        raise ValueError(f"{name} is registered already")
    REGISTRY[name] = (sep, transform)
    if file:
        FILES[name] = file


def union_all(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


