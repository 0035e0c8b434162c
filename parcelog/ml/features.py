"""Features of listings: fitted once on training rows, applied to any rows.

``fit`` keeps what is learnt from rows (medians by group, overall medians, most frequent values, the reference year);
``FittedFeatures.transform`` uses only that, so scored rows never lend each other values. Input columns that a table
lacks count as null. Rows stay as many as they are, other columns go but for those in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from parcelog.functions.text import count_before, first_year
from parcelog.functions.values import blank_to_null, flag, haversine_km, mapped, normalized_flag, number_or_null
from parcelog.operators.matching import points_in_polygons
from parcelog.operators.summaries import fill_from, fitted_medians, modes_of
from parcelog.storage import materialize

#: Features and inputs by kind, centres of regions (degrees), and groups whose medians fill a column (fixed values).
NUMERIC = [
    "mortgage_allowed", "n_metro", "nearest_metro_time", "nearest_metro_walk", "rooms", "is_studio", "total_area", "living_area", "kitchen_area", "floor", "total_floors", "ceiling_height",
    "is_apartments", "is_new_building", "phone_protected", "price_first", "lat", "lon", "dist_to_center", "price_per_m2", "building_age", "is_ready", "is_first_floor", "is_last_floor", "floor_ratio",
    "living_to_total", "kitchen_to_total", "area_per_room", "ppm2_to_district", "ppm2_to_municipality", "total_lifts", "has_lift", "bath_separate", "bath_combined", "balcony_count", "loggia_count",
    "completion_year", "years_to_completion", "is_presale", "has_completion", "demolished_in_renovation", "is_penthouse", "seller_is_owner",
]
CATEGORICAL = [
    "region",
    "flat_type",
    "renovation",
    "window_view",
    "building_type",
    "parking",
    "seller_type",
    "seller_user_type",
    "room_type",
    "deal_conditions",
    "municipality",
    "district",
]
FLAGS = [
    "is_apartments",
    "is_new_building",
    "phone_protected",
    "is_studio",
    "mortgage_allowed",
    "nearest_metro_walk",
    "demolished_in_renovation",
    "is_penthouse",
    "seller_is_owner",
]
NUMBERS = [
    "price_first",
    "total_area",
    "living_area",
    "kitchen_area",
    "rooms",
    "floor",
    "total_floors",
    "ceiling_height",
    "lat",
    "lon",
    "n_metro",
    "nearest_metro_time",
    "passenger_lifts",
    "cargo_lifts",
    "year_built",
]
TEXTS = ["completion_date", "bathrooms", "balcony"]
MODES = ["deal_conditions", "seller_type"]
CENTERS = {
    "Москва": (55.7520, 37.6175),
    "Московская область": (55.7520, 37.6175),
    "Санкт-Петербург": (59.9386, 30.3141),
    "Ленинградская область": (59.9386, 30.3141),
}
OTHER_CENTER = (55.7520, 37.6175)
LEVELS = {
    "ceiling_height": [["building_type", "year_given", "total_floors"]],
    "kitchen_area": [["building_type", "area_bin"]],
    "living_area": [["building_type", "area_bin"]],
    "year_built": [["building_type"], ["district_known"], ["municipality"]],
}
RATIOS = {"ppm2_to_district": ["district", "rooms"], "ppm2_to_municipality": ["municipality", "rooms"]}
FIRST_YEAR, CEILING, AREA_STEP = 1500, (2, 8), 5


def temporal_features(year: int, built: Column, completion: Column, is_new: Column) -> dict[str, Column]:
    """Age, and what the completion year says against the reference year."""
    return {
        "building_age": F.lit(year) - built,
        "completion_year": completion,
        "years_to_completion": completion - year,
        "is_presale": flag(completion > year),
        "has_completion": completion.isNotNull().cast("int"),
        "is_ready": 1 - flag((is_new == 1) & (completion > year)),
    }


def layout_features(floor: Column, floors: Column, total: Column, living: Column, kitchen: Column, rooms: Column, lifts: tuple[Column, Column]) -> dict[str, Column]:
    """Place in the house, shares of the area, area by room (a studio is one), lifts."""
    n_lifts = F.coalesce(lifts[0], F.lit(0.0)) + F.coalesce(lifts[1], F.lit(0.0))
    whole = F.nullif(total, F.lit(0.0))
    return {
        "is_first_floor": flag(floor == 1),
        "is_last_floor": flag(floor == floors),
        "floor_ratio": floor / F.nullif(floors, F.lit(0.0)),
        "living_to_total": living / whole,
        "kitchen_to_total": kitchen / whole,
        "area_per_room": total / F.when(rooms == 0, 1).otherwise(rooms),
        "total_lifts": n_lifts,
        "has_lift": (n_lifts > 0).cast("int"),
    }


def cleaned(df: DataFrame, keep: list[str], rings: DataFrame | None = None) -> DataFrame:
    """Inputs as numbers, 0/1 flags and texts without blanks; districts from the places where ``rings`` (name, ring) are given."""
    given = lambda k: F.col(k) if k in df.columns else F.lit(None).cast("string")
    out = df.select(
        *keep,
        *[number_or_null(given(k).cast("string")).alias(k) for k in NUMBERS],
        *[normalized_flag(given(k)).alias(k) for k in FLAGS],
        *[blank_to_null(given(k).cast("string")).alias(k) for k in [*CATEGORICAL, *TEXTS]],
    )
    if rings is not None:
        own = materialize(out.withColumn("point_", F.monotonically_increasing_id()), "points")  # so that the numbers stay
        places = points_in_polygons(own.select("point_", F.col("lat").alias("x"), F.col("lon").alias("y")), rings, "point_").select("point_", F.col("name").alias("place_"))
        out = own.join(places, "point_", "left").withColumn("district", F.coalesce("district", "place_")).drop("point_", "place_")
    lat, lon = (F.coalesce(mapped(F.col("region"), {k: v[i] for k, v in CENTERS.items()}), F.lit(OTHER_CENTER[i])) for i in (0, 1))
    area = F.nullif(F.col("total_area"), F.lit(0.0))
    parts = F.coalesce("living_area", F.lit(0.0)) + F.coalesce("kitchen_area", F.lit(0.0))
    fits = ~F.coalesce(parts > F.col("total_area"), F.lit(False))
    return out.withColumns({
        "district_known": F.col("district"),
        **{k: F.coalesce(k, F.lit("unknown")) for k in CATEGORICAL if k not in MODES},
        "dist_to_center": haversine_km(F.col("lat"), F.col("lon"), lat, lon),
        "price_per_m2": F.col("price_first") / area,
        "ceiling_height": F.when(F.col("ceiling_height").between(*CEILING), F.col("ceiling_height")),
        **{k: F.when(fits, F.col(k)) for k in ("living_area", "kitchen_area")},
        "rooms": F.when(F.col("is_studio") == 1, 0.0).otherwise(F.col("rooms")),
        "year_given": F.col("year_built"),
        "year_built": F.when(F.col("year_built") >= FIRST_YEAR, F.col("year_built")),
        "area_bin": F.floor(F.col("total_area") / AREA_STEP) * AREA_STEP,
        "completion_year": first_year(F.col("completion_date")).cast("double"),
    })


@dataclass(frozen=True)
class FittedFeatures:
    """What ``fit`` learnt; tables of medians have a row for each group."""

    year: int
    modes: dict[str, str]
    overall: dict[str, float | None]
    medians: dict[str, list[tuple[list[str], DataFrame]]]
    rings: DataFrame | None = None

    def transform(self, df: DataFrame, *keep: str) -> DataFrame:
        """The kept columns, then all features: numbers as doubles, categories as texts."""
        out = cleaned(df, list(keep), self.rings).fillna(self.modes).withColumns(
            {k: F.coalesce(k, F.lit(self.overall[k]).cast("double")) for k in ("rooms", "nearest_metro_time")}
        )
        for target in LEVELS:
            out = fill_from(out, target, self.medians[target], self.overall[target])
        for name, keys in RATIOS.items():
            out = out.join(self.medians[name][0][1].withColumnRenamed("median_", f"{name}_"), keys, "left")
        usual = {name: F.coalesce(f"{name}_", F.lit(self.overall["price_per_m2"]).cast("double")) for name in RATIOS}
        counts = {
            "bath_separate": ("bathrooms", "разд"),
            "bath_combined": ("bathrooms", "совм"),
            "balcony_count": ("balcony", "балк"),
            "loggia_count": ("balcony", "лодж"),
        }
        column = F.col
        made = {
            **temporal_features(self.year, column("year_built"), column("completion_year"), column("is_new_building")),
            **layout_features(column("floor"), column("total_floors"), column("total_area"), column("living_area"), column("kitchen_area"), column("rooms"), (column("passenger_lifts"), column("cargo_lifts"))),
            **{k: count_before(column(source), token) for k, (source, token) in counts.items()},
            **{name: column("price_per_m2") / F.nullif(usual[name], F.lit(0.0)) for name in RATIOS},
        }
        return out.select(*keep, *[made.get(k, column(k)).cast("double").alias(k) for k in NUMERIC], *CATEGORICAL)


def fit(df: DataFrame, year: int, rings: DataFrame | None = None) -> FittedFeatures:
    """Learn medians, most frequent values and the reference year from training rows."""
    needed = dict.fromkeys(
        [
            *MODES,
            "rooms",
            "nearest_metro_time",
            "price_per_m2",
            *LEVELS,
            *[k for levels in LEVELS.values() for keys in levels for k in keys],
            *[k for keys in RATIOS.values() for k in keys],
        ]
    )
    own = materialize(cleaned(df, [], rings).select(*needed), "cleaned")  # the one pass over the input
    modes = {k: v or "unknown" for k, v in modes_of(own, list(MODES)).items()}
    overall = {k: middle for k, (_, middle) in fitted_medians(own, {k: [] for k in ("rooms", "nearest_metro_time", "price_per_m2")}).items()}
    own = own.withColumn("rooms", F.coalesce("rooms", F.lit(overall["rooms"]).cast("double")))
    levels = {**LEVELS, "price_per_m2": list(RATIOS.values())}
    medians = {}
    for target, (tables, middle) in fitted_medians(own, levels).items():
        if target == "price_per_m2":
            medians |= {name: [table] for name, table in zip(RATIOS, tables, strict=True)}
        else:
            medians[target], overall[target] = tables, middle
    return FittedFeatures(year, modes, overall, medians, rings)
