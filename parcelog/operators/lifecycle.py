"""Lifecycles from an append-only log: latest state, price history, units, closure.

Logs have obs_id, listing_id, scraped_at, price and attributes; rows with a region are
full, others heartbeats. Null prices count as sightings. Ties in time go to the larger
obs_id. All operators group by key with partial aggregates or split by key in windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelog.operators.ranks import running
from parcelog.storage import materialize


@dataclass(frozen=True)
class Params:
    """Tunable constants of the models."""

    as_of: str = "2024-01-31"
    census_days: int = 30
    census_floor: float = 0.6
    closure_days: int = 5
    price_tolerance: float = 0.01
    outlier_low: float = 10
    outlier_high: float = 25
    outlier_least: int = 150


def latest_per_key(df: DataFrame, key: str, *priority: Column) -> DataFrame:
    """One row of each key: the one whose priority values are greatest. One aggregate, no sort."""
    best = F.max_by(F.struct(*df.columns), F.struct(*priority))
    return df.groupBy(F.col(key).alias("key_")).agg(best.alias("row_")).select("row_.*")


def latest(obs: DataFrame, key: str = "listing_id") -> DataFrame:
    """The last full sighting of each listing, else its last one."""
    return latest_per_key(obs, key, F.col("region").isNotNull(), F.col("scraped_at"), F.col("obs_id"))


def _profile() -> list[Column]:
    order = F.struct("scraped_at", "obs_id")
    return [
        F.min("scraped_at").alias("first_seen"),
        F.max("scraped_at").alias("last_seen"),
        F.min_by("price", order).alias("price_first"),
        F.max_by("price", order).alias("price_last"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        F.count("*").alias("price_points"),
    ]


def price_profile(obs: DataFrame, key: str = "listing_id") -> DataFrame:
    """Span, first, last, least and greatest price and number of sightings of each listing."""
    return obs.groupBy(key).agg(*_profile())


def price_changes(obs: DataFrame, key: str = "listing_id") -> DataFrame:
    """Sightings whose price differs from the one before; nulls on either side are no change."""
    before = F.lag("price").over(Window.partitionBy(key).orderBy("scraped_at", "obs_id"))
    return obs.withColumn("price_before", before).filter("price <> price_before").select(key, "scraped_at", "price_before", "price")


def gap_group(df: DataFrame, keys: list[str], value: str, order: list[str], tolerance: float) -> DataFrame:
    """Number of the chain of values (``price_grp``): a new one where the value before is below value * (1 - tolerance).

    Groups of any size: chains run on across ranges of (keys, value, order), see ``ranks.running``.
    """
    new = F.when(F.col("value_before") >= F.col(value) * (1 - tolerance), 0).otherwise(1)
    return running(df, keys, [value, *order], {"value_before": F.col(value)}, {"price_grp": new}).drop("value_before")


def sweep_slots(df: DataFrame, keys: list[str], id_: str, start: str, end: str) -> DataFrame:
    """How many intervals of the same keys are open when each begins; starts come before ends at the same time.

    Groups of any size: open intervals are counted on across ranges of (keys, time).
    """
    event = lambda ts, d: F.struct(F.col(ts).alias("ts"), F.lit(d).alias("delta"))
    events = df.select(*keys, id_, F.explode(F.array(event(start, 1), event(end, -1))).alias("e")).select(*keys, id_, "e.*")
    counted = running(events, keys, ["ts", F.desc("delta"), id_], sums={"open_": F.col("delta")})
    return counted.filter("delta = 1").select(*keys, id_, (F.col("open_") - 1).alias("slot"))


def presence(obs: DataFrame, params: Params = Params(), key: str = "listing_id") -> DataFrame:
    """Different (listing, day) of the census window."""
    recent = F.col("scraped_at") >= F.date_sub(F.lit(params.as_of).cast("date"), params.census_days)
    return obs.filter(recent).select(key, F.to_date("scraped_at").alias("d")).distinct()


def place_of(obs: DataFrame, key: str = "listing_id") -> DataFrame:
    """The best located full sighting: with municipality, with street, then newest."""
    return latest_per_key(
        obs.filter("region is not null"),
        key,
        F.col("municipality").isNotNull(),
        F.col("street").isNotNull(),
        F.col("scraped_at"),
        F.col("obs_id"),
    )


def listing_summary(obs: DataFrame, params: Params = Params(), key: str = "listing_id") -> DataFrame:
    """All that later steps need of each listing in one aggregate over the log: ``state`` (the last full sighting, else
    the last), ``place`` (the best located one; null without), the price profile, and ``days`` of the census window."""
    order, full = F.struct("scraped_at", "obs_id"), F.col("region").isNotNull()
    recent = F.col("scraped_at") >= F.date_sub(F.lit(params.as_of).cast("date"), params.census_days)
    row = F.struct(*[c for c in obs.columns if c != key])
    return obs.groupBy(key).agg(
        F.max_by(row, F.struct(full.alias("full"), order)).alias("state"),
        F.max_by(F.when(full, row), F.struct(full.alias("full"), F.col("municipality").isNotNull().alias("m"), F.col("street").isNotNull().alias("s"), order)).alias("place"),
        *_profile(),
        F.collect_set(F.when(recent, F.to_date("scraped_at"))).alias("days"),  # census_days + 1 at most
    )


def census_of(summary: DataFrame, *keys: str) -> DataFrame:
    """Listings seen by region (and other fields of the place) and day."""
    seen = summary.filter("place is not null").select(*[F.col(f"place.{k}").alias(k) for k in ("region", *keys)], F.explode("days").alias("d"))
    return seen.groupBy("region", *keys, "d").agg(F.count("*").alias("n"))


def region_day_census(obs: DataFrame, params: Params = Params()) -> DataFrame:
    """Listings seen by region and day."""
    return census_of(listing_summary(obs, params))


def partition_max(df: DataFrame, keys: list[str], value: str, floor: float) -> DataFrame:
    """Rows that reach a share of their group's greatest value."""
    return df.withColumn("mx", F.max(value).over(Window.partitionBy(*keys))).filter(F.col(value) >= floor * F.col("mx"))


def closure_cutoff(census: DataFrame, params: Params = Params(), keys: tuple[str, ...] = ("region",)) -> DataFrame:
    """The last but few well-covered day of each region; fewer days if there are fewer."""
    good = partition_max(census, list(keys), "n", params.census_floor)
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("d")))
    return good.withColumn("rn", rn).filter(F.col("rn") <= params.closure_days).groupBy(*keys).agg(F.min("d").alias("last_day"))


def units_of(summary: DataFrame, params: Params = Params()) -> DataFrame:
    """Physical unit of each located listing of a summary."""
    from parcelog.functions.text import surrogate_key

    span = summary.filter("place.lat is not null and state.area is not null").select(
        "listing_id", F.coalesce("state.seller_id", -F.col("listing_id")).alias("seller"), "first_seen", "last_seen", F.coalesce("price_last", F.lit(0)).alias("price"),
        surrogate_key(F.round("place.lat", 5), F.round("place.lon", 5), F.col("state.floor"), F.round("state.area", 1)).alias("class_sk"),
    )
    seller = span.groupBy("class_sk", "seller").agg(F.percentile("price", F.lit(0.5)).alias("price"))
    group = gap_group(seller, ["class_sk"], "price", ["seller"], params.price_tolerance).drop("price")
    units = span.join(group, ["class_sk", "seller"]).withColumn("class_sk", surrogate_key(F.col("class_sk"), F.col("price_grp")))
    return sweep_slots(units, ["class_sk", "seller"], "listing_id", "first_seen", "last_seen").select("listing_id", "class_sk", "slot")


def unit_identity(obs: DataFrame, params: Params = Params()) -> DataFrame:
    """Physical unit of each listing: equal place, floor and area, a chain of like prices, and a slot among one seller's
    listings at a time. Listings without place or area are their own unit."""
    return units_of(listing_summary(obs, params), params)


def fact_listing(obs: DataFrame, params: Params = Params()) -> DataFrame:
    """A row for each listing: state, place (null if never located), price profile, unit, days on market and closure.

    The log is read and shuffled once, into a table of a row for each listing that all parts read.
    """
    from parcelog.functions.text import surrogate_key

    summary = materialize(listing_summary(obs, params), "listing-summary")
    cutoff = closure_cutoff(census_of(summary), params)
    joined = summary.withColumn("region", F.col("place.region")).join(units_of(summary, params), "listing_id", "left").join(F.broadcast(cutoff), "region", "left")  # a row for each region
    of = lambda name: F.col(f"place.{name}")
    return joined.select(
        "listing_id", surrogate_key(F.coalesce("class_sk", F.col("listing_id").cast("string")), F.col("slot")).alias("unit_sk"), F.col("slot").alias("unit_slot"),
        surrogate_key(of("region"), of("municipality")).alias("geo_sk"), surrogate_key(of("street"), of("house"), of("lat"), of("lon")).alias("building_sk"),
        "region", of("municipality").alias("municipality"), *[F.col(f"state.{k}").alias(k) for k in ("price", "area", "rooms", "floor", "is_new", "seller_id")],
        "first_seen", "last_seen", "price_first", "price_last", "price_min", "price_max", "price_points",
        F.datediff(F.to_date("last_seen"), F.to_date("first_seen")).alias("days_on_market"), F.coalesce((F.to_date("last_seen") < F.col("last_day")).cast("int"), F.lit(0)).alias("event_closed"),
    )


def fact_unit(listings: DataFrame) -> DataFrame:
    """A row for each unit: its listings, sellers, span and prices, its newest live listing as representative."""
    agg = listings.groupBy("unit_sk").agg(
        F.count("*").alias("n_listings"), F.countDistinct("seller_id").alias("n_sellers"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.bool_or(F.col("event_closed") == 0).alias("live"),
        F.min(F.coalesce("price_min", "price")).alias("price_min"), F.max(F.coalesce("price_max", "price")).alias("price_max"), F.sum("price_points").alias("price_points"),
        F.max_by(F.struct("listing_id", "price", "area", "region", "municipality", "geo_sk", "building_sk", "rooms", "is_new"), F.struct(-F.col("event_closed"), "last_seen", "listing_id")).alias("r"),
    )
    return agg.select(
        "unit_sk",
        "n_listings",
        "n_sellers",
        "first_seen",
        "last_seen",
        "live",
        "price_min",
        "price_max",
        "price_points",
        "r.*",
        F.datediff(F.to_date("last_seen"), F.to_date("first_seen")).alias("unit_days"),
        (~F.col("live")).cast("int").alias("unit_closed"),
    )


def dim_geo(obs: DataFrame) -> DataFrame:
    from parcelog.functions.text import surrogate_key

    return obs.filter("region is not null").select("region", "municipality").distinct().withColumn(
        "geo_sk",
        surrogate_key(F.col("region"), F.col("municipality")),
    )


def dim_building(obs: DataFrame) -> DataFrame:
    """Attributes of each (street, house, place), null values being values."""
    from parcelog.functions.text import surrogate_key

    keys = ["street", "house", "lat", "lon"]
    return obs.filter("region is not null").groupBy(*keys).agg(F.max("floors").alias("floors"), F.bool_or("is_new").alias("is_new")).withColumn("building_sk", surrogate_key(*map(F.col, keys)))
