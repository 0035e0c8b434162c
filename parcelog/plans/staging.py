"""Staging views, layers and the rent models over the sighting log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelog.operators.lifecycle import Params, census_of, closure_cutoff, listing_summary
from parcelog.storage import materialize


def stg_sale(obs: DataFrame) -> DataFrame:
    """Sightings of sales; no deal type is a sale."""
    return obs.filter(F.coalesce("deal_type", F.lit("sale")) == "sale")


def stg_rent(obs: DataFrame) -> DataFrame:
    return obs.filter(F.col("deal_type").isin("rent_long", "rent_day"))


def fact_rent(rents: DataFrame, params: Params = Params()) -> DataFrame:
    """A row for each rental: state, place (null if never located), price profile, days and closure by region and deal type."""
    summary = materialize(listing_summary(rents, params), "rent-summary")
    cutoff = closure_cutoff(census_of(summary, "deal_type"), params, ("region", "deal_type"))
    own = summary.select("listing_id", "state.deal_type", "place.region", "place.municipality", "state.price", "state.area", "price_first", "price_last", "price_points", "first_seen", "last_seen")
    joined = own.join(F.broadcast(cutoff), ["region", "deal_type"], "left")  # a row for each region and deal type
    return joined.select("listing_id", "deal_type", "region", "municipality", "price", "area", "price_first", "price_last", "price_points", F.datediff(F.to_date("last_seen"), F.to_date("first_seen")).alias("days_on_market"), F.coalesce((F.to_date("last_seen") < F.col("last_day")).cast("int"), F.lit(0)).alias("event_closed"))


def schema_of(given: Column, default: str = "default") -> Column:
    """Schema of a model: the name it gives itself, without blanks around, else the default."""
    return F.coalesce(F.nullif(F.trim(given), F.lit("")), F.lit(default))


def materialize_layer(spark: SparkSession, tables: dict[str, DataFrame], path: str, as_views: bool = False) -> dict[str, DataFrame]:
    """Views for staging layers, else Parquet tables below ``path``, read back."""
    out = {}
    for name, df in tables.items():
        if as_views:
            df.createOrReplaceTempView(name)
            out[name] = spark.table(name)
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            out[name] = spark.read.parquet(f"{path}/{name}")
    return out
