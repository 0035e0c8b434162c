"""Data-quality checks: each returns the violating rows; no rows are a pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def unique(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, nulls aside, with their counts."""
    return df.filter(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n"))


def counted(df: DataFrame, conditions: Mapping[str, Column], least: int) -> DataFrame:
    """One row of counts of all conditions if any holds among more than ``least`` rows."""
    out = df.agg(F.count("*").alias("n"), *[F.count_if(x).alias(k) for k, x in conditions.items()])
    return out.filter((F.col("n") > least) & (sum(map(F.col, conditions), F.lit(0)) > 0))


def share(df: DataFrame, bad: Column, most: float, least: int, keys: tuple[str, ...] = (), places: int = 2) -> DataFrame:
    """Groups of more than ``least`` rows of which more than a share is bad."""
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"))
    return out.filter((F.col("n") > least) & (F.col("bad") > F.col("n") * most)).withColumn("pct", F.round(100.0 * F.col("bad") / F.col("n"), places))


def outlier_rate(df: DataFrame, keys: list[str], value: str, low: float, high: float, cell: int, most: float, least: int, by: str) -> DataFrame:
    """Groups ``by`` of which more than a share lies outside the median band of its cell."""
    from parcelog.operators.summaries import median_band

    scored = df.join(median_band(df, keys, value).filter(F.col("n") >= cell).drop("n"), keys)
    return share(scored, (F.col(value) < F.col("med") / low) | (F.col(value) > F.col("med") * high), most, least, (by,), 3)


def stale(df: DataFrame, time: str, as_of: Column, hours: int) -> DataFrame:
    """One row if the newest time is older than so many hours."""
    return df.agg(F.max(time).alias("newest")).filter(F.col("newest") < as_of - F.make_dt_interval(hours=F.lit(hours)))


def volume_drop(daily: DataFrame, day: Column, days: int, share_: float) -> DataFrame:
    """One row if the day before ``day`` has less than a share of the most of the days before; a missing day counts 0."""
    recent = daily.filter((F.col("d") < day) & (F.col("d") >= F.date_sub(day, days)))
    out = recent.agg(F.coalesce(F.max(F.when(F.col("d") == F.date_sub(day, 1), F.col("n"))), F.lit(0)).alias("last"), F.max("n").alias("peak"))
    return out.filter(F.col("last") < share_ * F.col("peak"))


def coverage(runs: DataFrame, since: Column, share_: float) -> DataFrame:
    """One row if the runs' cards are below a share of the plan."""
    recent = runs.filter((F.col("finished_at") >= since) & (F.col("plan_offers") > 0)).agg(
        F.sum("cards").alias("cards"),
        F.max("plan_offers").alias("plan_offers"),
        F.sum("incomplete").alias("incomplete"),
    )
    return recent.filter(F.col("cards") < F.col("plan_offers") * share_).withColumn("pct", F.round(100.0 * F.col("cards") / F.col("plan_offers"), 1))


#: Checks that run side by side.
AT_ONCE = 4


def run_checks(checks: Mapping[str, DataFrame | Callable[[], DataFrame]], spark: SparkSession | None = None, at_once: int = AT_ONCE) -> DataFrame:
    """check, n_violations, passed and error of each check.

    A check is a frame of violating rows, or a function that gives one. Each is a job of its own, several run side by side,
    and one that fails (while it is built or while it runs) becomes a row with its error, without a number, that hasn't passed.
    """

    def run(item: tuple[str, DataFrame | Callable[[], DataFrame]]) -> tuple[str, int | None, bool, str | None]:
        name, check = item
        try:
            n = (check() if callable(check) else check).count()
        except Exception as error:  # whatever a check does, the others count
            return name, None, False, f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"[:500]
        return name, n, n == 0, None

    spark = spark or SparkSession.active()
    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), checks.items()))
    return spark.createDataFrame(rows, "check string, n_violations long, passed boolean, error string")
