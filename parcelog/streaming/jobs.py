"""Structured Streaming twins of the incremental jobs on the sighting log.

All take a streaming frame and a folder for checkpoint and sink, run over what is there
and stop; started again with the same folder they go on where they stopped. A batch that
is repeated after a failure leaves the rows as they were: file sinks know which batches
they hold, other batches are written under their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from parcelog.sources import files

OUTCOMES = "listing_id long, obs_id long, scraped_at timestamp, price long, outcome string"
HEARTBEATS = "listing_id long, d date, price long"
CARD_STATE = "price long, run long, fresh boolean, repriced boolean, touched boolean, day long, seen long"


def source(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """A stream over the Parquet files of a folder, with the schema that they have now."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).parquet(path)


def _run(writer, folder: str) -> None:
    """Run over what is there. A new stream parts its state among so many tasks as keep the cores busy, and no more: each part
    writes files of its own every batch, however few rows it has. A stream that goes on keeps its number of parts."""
    spark = SparkSession.active()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        query = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)
    query.awaitTermination()


def _to_files(stream: DataFrame, folder: str, schema: str | None = None) -> DataFrame:
    """The stream's rows in Parquet files, whose log makes each batch count once."""
    _run(stream.writeStream.format("parquet").option("path", f"{folder}/sink").outputMode("append"), folder)
    reader = stream.sparkSession.read
    return (reader.schema(schema) if schema else reader).parquet(f"{folder}/sink")


def ingest(stream: DataFrame, folder: str) -> DataFrame:
    """Append sightings with a price to the sink."""
    return _to_files(stream.filter("price is not null"), folder)


def ingest_new(stream: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """Append rows whose keys no other batch has brought, each once; without any state. A batch meets the other batches only,
    so repeated it adds and loses nothing."""
    sink = f"{folder}/sink"
    _run(stream.writeStream.foreachBatch(lambda batch, i: files.append_batch(batch, sink, i, keys)), folder)
    return files.batches(stream.sparkSession, sink, stream.schema)


def dedupe(stream: DataFrame, keys: list[str], time: str, folder: str, delay: str = "60 days") -> DataFrame:
    """The first sighting of each key within the watermark's delay; state older than that is dropped."""
    return _to_files(stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys), folder)


def rate(stream: DataFrame, time: str, folder: str, span: str = "60 seconds", step: str = "5 seconds", delay: str = "60 days") -> DataFrame:
    """Sightings in sliding windows. A batch writes the windows that it changed, of which the last counts; windows older
    than the watermark's delay leave the state."""
    sink = f"{folder}/sink"
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, span, step).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")
    _run(counted.writeStream.outputMode("update").foreachBatch(lambda batch, i: files.append_batch(batch, sink, i)), folder)
    written = files.batches(stream.sparkSession, sink, "start timestamp, n long", number="batch")
    return written.groupBy("start").agg(F.max_by("n", "batch").alias("n"))


@dataclass
class Card:
    """What is known of a listing: the price that counts; of its last run, whether it was new in it, has been repriced or seen
    as known; the last day with an observation; and the last day with a sighting."""

    price: int | None = None
    run: int | None = None
    fresh: bool = False
    repriced: bool = False
    touched: bool = False
    day: int | None = None
    seen: int = 0

    def see(self, run: int, day: int, price: int | None, idle_days: int) -> str:
        """new, or dup where that was in this run; else repriced, once a run, if there is a price and another one than known; else
        known. A listing that was idle for more days is new again."""
        gone, self.seen = self.run is None or day - self.seen > idle_days, max(self.seen, day)
        if gone:
            self.price, self.run, self.fresh, self.repriced, self.touched, self.day = price, run, True, False, False, day
            return "new"
        if run != self.run:
            self.run, self.fresh, self.repriced, self.touched = run, False, False, False
        if self.fresh:
            return "dup"
        self.touched = True
        if price and price != self.price and not self.repriced:
            self.price, self.repriced, self.day = price, True, max(self.day, day)
            return "repriced"
        return "known"

    def heartbeat(self, day: int, price: int | None) -> int | None:
        """The price of a heartbeat, at most one a day, for a listing that was seen as known and wasn't observed that day yet."""
        price = price or self.price
        if self.fresh or self.repriced or not self.touched or self.day >= day or price is None:
            return None
        self.day = day
        return price


def _own(stream: DataFrame, run: Column | None, delay: str) -> DataFrame:
    """Sightings with their run (by default their day), as days since 1970 or any other whole number."""
    time = F.col("scraped_at").cast("timestamp")
    day = F.unix_date(F.to_date("scraped_at")).cast("long")
    own = stream.select("listing_id", "obs_id", time.alias("scraped_at"), F.col("price").cast("string").alias("price"), (day if run is None else run.cast("long")).alias("run"), day.alias("day"))
    return own.withWatermark("scraped_at", delay)


#: A sighting in a listing's order: time, id, run, day and price.
Sighting = tuple[pd.Timestamp, int, int, int, int | None]


def _with_state(own: DataFrame, step: Callable[[Card, int, list[Sighting]], dict[str, list]], schema: str, idle_days: int) -> DataFrame:
    """``step`` over each listing's sightings in order with its card, which leaves the state when it has been idle for long.

    Most listings have few sightings a batch, so these are plain tuples: what pandas needs for a sort or a new column costs
    far more than a few rows do.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        card = Card(*state.get) if state.exists else Card()
        rows: list[Sighting] = []
        for f in frames:
            rows += zip(f["scraped_at"].array, f["obs_id"].tolist(), f["run"].tolist(), f["day"].tolist(), _prices(f), strict=True)
        rows.sort(key=lambda r: (r[0], r[1] != r[1], r[1]))  # missing ids last
        found = step(card, key[0], rows)
        if found[names[0]]:
            yield pd.DataFrame(found, columns=names)
        state.update(astuple(card))
        state.setTimeoutTimestamp(max((card.seen + idle_days + 1) * 86_400_000, state.getCurrentWatermarkMs() + 1))

    return own.groupBy("listing_id").applyInPandasWithState(update, schema, CARD_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _prices(rows: pd.DataFrame) -> list[int | None]:
    return [None if p is None or p != p else int(p) for p in rows["price"].tolist()]


def card_states(stream: DataFrame, folder: str, run: Column | None = None, delay: str = "60 days", idle_days: int = 180) -> DataFrame:
    """Each sighting as new, dup, repriced or known, with the listing's card as state. A run is a day unless told otherwise;
    sightings older than the watermark's delay are dropped, and listings idle for ``idle_days`` leave the state and are new again."""

    def classify(card: Card, listing: int, rows: list[Sighting]) -> dict[str, list]:
        times, ids, _, _, prices = (list(x) for x in zip(*rows, strict=True))
        outcomes = [card.see(r, d, p, idle_days) for _, _, r, d, p in rows]
        return {"listing_id": [listing] * len(rows), "obs_id": ids, "scraped_at": times, "price": pd.array(prices, dtype="Int64"), "outcome": outcomes}

    return _to_files(_with_state(_own(stream, run, delay), classify, OUTCOMES, idle_days), folder, OUTCOMES)


def presence(stream: DataFrame, folder: str, run: Column | None = None, delay: str = "60 days", idle_days: int = 180) -> DataFrame:
    """At most one heartbeat a listing and day, with the last price seen: for listings known before the run, not for those that
    it has repriced, nor for those observed that day before, nor without any price. A run's sightings should come in one batch
    (a heartbeat that was written stays if a later batch reprices the listing)."""

    def beat(card: Card, listing: int, rows: list[Sighting]) -> dict[str, list]:
        by_run: dict[tuple[int, int], list[int | None]] = {}
        for _, _, r, d, p in rows:
            by_run.setdefault((r, d), []).append(p)
        found: list[tuple] = []
        for (r, d), prices in by_run.items():
            for p in prices:
                card.see(r, d, p, idle_days)
            known = [p for p in prices if p]
            price = card.heartbeat(d, known[-1] if known else None)
            if price is not None:
                found.append((listing, pd.Timestamp(d, unit="D").date(), price))
        return {name: [x[i] for x in found] for i, name in enumerate(("listing_id", "d", "price"))}

    return _to_files(_with_state(_own(stream, run, delay), beat, HEARTBEATS, idle_days), folder, HEARTBEATS)
