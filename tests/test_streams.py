"""Streaming jobs: outcomes, heartbeats, state that ends, and batches that are repeated."""

import datetime
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcelog.sources import files
from parcelog.streaming import jobs

SCHEMA = "obs_id long, listing_id long, scraped_at timestamp, price long"


def day(n, hour=0):
    return datetime.datetime(2024, 1, 1, hour) + datetime.timedelta(days=n)


@pytest.fixture
def log(spark, tmp_path):
    """A folder that takes one file for each list of rows, and the stream over it."""

    def write(*parts):
        for part in parts:
            spark.createDataFrame(part, SCHEMA).repartition(1).write.mode("append").parquet(f"{tmp_path}/log")
        return jobs.source(spark, f"{tmp_path}/log", 1)

    return write


def outcomes(df):
    return {r.obs_id: r.outcome for r in df.collect()}


def test_card_outcomes(log, tmp_path):
    first = [(1, 7, day(0), 100), (2, 7, day(0, 1), 90), (3, 8, day(0), None)]
    second = [(4, 7, day(1), 100), (5, 7, day(1, 1), 80), (6, 7, day(1, 2), 70), (7, 7, day(1, 3), 80), (8, 8, day(1), 50), (9, 9, day(1), 5), (10, 9, day(1), 6)]
    third = [(11, 7, day(2), 70), (12, 7, day(2, 1), None), (13, 8, day(2), 0), (14, 9, day(2), 5)]
    got = outcomes(jobs.card_states(log(first, second, third), f"{tmp_path}/states"))
    assert got == {
        1: "new", 2: "dup", 3: "new",  # once a run
        4: "known", 5: "repriced", 6: "known", 7: "known", 8: "repriced", 9: "new", 10: "dup",  # a second price of the run isn't taken up
        11: "repriced", 12: "known", 13: "known", 14: "known",
    }


def test_runs_may_be_shorter_than_days(log, tmp_path):
    rows = [(1, 7, day(0), 100), (2, 7, day(0, 1), 90), (3, 7, day(0, 13), 90), (4, 7, day(0, 14), 80)]
    half = F.unix_timestamp("scraped_at") / 43_200
    got = outcomes(jobs.card_states(log(rows), f"{tmp_path}/states", run=F.floor(half)))
    assert got == {1: "new", 2: "dup", 3: "repriced", 4: "known"}
    beats = jobs.presence(log(), f"{tmp_path}/beats", run=F.floor(half)).collect()
    assert beats == []  # observed that day before, as new


def test_idle_listings_leave_the_state(log, tmp_path):
    stream = log([(1, 7, day(0), 100), (2, 8, day(0), 100)], [(3, 8, day(2), 90)], [(4, 7, day(20), 100), (5, 8, day(20), 90), (6, 8, day(21), 80)])
    folder = f"{tmp_path}/states"
    got = outcomes(jobs.card_states(stream, folder, delay="1 day", idle_days=3))
    assert got == {1: "new", 2: "new", 3: "repriced", 4: "new", 5: "new", 6: "repriced"}
    log([(9, 9, day(60), 1)], [(10, 9, day(61), 1)])
    jobs.card_states(stream, folder, delay="1 day", idle_days=3)
    state = stream.sparkSession.read.format("statestore").load(f"{folder}/checkpoint")
    assert [r.key.listing_id for r in state.collect()] == [9]


def test_heartbeats(log, tmp_path):
    first = [(1, 1, day(0), 10), (2, 2, day(0), None), (3, 3, day(0), 30)]
    second = [
        (4, 1, day(1), 10), (5, 1, day(1, 2), None), (6, 1, day(1, 3), 10),  # one a day
        (7, 2, day(1), None),  # no price at all
        (8, 3, day(1), 30), (9, 3, day(1, 1), 31),  # repriced later in the run
        (10, 4, day(1), 40), (11, 4, day(1, 1), 40),  # new in this run
    ]
    third = [(12, 3, day(2), None), (13, 4, day(2), 40), (14, 1, day(2, 5), 11)]
    got = {(r.listing_id, (r.d - datetime.date(2024, 1, 1)).days, r.price) for r in jobs.presence(log(first, second, third), f"{tmp_path}/beats").collect()}
    assert got == {(1, 1, 10), (3, 2, 31), (4, 2, 40)}


JOBS = {
    "ingest": jobs.ingest,
    "ingest_new": lambda s, f: jobs.ingest_new(s.select("listing_id", F.to_date("scraped_at").alias("d")), ["listing_id", "d"], f),
    "dedupe": lambda s, f: jobs.dedupe(s, ["listing_id"], "scraped_at", f).select("listing_id"),
    "rate": lambda s, f: jobs.rate(s, "scraped_at", f),
    "card_states": jobs.card_states,
    "presence": jobs.presence,
}


@pytest.mark.parametrize("name", JOBS)
def test_a_repeated_batch_changes_nothing(log, tmp_path, name):
    """The commit mark of the last batches is lost, as after a crash behind the write; the job goes on from there."""
    parts = [[(10 * d + k, k, day(d, k), 5 + (d * k) % 3) for k in range(6)] for d in range(3)]
    stream, folder = log(*parts), f"{tmp_path}/{name}"
    before = sorted(map(tuple, JOBS[name](stream, folder).collect()))
    marks = sorted((p for p in Path(f"{folder}/checkpoint/commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for mark in marks[-2:]:
        mark.unlink()
        (mark.parent / f".{mark.name}.crc").unlink(missing_ok=True)
    assert before and sorted(map(tuple, JOBS[name](stream, folder).collect())) == before
    log([(100, 3, day(4), 9)])
    again = sorted(map(tuple, JOBS[name](stream, folder).collect()))
    assert set(before) <= set(again) or name == "rate"


def test_numbered_batches(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k string, x int"
    rows = lambda *r: spark.createDataFrame(r, schema)
    assert files.batches(spark, path, schema).count() == 0
    assert files.append_batch(rows(("a", 1), ("a", 2), (None, 3), (None, 4)), path, 0, ["k"])
    assert files.append_batch(rows(("a", 5), ("b", 6), (None, 7)), path, 1, ["k"])
    assert not files.append_batch(rows(("a", 5), ("b", 6), (None, 7)), path, 1, ["k"])  # repeated
    assert sorted(str(r.k) for r in files.batches(spark, path, schema).collect()) == ["None", "a", "b"]
    Path(f"{path}/batch=1/_SUCCESS").unlink()  # half-written
    assert sorted(str(r.k) for r in files.batches(spark, path, schema).collect()) == ["None", "a"]
    assert files.append_batch(rows(("a", 5), ("b", 6), (None, 7)), path, 1, ["k"])
    assert sorted((str(r.k), r.n) for r in files.batches(spark, path, schema, number="n").collect()) == [("None", 0), ("a", 0), ("b", 1)]


def test_published_versions(spark, tmp_path, monkeypatch):
    path, rows = f"{tmp_path}/mart", lambda x: spark.createDataFrame([(x,)], "x int")
    with pytest.raises(FileNotFoundError):
        files.published(spark, path)
    files.publish(rows(1), path)
    reader = files.published(spark, path)
    files.publish(rows(2), path)
    assert reader.first().x == 1 and files.published(spark, path).first().x == 2  # who began with the old table reads it to the end
    # A writer that is overtaken: the other one publishes while its rows are being written.
    with monkeypatch.context() as m:
        versions = files._versions
        m.setattr(files, "_versions", lambda s, p: (versions(s, p), m.undo(), files.publish(rows(3), p))[0])
        with pytest.raises(RuntimeError, match="another writer"):
            files.publish(rows(4), path)
    assert files.published(spark, path).first().x == 3
    assert sum(p.name.startswith("rows-") for p in Path(path).iterdir()) == 2  # older ones and the refused one are gone
    with pytest.raises(Exception, match="broken"):
        files.publish(rows(5).select(F.raise_error(F.lit("broken")).cast("int").alias("x")), path)
    assert files.published(spark, path).first().x == 3


def test_one_writer_at_a_time(spark, tmp_path):
    path, df = f"{tmp_path}/t", spark.createDataFrame([("u", None, 5), ("u", None, 5), ("w", "s", 0)], "url string, source string, price long")
    with files.one_writer(spark, path), pytest.raises(RuntimeError, match="being written"):
        files.append_new(df, path, ["url", "source"])
    for inserted in (1, 0):  # null keys are equal
        assert files.append_new(df, path, ["url", "source"]).first().inserted == inserted
    assert spark.read.parquet(path).count() == 1
    with files.one_writer(spark, path), files.one_writer(spark, path, stale_hours=0):
        pass  # what a dead writer left is taken over
    shutil.rmtree(path)


def test_state_has_no_more_parts_than_keep_the_cores_busy(spark, log, tmp_path):
    key = "spark.sql.shuffle.partitions"
    before, folder = spark.conf.get(key), f"{tmp_path}/states"
    spark.conf.set(key, "100")
    try:
        got = outcomes(jobs.card_states(log([(2, 1, day(0, 1), 5), (1, 1, day(0), 5), (3, 2, day(0), None)]), folder))
        assert spark.conf.get(key) == "100"
    finally:
        spark.conf.set(key, before)
    assert got == {1: "new", 2: "dup", 3: "new"}
    assert 0 < sum(p.name.isdigit() for p in Path(f"{folder}/checkpoint/state/0").iterdir()) <= 4 * spark.sparkContext.defaultParallelism
