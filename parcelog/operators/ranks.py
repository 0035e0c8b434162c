"""Ranks and exact quantiles over whole tables by range partitions: no task sorts or holds all values."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, TimestampType

from parcelog.storage import materialize


def _in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` with ``range_``, the number of the range of the order that a row lies in; written, as ranges come from samples."""
    return materialize(df.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()), "ranges")


def ranked(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """``df`` with the row's number from 1 in the order, which should be one of different rows (ties are numbered in any order)."""
    own = _in_ranges(df, *order)
    before = F.sum("n_").over(Window.orderBy("range_")) - F.col("n_")  # a row for each range
    starts = own.groupBy("range_").agg(F.count("*").alias("n_")).select("range_", before.alias("before_"))
    place = F.row_number().over(Window.partitionBy("range_").orderBy(*order))
    return own.withColumn("place_", place).join(F.broadcast(starts), "range_").select(*df.columns, (F.col("before_") + F.col("place_")).alias(name))


@dataclass(frozen=True)
class Quantiles:
    """Interpolated quantiles ``at`` (name to share) of ``value`` within groups of ``keys``."""

    keys: tuple[str, ...]
    value: str
    at: dict[str, float]


#: Bins for each quartile distance about the middle of a column, and the largest number of a bin.
BINS, LAST_BIN = 128, 1e6


def _scales(df: DataFrame, values: list[str]) -> dict[str, tuple[float, float]]:
    """About where the middle of each column lies and how far its quartiles are apart. Any numbers would do, these make even bins."""
    found = df.agg(*[F.percentile_approx(v, [0.25, 0.5, 0.75], 1000).alias(v) for v in values]).first()
    scales = {}
    for v in values:
        low, middle, high = found[v] or (0.0, 0.0, 0.0)
        middle = middle if math.isfinite(middle) else 0.0
        scales[v] = (middle, high - low if 0 < high - low < math.inf else abs(middle) or 1.0)
    return scales


def _bin(value: Column, middle: float, distance: float) -> Column:
    """A whole number that never falls where the value grows: even bins about the middle, ever wider ones far off."""
    z = (value - F.lit(middle)) / F.lit(distance)
    far = F.signum(z) * F.log1p(F.abs(z)) * BINS
    return F.floor(F.greatest(F.least(far, F.lit(LAST_BIN)), F.lit(-LAST_BIN)))  # NaN, the largest, is in the last one


def quantile_tables(df: DataFrame, wanted: list[Quantiles]) -> list[DataFrame]:
    """For each of several exact quantiles a table of keys, quantiles by name and ``n``, the number of values.

    Keys and values are written once. Rows are counted by group and bin, with partial counts before the shuffle, so that no more
    than groups times bins are shuffled; a table whose keys are some of another's sums up that one's cells. Only values of the bins
    that hold a wanted place are then counted one by one, and those counts summed up over ranges, so groups of any size, values of
    any distribution and any number of tables do. Nulls don't count; groups of nulls only are absent; keys of a group come back
    from their text, so they are numbers, texts, dates or flags.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    value_of = {name: f"v{i}_" for i, name in enumerate(dict.fromkeys(w.value for w in wanted))}
    key_of = {name: f"k{i}_" for i, name in enumerate(dict.fromkeys(k for w in wanted for k in w.keys))}
    own = df.select(*[F.col(k).cast("string").alias(c) for k, c in key_of.items()], *[F.col(v).cast("double").alias(c) for v, c in value_of.items()])
    own = materialize(own.filter(F.coalesce(*value_of.values()).isNotNull()), "values")
    scales = _scales(own, list(value_of.values()))
    holders = [[i for i, h in enumerate(wanted) if h.value == w.value and set(w.keys) <= set(h.keys)] for w in wanted]
    source = [max(h, key=lambda i: len(wanted[i].keys)) for h in holders]  # whose cells a table's are summed up from
    texts = lambda columns: F.array(*columns).cast("array<string>")
    rows = []
    for i in sorted(set(source)):
        value = value_of[wanted[i].value]
        fields = [F.lit(i).alias("source_"), texts([key_of[k] for k in wanted[i].keys]).alias("cell_"), _bin(F.col(value), *scales[value]).alias("bin_"), F.col(value).alias("value_")]
        rows.append(fields)
    long = own.select(*rows[0]) if len(rows) == 1 else own.select(F.explode(F.array(*[F.struct(*r) for r in rows])).alias("row_")).select("row_.*")
    long = long.filter("value_ is not null")
    cells = materialize(long.groupBy("source_", "cell_", "bin_").agg(F.count("*").alias("n_")), "cells")
    tables = []
    for i in sorted(set(source)):
        at = wanted[i].keys.index
        own_tables = [F.struct(F.lit(j).alias("of_"), texts([F.col("cell_")[at(k)] for k in w.keys]).alias("group_")) for j, w in enumerate(wanted) if source[j] == i]
        tables.append(F.when(F.col("source_") == i, F.array(*own_tables)))
    by_table = cells.withColumn("table_", F.explode(F.coalesce(*tables))).select("*", "table_.*").drop("table_")
    bins = by_table.groupBy("of_", "group_", "bin_").agg(F.sum("n_").alias("n_"))
    group = Window.partitionBy("of_", "group_")  # a row for each bin
    bins = bins.withColumns({"upto_": F.sum("n_").over(group.orderBy("bin_")), "all_": F.sum("n_").over(group)})
    places = []
    for j in range(max(len(w.at) for w in wanted)):
        share = F.lit(None).cast("double")
        for i, w in enumerate(wanted):
            if j < len(w.at):
                share = F.when(F.col("of_") == i, F.lit(float(list(w.at.values())[j]))).otherwise(share)
        places.append(share * (F.col("all_") - 1))
    holds = F.lit(False)
    for place in places:
        for p in (F.floor(place), F.ceil(place)):
            holds = holds | F.coalesce((F.col("upto_") - F.col("n_") <= p) & (p < F.col("upto_")), F.lit(False))
    held = bins.filter(holds).select("of_", "group_", "bin_", (F.col("upto_") - F.col("n_")).alias("before_"), "all_")
    held = by_table.drop("n_").join(held, ["of_", "group_", "bin_"])
    held = materialize(held.groupBy("source_", "cell_", "bin_").agg(F.collect_list(F.struct("of_", "group_", "before_", "all_")).alias("tables_")), "bins")
    within = long.join(held, ["source_", "cell_", "bin_"]).select("bin_", "value_", F.explode("tables_").alias("table_")).select("bin_", "value_", "table_.*")
    counted = within.groupBy("of_", "group_", "bin_", "value_").agg(F.count("*").alias("n_"), F.max("before_").alias("before_"), F.max("all_").alias("all_"))
    upto = running(counted, ["of_", "group_", "bin_"], ["value_"], sums={"within_": F.col("n_")})
    slots = []
    for j, place in enumerate(places):
        least = lambda p: F.min(F.when(F.col("before_") + F.col("within_") > p, F.col("value_")))
        slots += [least(F.floor(place)).alias(f"lo{j}_"), least(F.ceil(place)).alias(f"hi{j}_"), F.max(place - F.floor(place)).alias(f"part{j}_")]
    found = upto.groupBy("of_", "group_").agg(*slots, F.max("all_").alias("n"))
    found = materialize(found, "quantiles")  # a row for each group
    tables = []
    for i, w in enumerate(wanted):
        keys = [F.col("group_")[k].cast(types[name]).alias(name) for k, name in enumerate(w.keys)]
        values = [(F.col(f"lo{j}_") + (F.col(f"hi{j}_") - F.col(f"lo{j}_")) * F.col(f"part{j}_")).alias(name) for j, name in enumerate(w.at)]
        tables.append(found.filter(F.col("of_") == i).select(*keys, *values, "n"))
    return tables


def exact_quantiles(df: DataFrame, keys: list[str], value: str, at: dict[str, float]) -> DataFrame:
    """Interpolated quantiles of each group's values, by name, whatever a group's size; nulls don't count, groups of nulls only are absent."""
    return quantile_tables(df, [Quantiles(tuple(keys), value, at)])[0].drop("n")


def overall_quantiles(df: DataFrame, value: str, *at: float) -> list[float] | None:
    """Exact quantiles of a whole column as numbers; none for a column without values."""
    row = exact_quantiles(df.select(value), [], value, {f"q{i}": p for i, p in enumerate(at)}).first()
    return list(row) if row else None


def _carries(own: DataFrame, keys: list[str], values: DataFrame, columns: list[str]) -> DataFrame:
    """``own`` with what ``values`` (keys, ``range_``, columns) has for the row's group and range, null where there is none.

    Only ranges that a group doesn't begin in have values, and a range begins within one group at most: there are no more of them
    than ranges, and they are broadcast.
    """
    renamed = values.select(*[F.col(k).alias(f"{k}_own") for k in keys], F.col("range_").alias("range_own"), *columns)
    same = F.col("range_") == F.col("range_own")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_own"))
    return own.join(F.broadcast(renamed), same, "left").select(*own.columns, *columns)


def _by_group(keys: list[str]) -> Window:
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))  # over a row for each group and range


def running(df: DataFrame, keys: list[str], order: list[Column | str], before: dict[str, Column] | None = None, sums: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with values of the row before it and with running sums, the row's own included, by name, within each group of
    equal keys (nulls are a key). Sums may be of columns that ``before`` adds; nulls add nothing.

    Rows are dealt into ranges of (keys, order), which should tell all rows apart, so that a large group lies in many
    ranges. A window sees one range of one group; the last row of the group's range before, and what its earlier ranges
    sum up to, are carried in.
    """
    before, sums = before or {}, sums or {}
    own = _in_ranges(df, *keys, *order)
    within, group = Window.partitionBy(*keys, "range_").orderBy(*order), _by_group(keys)
    if before:
        names = list(before)
        last = own.withColumns({"place_": F.row_number().over(within), "n_": F.count("*").over(Window.partitionBy(*keys, "range_"))})
        ends = last.filter("place_ = n_").select(*keys, "range_", F.struct(*[x.alias(n) for n, x in before.items()]).alias("end_"))
        carried = ends.select(*keys, "range_", F.lag("end_").over(group.orderBy("range_")).alias("carried_")).filter("carried_ is not null")
        lagged = own.withColumn("before_", F.lag(F.struct(*[x.alias(n) for n, x in before.items()])).over(within))
        lagged = _carries(lagged, keys, carried, ["carried_"]).withColumn("before_", F.coalesce("before_", "carried_"))
        own = lagged.select("*", *[F.col(f"before_.{n}").alias(n) for n in names]).drop("before_", "carried_")
    named = {name: f"sum{i}_" for i, name in enumerate(sums)}
    if sums:
        own = own.withColumns({named[n]: F.coalesce(x, F.lit(0)) for n, x in sums.items()})
        parts = own.groupBy(*keys, "range_").agg(*[F.sum(c).alias(c) for c in named.values()])
        earlier = [(F.sum(c).over(group.orderBy("range_")) - F.col(c)).alias(f"{c}before") for c in named.values()]
        carried = parts.select(*keys, "range_", F.min("range_").over(group).alias("first_"), *earlier).filter("first_ < range_")
        upto = within.rowsBetween(Window.unboundedPreceding, 0)
        own = _carries(own.withColumns({c: F.sum(c).over(upto) for c in named.values()}), keys, carried, [f"{c}before" for c in named.values()])
    return own.select(*df.columns, *before, *[(F.col(c) + F.coalesce(F.col(f"{c}before"), F.lit(0))).alias(n) for n, c in named.items()])


def running_sums(df: DataFrame, keys: list[str], order: list[Column | str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with running sums by name, as ``running`` gives them."""
    return running(df, keys, order, sums=sums)


def _to_text(x: Column, kind: DataType) -> Column:
    """A value as text that leads back to it whatever the time zones are."""
    return (F.unix_micros(x) if isinstance(kind, TimestampType) else x).cast("string")


def _of_text(x: str | None, kind: DataType) -> Column:
    return F.timestamp_micros(F.lit(x).cast("bigint")) if isinstance(kind, TimestampType) else F.lit(x).cast(kind)


def cut_of_newest(df: DataFrame, time: str, id_: str, share: float | None = None, number: int | None = None) -> Column:
    """True for the newest rows by (time descending, id ascending): so many, or a share of all. Rows without time are the oldest.

    The cut is found by counts: one pass brackets it between two times, one counts what is newer, and only rows within
    the bracket (few, but for ties of one time) are numbered, by their time and id; nothing else is written or sorted.
    """
    kind = df.schema[time].dataType
    own = df.select(F.col(time).alias("t"), F.col(id_).alias("i"))
    sizes = own.agg(F.count("*").alias("all"), F.count("t").alias("timed")).first()
    wanted = min(int(share * sizes["all"]) if share is not None else number, sizes["all"])
    if wanted <= 0:
        return F.lit(False)
    if wanted == sizes["all"]:
        return F.lit(True)
    if wanted > sizes["timed"]:  # all that have a time, and some of the others
        newer, within = sizes["timed"], own.filter("t is null")
    else:
        slack = 0.001
        while True:  # ends with the bracket of all rows
            at = [min(max(1 - wanted / sizes["timed"] + d, 0.0), 1.0) for d in (-slack, slack)]
            ends = own.agg(*[F.percentile_approx("t", p, 10_000).alias(f"q{i}") for i, p in enumerate(at)])
            low, high = (_of_text(x, kind) for x in ends.select(*[_to_text(F.col(f"q{i}"), kind) for i in (0, 1)]).first())
            newer, upto = own.agg(F.count_if(F.col("t") > high), F.count_if(F.col("t") >= low)).first()
            if newer < wanted <= upto:
                break
            slack *= 8
        within = own.filter(F.col("t").between(low, high))
    last = ranked(within, F.desc("t"), F.asc("i"), name="place_").filter(F.col("place_") == wanted - newer).select(_to_text(F.col("t"), kind).alias("t"), "i").first()
    if last["t"] is None:
        return F.col(time).isNotNull() | (F.col(id_) <= F.lit(last["i"]))
    at = _of_text(last["t"], kind)
    return F.coalesce((F.col(time) > at) | ((F.col(time) == at) & (F.col(id_) <= F.lit(last["i"]))), F.lit(False))
