"""Summaries: quantiles, bands, histograms, indices, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelog.operators.ranks import Quantiles, cut_of_newest, exact_quantiles, overall_quantiles, quantile_tables, running


def every(conditions: list[Column | None]) -> Column:
    """All conditions that are given."""
    return reduce(lambda x, y: x & y, [c for c in conditions if c is not None], F.lit(True))


#: Rows of a group above which its quantiles come from counts over ranges: an aggregate's buffer holds a group's different values.
LARGE_GROUP = 5_000_000


def _quantiles(df: DataFrame, keys: list[str], value: str, at: dict[str, float], large: bool | None) -> DataFrame:
    """keys, exact interpolated quantiles by name, and ``n``, the number of rows, of each group.

    Groups whose buffers fit are one aggregate. Where the largest group (or, if it is told, ``large``) has too many rows, values
    are counted and the counts summed up over ranges instead; both give the same numbers.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    if large is None:
        large = (sizes.agg(F.max("n")).first()[0] or 0) > LARGE_GROUP
    if not large:
        shares = F.array(*[F.lit(float(x)) for x in at.values()])
        out = df.groupBy(*keys).agg(F.percentile(value, shares).alias("q_"), F.count("*").alias("n"))
        return out.select(*keys, *[F.col("q_")[i].alias(k) for i, k in enumerate(at)], "n")
    found = exact_quantiles(df, keys, value, at).withColumnsRenamed({k: f"{k}_" for k in keys})
    return sizes.join(found, every([F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]), "left").select(*keys, *at, "n")


def median_band(df: DataFrame, keys: list[str], value: str, large: bool | None = None) -> DataFrame:
    """Median and size of each group, however large; rows with null values count for the size."""
    return _quantiles(df, keys, value, {"med": 0.5}, large)


def band_filter(df: DataFrame, keys: list[str], value: str, low: float, high: float, least: int, exempt: Column | None = None) -> DataFrame:
    """Rows of small groups, rows within [median / low, median * high], and exempt rows. Groups are aggregates, so the join is small."""
    band = median_band(df, keys, value)
    inside = (F.col("n") < least) | F.col(value).between(F.col("med") / low, F.col("med") * high)
    return df.join(band, keys).filter(inside | (exempt if exempt is not None else F.lit(False))).drop("med", "n")


def quantiles(df: DataFrame, keys: list[str], value: str, at: dict[str, float], least: int = 0, places: int = 4, large: bool | None = None) -> DataFrame:
    """Exact interpolated quantiles and size of each group of more than ``least`` rows, however large."""
    out = _quantiles(df, keys, value, at, large).filter(F.col("n") > least)
    return out.select(*keys, *[F.round(k, places).alias(k) for k in at], "n")


def width_buckets(df: DataFrame, value: str, low: float, high: float, n: int) -> DataFrame:
    """Counts in equal buckets from ``low`` to ``high``, with their starts; the inclusive end is bucket n + 1."""
    bucket = F.floor((F.col(value) - low) / (high - low) * n).cast("int") + 1
    counted = df.filter(F.col(value).between(low, high)).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    return counted.select("bucket", (F.lit(low) + (F.col("bucket") - 1) * ((high - low) / n)).alias("start"), "n")


def histogram_equal(df: DataFrame, value: str, n: int) -> DataFrame:
    """Counts in n equal bins over the observed range; the greatest value is in the last bin."""
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))  # one row
    at = F.floor((F.col(value) - F.col("lo")) / ((F.col("hi") - F.col("lo")) / n)).cast("int")
    return df.filter(F.col(value).isNotNull()).select(value).crossJoin(F.broadcast(span)).groupBy(F.least(at, F.lit(n - 1)).alias("bin")).agg(F.count("*").alias("n"))


def equi_depth_cuts(df: DataFrame, keys: list[str], value: str, k: str) -> DataFrame:
    """Cut points i = 1 .. k - 1 of each group at its own k: the least value with i / k of the rows up to it.

    Values are counted first and summed up over ranges, so groups may be of any size.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, k, value).agg(F.count("*").alias("m"))
    upto = running(counted, [*keys, k], [value], sums={"upto": F.col("m")})
    sizes = counted.groupBy(*keys, k).agg(F.sum("m").alias("n")).withColumnsRenamed({x: f"{x}_of" for x in (*keys, k)})
    ranked_ = upto.join(sizes, every([F.col(x).eqNullSafe(F.col(f"{x}_of")) for x in (*keys, k)]))
    at = lambda i: F.ceil(i.cast("double") / F.col(k) * F.col("n"))
    cuts = F.filter(F.when(F.col(k) > 1, F.sequence(F.lit(1), F.col(k) - 1)), lambda i: (at(i) <= F.col("upto")) & (at(i) > F.col("upto") - F.col("m")))
    return ranked_.select(*keys, "n", F.explode(cuts).alias("i"), F.col(value).alias("cut"))


def band_edges(cuts: DataFrame, keys: list[str], k: str = "k") -> DataFrame:
    """Contiguous ranges [lo, hi] of whole numbers from cut points, open at both ends (null), with the expected count."""
    distinct = cuts.select(*keys, k, "n", F.col("cut").cast("bigint").alias("cut")).distinct()
    arrays = distinct.groupBy(*keys, k, "n").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))  # k - 1 values at most
    none = F.lit(None).cast("bigint")
    edges = F.zip_with(
        F.concat(F.array(none), "cuts"),
        F.concat(F.transform("cuts", lambda x: x - 1), F.array(none)),
        lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi")),
    )
    return arrays.select(*keys, F.explode(edges).alias("e"), F.ceil(F.col("n") / (F.size("cuts") + 1)).alias("expected")).select(*keys, "e.lo", "e.hi", "expected")


def weighted_index(df: DataFrame, by: str, value: str, weight: str) -> DataFrame:
    """Weighted mean of each group, to whole numbers."""
    total = F.sum(weight)
    return df.groupBy(by).agg(
        F.rint(F.sum(F.col(value) * F.col(weight)) / F.nullif(total, F.lit(0).cast("bigint"))).cast("bigint").alias("value"),
        total.alias("points"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """feature, nulls, distinct values of every column, in one pass."""
    own = df.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("nulls"), F.countDistinct(c).alias("distinct")).alias(c) for c in df.columns])
    return own.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}.nulls").alias("nulls"), F.col(f"{c}.distinct").alias("distinct")) for c in df.columns])).alias("x")).select("x.*")


def top_values(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """The n most frequent values of each column, ties by value; one scan for all columns."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    counted = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
    rn = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "value"))
    return counted.withColumn("rank", rn).filter(F.col("rank") <= n)


def target_by_category(df: DataFrame, columns: list[str], target: str, least: int) -> DataFrame:
    """Size and deciles of a target by each value of each column, in one scan."""
    long = df.select(target, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select(target, "x.*")
    return quantiles(long, ["feature", "value"], target, {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}, least - 1, 1)


def association(df: DataFrame, a: str, b: str) -> DataFrame:
    """Bias-corrected Cramér's V of two categorical columns from their contingency counts."""
    return association_matrix(df.select(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b)), [a, b]).filter((F.col("a") == a) & (F.col("b") == b))


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def association_matrix(df: DataFrame, columns: list[str], numeric: list[str] | None = None, bins: int = 10) -> DataFrame:
    """a, b, v for each ordered pair of columns: bias-corrected Cramér's V, 1 for a column with itself; a symmetric matrix.

    Numeric columns (by default all of a numeric type) are cut into equal bins over their range. Rows lacking either value don't
    count for a pair; a pair with less than two categories on a side, or two rows, has no v. One pass finds the ranges; in
    another each row becomes a cell of each pair, counted before the shuffle, so what moves is one count a pair of categories and task.
    """
    if numeric is None:
        numeric = [f.name for f in df.schema.fields if f.name in columns and f.dataType.simpleString().split("(")[0] in NUMBERS]
    own = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) if c in numeric else F.col(c).cast("string").alias(c) for c in columns])
    codes = {c: F.col(c) for c in columns}
    if numeric:
        ends = own.agg(*[f(c).alias(f"{c}_{n}_") for c in numeric for f, n in ((F.min, "low"), (F.max, "high"))])
        own = own.crossJoin(F.broadcast(ends))  # one row
        for c in numeric:
            low, high = F.col(f"{c}_low_"), F.col(f"{c}_high_")
            bin_ = F.when(high > low, F.least(F.floor((F.col(c) - low) / (high - low) * bins), F.lit(bins - 1))).otherwise(0)
            bin_ = F.when(F.col(c).isNotNull(), bin_)
            codes[c] = bin_.cast("string")
    coded = own.select(*[x.alias(c) for c, x in codes.items()])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")) for a, b in pairs]))
    cells = coded.select(each.alias("c")).select("c.*").filter("x is not null and y is not null").groupBy("a", "b", "x", "y").agg(F.count("*").cast("double").alias("n"))
    # Of cells, a row for each pair of categories, the margins are sums; the sum over empty cells, too, is sum n^2 / (nx * ny) - 1.
    margins = cells.withColumns({"nx": F.sum("n").over(Window.partitionBy("a", "b", "x")), "ny": F.sum("n").over(Window.partitionBy("a", "b", "y"))})
    sums = margins.groupBy("a", "b").agg(
        (F.sum(F.col("n") * F.col("n") / (F.col("nx") * F.col("ny"))) - 1).alias("phi2"),
        F.countDistinct("x").alias("r"),
        F.countDistinct("y").alias("k"),
        F.sum("n").alias("n"),
    )
    less = F.nullif(F.col("n") - 1, F.lit(0.0))
    phi = F.greatest(F.lit(0.0), F.col("phi2") - (F.col("k") - 1) * (F.col("r") - 1) / less)
    rc, kc = F.col("r") - F.pow(F.col("r") - 1, 2) / less, F.col("k") - F.pow(F.col("k") - 1, 2) / less
    v = F.when((F.least("r", "k") > 1) & (F.least(rc, kc) > 1), F.round(F.sqrt(phi / (F.least(rc, kc) - 1)), 6))
    half = sums.select("a", "b", v.alias("v"))
    itself = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "a string, b string, v double")
    return half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "v")).unionByName(itself)


def hex_cell(lat: Column, lon: Column, size: float) -> tuple[Column, Column]:
    """Axial coordinates of the hexagon of a place (pointy top, ``size`` from centre to corner)."""
    q = (lon * (3**0.5 / 3) - lat / 3) / size
    r = lat * (2 / 3) / size
    x, y, z = F.rint(q), F.rint(-q - r), F.rint(r)
    dx, dy, dz = F.abs(x - q), F.abs(y + q + r), F.abs(z - r)
    return F.when((dx > dy) & (dx > dz), -y - z).otherwise(x).cast("int"), F.when((dz >= dx) & (dz >= dy), -x - y).otherwise(z).cast("int")


def quantile_trim(df: DataFrame, columns: list[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows within the quantiles of each column in turn, each taken over what is left; nulls stay."""
    for c in columns:
        ends = overall_quantiles(df, c, low, high)
        if ends:
            df = df.filter(F.col(c).isNull() | F.col(c).between(*ends))
    return df


def quantile_clip(df: DataFrame, column: str, high: float = 0.99) -> DataFrame:
    """The column capped at a quantile; nulls stay."""
    cap = overall_quantiles(df, column, high)
    return df.withColumn(column, F.when(F.col(column).isNotNull(), F.least(F.col(column), F.lit(cap[0])))) if cap else df


def modes_of(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """The most frequent value of each column as text, of several the smallest, none without values; in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]))
    counted = df.select(pairs.alias("x")).select("x.*").filter("value is not null").groupBy("feature", "value").agg(F.count("*").alias("n"))
    best = {  # a row for each column
        r["feature"]: r["best"]["value"] for r in counted.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best")).collect()
    }
    return {c: best.get(c) for c in columns}


def mode_of(df: DataFrame, column: str) -> object:
    """The most frequent value, of several the smallest; none without values."""
    first = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).first()
    return first[0] if first else None


def mode_fill(df: DataFrame, column: str) -> DataFrame:
    """Null categories become the most frequent one, of several the smallest."""
    mode = mode_of(df, column)
    return df if mode is None else df.fillna({column: mode})


def hierarchical_fill(df: DataFrame, target: str, levels: list[list[str]]) -> DataFrame:
    """Null numbers take the median of the first group that has one, level by level, then the overall median."""
    tables, overall = fitted_medians(df, {target: levels})[target]
    return fill_from(df, target, tables, overall).select(*df.columns)


def fitted_medians(df: DataFrame, levels: dict[str, list[list[str]]]) -> dict[str, tuple[list[tuple[list[str], DataFrame]], float | None]]:
    """What ``fill_from`` needs of each target: the medians (``median_``) of each level's groups, and that of all rows. All in
    one pass over the rows, whatever the number and size of groups."""
    wanted = [(target, keys) for target, all_ in levels.items() for keys in [*all_, []]]
    tables = quantile_tables(df, [Quantiles(tuple(keys), target, {"median_": 0.5}) for target, keys in wanted])
    found: dict[str, tuple[list[tuple[list[str], DataFrame]], float | None]] = {}
    for target in levels:
        own = [(keys, table.drop("n")) for (t, keys), table in zip(wanted, tables, strict=True) if t == target]
        row = own[-1][1].first()  # the whole as one group
        found[target] = (own[:-1], row["median_"] if row else None)
    return found


def fill_from(df: DataFrame, target: str, tables: list[tuple[list[str], DataFrame]], overall: float | None) -> DataFrame:
    """Null numbers from tables of medians in turn, then from the overall one."""
    found, fills = df, [F.col(target)]
    for i, (keys, medians) in enumerate(tables):
        found = found.join(medians.withColumnRenamed("median_", f"m{i}_"), keys, "left")
        fills.append(F.col(f"m{i}_"))
    return found.withColumn(target, F.coalesce(*fills, F.lit(overall).cast("double"))).drop(*[f"m{i}_" for i in range(len(tables))])


def newest_share(df: DataFrame, time: str, id_: str, share: float) -> DataFrame:
    """``is_test`` for the newest share of the rows, ties by id; the cut is found by counts, the rows stay where they are."""
    return df.withColumn("is_test", cut_of_newest(df, time, id_, share=share))


def newest(df: DataFrame, time: str, id_: str, number: int) -> DataFrame:
    """The newest rows, so many, ties by id."""
    return df.filter(cut_of_newest(df, time, id_, number=number))


def price_bands(units: DataFrame, segments: DataFrame, value: str = "price") -> DataFrame:
    """rkey, i, cut, n: cut points of the prices of each segment's units at its k, with the segment's size; a segment that isn't
    cut (k of 1) has one row without i and cut. Segments have region, rkey, room_keys, wanted_new and k; units room_key.
    """
    from parcelog.operators.matching import segment_members

    members = segment_members(units.filter(F.col(value) > 0), segments).select("rkey", "k", value)
    sizes = members.groupBy("rkey", "k").agg(F.count("*").alias("n"))
    cuts = equi_depth_cuts(members, ["rkey"], value, "k").select("rkey", "i", "cut")
    return sizes.join(cuts, "rkey", "left").select("rkey", "i", "cut", "n")


def segments_of(requests: DataFrame, text: str) -> DataFrame:
    """Segments (region, rkey, room_keys, wanted_new, k) of JSON arrays of {region, rkey, rks, isnew, k}."""
    kind = "array<struct<region:string,rkey:string,rks:array<string>,isnew:boolean,k:int>>"
    each = requests.select(F.explode(F.from_json(text, kind)).alias("s"))
    return each.select("s.region", "s.rkey", F.col("s.rks").alias("room_keys"), F.col("s.isnew").alias("wanted_new"), "s.k")
