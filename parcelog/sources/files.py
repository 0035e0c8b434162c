"""Reading and writing tables: scans, appends that skip what is there, quarantine, swaps."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from parcelog.sources.flats import FILES, REGISTRY, union_all
from parcelog.storage import materialize


def scan_csv(spark: SparkSession, path: str, schema: str | StructType, sep: str = ",") -> DataFrame:
    """CSV with a header and a stated schema; broken rows keep their good columns."""
    return spark.read.csv(path, schema=schema, header=True, sep=sep, mode="PERMISSIVE", enforceSchema=False)


def scan_registry(spark: SparkSession, name: str, path: str, schema: str, file: str | None = None) -> DataFrame:
    """The named source in the target schema: its file below a folder (the one that the registry names, unless told
    otherwise), and where that is absent the first CSV file by path, however deep."""
    sep, transform = REGISTRY[name]
    named = f"{path}/{file or FILES.get(name, '')}"
    if not _is_file(spark, named):
        found = sorted(p for p in _files(spark, path) if p.endswith(".csv"))
        if not found:
            raise FileNotFoundError(f"{path} has no CSV file")
        named = found[0]
    return transform(spark.read.csv(named, schema=schema, header=True, sep=sep))


def scan_sheet(spark: SparkSession, path: str, n_columns: int, sep: str = ",") -> DataFrame:
    """A sheet saved as CSV, its columns by position (``c0``, ``c1``, ...) whatever its header says or repeats."""
    schema = ", ".join(f"c{i} string" for i in range(n_columns))
    return spark.read.csv(path, schema=schema, header=True, sep=sep, enforceSchema=True)


def scan_html(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with their title (null without one), number of links and length; other columns stay."""
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    links = F.regexp_count(html, F.lit(r"(?i)<a\s[^>]*href="))
    return pages.withColumns({"title": F.when(title != "", title), "n_links": F.coalesce(links, F.lit(0)), "length": F.length(html).cast("bigint")}).drop(html)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by so many tasks a core as keep all busy, not by one task for each of up to 10,000 folders."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scan_json_docs(spark: SparkSession, path: str, schema: str, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(documents, broken ones) of one JSON document a file; the id is the parent folder's name."""
    with few_listing_tasks(spark):
        own = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    parsed = F.from_json("value", f"{schema}, broken_ string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken_"})
    own = own.select(F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+$", 1).alias("doc_id"), parsed.alias("d")).select("doc_id", "d.*")
    return own.filter("broken_ is null").drop("broken_"), own.filter("broken_ is not null").select("doc_id", "broken_")


def scan_geojson(spark: SparkSession, path: str, name: str = "name", lines: bool = False) -> DataFrame:
    """name, ``rings`` (of all parts, holes among them) and ``ring`` (the first part's outer one) of the areas of GeoJSON files:
    a collection of features for each file, or for each line.

    Areas are polygons and multipolygons; a file with other geometries is refused, naming their types, as leaving
    them out would lose rows.
    """
    schema = f"features array<struct<properties:struct<`{name}`:string>,geometry:struct<type:string,coordinates:string>>>"
    feature = spark.read.json(path, schema=schema, multiLine=not lines).select(F.explode("features").alias("f")).select(
        F.col(f"f.properties.{name}").alias("name"),
        "f.geometry.*",
    )
    polygon = F.from_json("coordinates", "array<array<array<double>>>")
    parts = F.from_json("coordinates", "array<array<array<array<double>>>>")
    other = F.raise_error(F.concat(F.lit("a geometry that is no area: "), F.coalesce("type", F.lit("none"))))
    rings = F.when(F.col("type") == "Polygon", polygon).when(F.col("type") == "MultiPolygon", F.flatten(parts)).otherwise(other)
    points = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return feature.select("name", points.alias("rings")).select("name", "rings", F.col("rings")[0].alias("ring"))


def _path(spark: SparkSession, path: str) -> tuple:
    """A path and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    target, system = _path(spark, path)
    return system.exists(target)


def _is_file(spark: SparkSession, path: str) -> bool:
    target, system = _path(spark, path)
    return system.exists(target) and system.getFileStatus(target).isFile()


def _files(spark: SparkSession, path: str) -> Iterator[str]:
    """Paths of all files below a folder."""
    target, system = _path(spark, path)
    found = system.listFiles(target, True)
    while found.hasNext():
        yield found.next().getPath().toString()


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is absent."""
    target, system = _path(spark, path)
    return [x.getPath().getName() for x in system.listStatus(target)] if system.exists(target) else []


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file; false if there is one already, even if another writer has just created it."""
    target, system = _path(spark, path)
    if system.exists(target):
        return False
    try:
        out = system.create(target, False)
    except Exception as error:  # the file system's own exception, by way of Java
        if "AlreadyExists" in str(error) or "exist" in str(error):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


@contextmanager
def one_writer(spark: SparkSession, path: str, stale_hours: float = 24.0) -> Iterator[None]:
    """The right to write a table: a second writer is refused with an error while the first is at work. What a writer that
    died has left behind is taken over after ``stale_hours``."""
    lock = f"{path}.writer"
    if not _create(spark, lock, str(time.time())):
        target, system = _path(spark, lock)
        age = time.time() - system.getFileStatus(target).getModificationTime() / 1000
        if age < stale_hours * 3600:
            raise RuntimeError(f"{path} is being written since {age:.0f} s; if that writer is dead, delete {lock}")
        system.delete(target, False)
        if not _create(spark, lock, str(time.time())):
            raise RuntimeError(f"{path} is being written")
    try:
        yield
    finally:
        target, system = _path(spark, lock)
        system.delete(target, False)


def _unknown(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys ``known`` hasn't got; nulls are equal."""
    there = known.select(*[F.col(k).alias(f"{k}_there") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_there"))
    return df.join(there, same, "left_anti")


def append_batch(df: DataFrame, path: str, batch: int, keys: list[str] | None = None) -> bool:
    """Write a numbered batch once: false, and nothing changes, if it has been committed before. With keys, rows that are
    repeated or that another committed batch has go. A batch that failed half-way is written anew."""
    spark, folder = df.sparkSession, f"{path}/batch={batch}"
    if _exists(spark, f"{folder}/_SUCCESS"):
        df.write.format("noop").mode("overwrite").save()  # a stream's state wants its batch read
        return False
    if keys:
        df = df.dropDuplicates(keys)
        if _committed(spark, path):
            df = _unknown(df, batches(spark, path, df.schema), keys)
    df.write.mode("overwrite").parquet(folder)
    return True


def _committed(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/{n}" for n in _names(spark, path) if n.startswith("batch=") and _exists(spark, f"{path}/{n}/_SUCCESS")]


def batches(spark: SparkSession, path: str, schema: str | StructType, number: str | None = None) -> DataFrame:
    """The rows of all committed batches, with their number if it is given a name."""
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    paths = _committed(spark, path)
    rows = spark.read.schema(kind).parquet(*paths) if paths else spark.createDataFrame([], kind)
    if number:
        found = F.regexp_extract("_metadata.file_path", r"/batch=([0-9]+)/", 1).cast("long") if paths else F.lit(None).cast("long")
        rows = rows.select("*", found.alias(number))
    return rows


def publish(df: DataFrame, path: str, keep: int = 2) -> int:
    """Replace a table by a new version, and return its number.

    The version's rows lie in a folder of their own; a pointer file under the version's number, created if absent, makes it
    the one that counts. Readers (``published``) see the old table or the new one, never none; of two writers that began at
    the same version the second is refused, and the table that it meant to replace stays. The last ``keep`` versions stay
    for readers that have begun with them.
    """
    spark = df.sparkSession
    before = _versions(spark, path)
    number, folder = (before[-1] if before else 0) + 1, f"{path}/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    if not _create(spark, f"{path}/version-{number:012d}", folder.rsplit("/", 1)[1]):
        target, system = _path(spark, folder)
        system.delete(target, True)
        raise RuntimeError(f"another writer has published version {number} of {path}")
    for old in before[: max(len(before) + 1 - keep, 0)]:
        pointer = f"{path}/version-{old:012d}"
        rows, system = _path(spark, f"{path}/{_text(spark, pointer)}")
        system.delete(rows, True)
        system.delete(_path(spark, pointer)[0], False)
    return number


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removeprefix("version-")) for n in _names(spark, path) if re.fullmatch(r"version-[0-9]{12}", n))


def _text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()[0]


def published(spark: SparkSession, path: str) -> DataFrame:
    """The version of a table that counts."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"{path} has no published version")
    return spark.read.parquet(f"{path}/{_text(spark, f'{path}/version-{versions[-1]:012d}')}")


def append_new(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Append priced rows whose keys are neither in the table nor repeated (nulls are equal); returns outcome counts of the batch.

    New rows are worked out once, into a table, and counted there; of the target only keys are read. A second writer is refused.
    """
    spark = df.sparkSession
    no_price = F.coalesce(F.col("price"), F.lit(0)) == 0
    with one_writer(spark, path):
        fresh = df.filter(~no_price).dropDuplicates(keys)
        if _exists(spark, path):
            fresh = _unknown(fresh, spark.read.parquet(path), keys)
        fresh = materialize(fresh, "fresh")
        fresh.write.mode("append").parquet(path)
    counts = df.agg(F.count("*").alias("processed"), F.count_if(no_price).alias("no_price"))
    return counts.withColumn("inserted", F.lit(fresh.count()).cast("long")).withColumn("skipped", F.col("processed") - F.col("no_price") - F.col("inserted"))


def insert_ignore(df: DataFrame, path: str, key: str, order: str) -> int:
    """Insert rows whose key the table hasn't got, and return how many; what is there stays as it is.

    Of several new rows of a key the first by ``order`` goes in (ties by the whole row); rows without key conflict with
    none and all go in. A second writer is refused.
    """
    spark = df.sparkSession
    first = F.min(F.struct(F.col(order).alias("order_"), F.struct(*df.columns).alias("row_")))
    with one_writer(spark, path):
        keyed = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key_")).agg(first.alias("first_")).select("first_.row_.*")
        fresh = keyed.unionByName(df.filter(F.col(key).isNull()))
        if _exists(spark, path):
            fresh = fresh.join(spark.read.parquet(path).select(key), key, "left_anti").select(*df.columns)
        fresh = materialize(fresh, "fresh")
        fresh.write.mode("append").parquet(path)
    return fresh.count()


def quarantine(df: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows in the schema, rows of which a value doesn't fit), in one pass over text columns."""
    fields = _parse_datatype_string(schema).fields
    bad = F.lit(False)
    for f in fields:
        bad |= F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
    marked = df.withColumn("bad_", bad)
    return marked.filter("not bad_").select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]), marked.filter("bad_").drop("bad_")


def evolve(tables: list[DataFrame], schema: str) -> DataFrame:
    """Tables of older and newer shape as one, widened to the schema."""
    fields = _parse_datatype_string(schema).fields
    whole = union_all(tables)
    return whole.select(*[(F.col(f.name) if f.name in whole.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def replace_swap(df: DataFrame, path: str) -> None:
    """Replace a table by writing beside it and renaming twice. Between the renames the path is absent for a moment; if the
    second fails, the old table is put back and the error raised, and the old one is deleted only when the new one stands."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    new, old, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}", path))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.parquet(new.toString())
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{path} can't be moved away; the new table is at {new.toString()}")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{path} can't be replaced; the new table is at {new.toString()}")
    if had:
        fs.delete(old, True)


def export_flat(df: DataFrame, path: str, drop: tuple[str, ...] = ()) -> None:
    """CSV for people: some columns dropped, flags as 1 and 0, times without zone."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in drop}
    df.select(*[F.col(k).cast({"boolean": "int", "timestamp": "timestamp_ntz"}.get(t, t)).alias(k) for k, t in types.items()]).write.csv(path, header=True)
