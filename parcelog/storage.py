"""Where intermediate tables and written artefacts live.

Everything that outlives a stage goes to the folder that the cluster names in
``spark.checkpoint.dir``: all executors and the driver see it, so work can be
resumed there after an executor is lost.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one only where the setting is absent and all runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if not root:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="parcelog-"))
            root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the reread table.

    This cuts lineage and keeps costly work from being repeated; unlike a cached
    frame it survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over as many tasks as a shuffle has: a small file is one task, however much work its rows are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession, rows: int = 512, size: int | None = None) -> None:
    """Let tasks hand texts to Python few at a time: whole texts can be long, and a batch lies in memory several times.
    ``size`` bounds a batch in bytes, too, for rows that are megabytes each."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": (rows, "10000"), "spark.sql.execution.arrow.maxBytesPerBatch": (size, str((1 << 31) - 1))}
    for key, (most, default) in limits.items():
        if most and not 0 < int(spark.conf.get(key, default).removesuffix("b")) <= most:
            spark.conf.set(key, str(most))
