"""Tables written once in the folder that driver and executors share, and broadcast by counted size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def written(df: DataFrame) -> DataFrame:
    """df, written under spark.checkpoint.dir and read back, so that plans that use it several times compute it once; only where that is unset and all runs in one process, under a new local folder."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="fundsieve-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """df, written and, if it has no more than `most` rows, with a hint to broadcast it."""
    df = written(df)
    return F.broadcast(df) if df.count() <= most else df


def dealt(df: DataFrame) -> DataFrame:
    """df over all cores where its files make fewer tasks; larger tables are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
