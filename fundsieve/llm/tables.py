"""Lineage cuts and graph components shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only where it is unset and all runs in one process (tests), a new local one."""
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        set_to = "file://" + tempfile.mkdtemp(prefix="fundsieve-")
        spark.conf.set("spark.checkpoint.dir", set_to)
    return set_to.rstrip("/")


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """df, with fewer rows a batch on their way to Python where the session has Spark's default: whole texts are long, and the executor holds each batch outside its heap several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(key) == "10000":
        df.sparkSession.conf.set(key, str(rows))
    return df


def cut(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder once and read it back: later plans start from its files, and lost executors lose nothing."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of links(a, b), the component being its smallest node.

    Alternating large and small stars: every node points its larger neighbours at its smallest, until nothing
    changes. Rounds grow with the logarithm of the longest chain; each round is two aggregations that combine
    before their shuffle, so a node with very many links is never gathered.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = cut(small.where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def quantile_cuts(df: DataFrame, keys: list[str], buckets: int, sample: int = 4096) -> list[tuple]:
    """Keys that split df into about equal ranges, from a bounded uniform sample. They steer the balance of tasks, never a result."""
    rows = df.select(*keys).orderBy(F.xxhash64(*keys)).limit(sample)
    rows = [tuple(r) for r in rows.orderBy(*keys).collect()]
    picked = [rows[i * len(rows) // buckets] for i in range(1, buckets)] if len(rows) >= buckets else rows[1:]
    return list(dict.fromkeys(picked))


def range_bucket(df: DataFrame, keys: list[str], cuts: list[tuple]) -> Column:
    """How many cuts are not above the row's key, by binary search."""
    key, types = F.struct(*keys), dict(df.dtypes)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        at = F.struct(*[F.lit(v).cast(types[k]).alias(k) for k, v in zip(keys, cuts[mid], strict=True)])
        return F.when(key >= at, search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(cuts))
