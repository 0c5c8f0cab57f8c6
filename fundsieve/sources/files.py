"""Feeds, CSV and JSON parts as Spark reads and writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = "link string, title string, description string, pubDate string"


def read_feed(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """(link, title, description, pubDate) of a feed's items."""
    return spark.read.schema(ITEM).format("xml").option("rowTag", row_tag).load(path)


def feed_items(rows: DataFrame, xml: str) -> DataFrame:
    """Feed items held as XML in a column, parsed in place."""
    return rows.withColumn("item", F.from_xml(xml, ITEM))


def read_csv(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",") -> DataFrame:
    """Quoted cells with doubled quotes and line breaks; blank rows go."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.csv(path, header=True, multiLine=True, quote='"', escape='"', sep=sep).dropna("all")


def flat(rows: DataFrame, joiner: str = " | ") -> DataFrame:
    """Arrays joined, everything else as text, for CSV."""
    cell = lambda c, t: F.array_join(F.col(c).cast("array<string>"), joiner) if t.startswith("array") else F.col(c).cast("string")
    return rows.select(*[cell(c, t).alias(c) for c, t in rows.dtypes])


def write_csv(rows: DataFrame, path: str, sep: str = ",") -> None:
    flat(rows).write.csv(path, header=True, quoteAll=True, escape='"', sep=sep)


def write_json_parts(rows: DataFrame, path: str, rows_a_file: int) -> None:
    rows.write.option("maxRecordsPerFile", rows_a_file).json(path)


def csv_lines(rows: DataFrame, key: str) -> DataFrame:
    """(key, line): each row as a CSV line, every cell quoted, arrays joined, absent values empty."""
    texts = flat(rows)
    cells = F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in texts.columns])
    return texts.select(F.col(key).cast(rows.schema[key].dataType).alias(key), F.to_csv(cells, {"quoteAll": "true", "escape": '"'}).alias("line"))


def write_parts(rows: DataFrame, path: str, part: list[str]) -> None:
    """JSON parts in folders by the part columns, and beside them a manifest of the rows of each."""
    rows.repartition(*part).write.partitionBy(*part).json(f"{path}/parts")
    rows.groupBy(*part).agg(F.count(F.lit(1)).alias("n")).write.json(f"{path}/manifest")


def read_parts(spark: SparkSession, path: str, schema: str, part: list[str]) -> DataFrame:
    """The rows of all parts; fails if a part has other rows than the manifest says or is not in it."""
    rows = spark.read.schema(schema).json(f"{path}/parts")
    said = spark.read.schema(", ".join(f"{p} long" for p in [*part, "n"])).json(f"{path}/manifest")
    found = rows.groupBy(*[F.col(p).cast("long").alias(p) for p in part]).agg(F.count(F.lit(1)).alias("found"))
    wrong = said.join(found, part, "full_outer").where(~F.col("n").eqNullSafe(F.col("found"))).count()
    if wrong:
        raise ValueError(f"{wrong} parts differ from the manifest of {path}")
    return rows
