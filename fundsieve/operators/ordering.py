"""Running totals, nearest rows in time, and closures, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.sources.scratch import written


def running_total(rows: DataFrame, key: str, size: Column, name: str, partitions: int | None = None) -> DataFrame:
    """rows with the sum of `size` over all rows before theirs in order of key (unique), as column `name`.

    Rows are dealt by ranges of the key and written; each range's sum is carried to the ranges behind it, and a window
    runs inside each range only.
    """
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_size", size.cast("long")).repartitionByRange(n, key).withColumn("_range", F.spark_partition_id())
    dealt = written(dealt)
    sums = dealt.groupBy("_range").agg(F.sum("_size").alias("_sum"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    sums = sums.select("_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_ahead") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    return dealt.join(F.broadcast(sums), "_range").withColumn(name, total).drop("_range", "_size", "_ahead")


def packed(rows: DataFrame, key: str, json: Column, target: int, partitions: int | None = None) -> DataFrame:
    """(part, n, chars, first_key, last_key): rows in order of key cut into parts where their running size passes a multiple of target, over the whole table."""
    t = running_total(rows.select(key, F.length(json).cast("long").alias("chars")), key, F.col("chars"), "at", partitions)
    return t.groupBy(F.floor(F.col("at") / target).cast("long").alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def within(left: DataFrame, right: DataFrame, left_time: str, right_time: str, seconds: int) -> DataFrame:
    """Pairs whose times are at most `seconds` apart, with that distance, by an equi-join on time buckets of that length: a row meets its own bucket and the two beside it."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bucket = lambda c: F.floor(micros(c) / (1_000_000 * seconds))
    a = left.withColumn("_bucket", F.explode(F.array(*[bucket(left_time) + d for d in (-1, 0, 1)])))
    b = right.withColumn("_bucket", bucket(right_time))
    apart = F.abs(micros(left_time) - micros(right_time))
    return a.join(b, "_bucket").drop("_bucket").withColumn("apart", apart).where(F.col("apart") <= 1_000_000 * seconds)


def best_by_pairs(builds: DataFrame, runs: DataFrame, seconds: int) -> DataFrame:
    """(build_id, source_id, f): the best run of each source for each build, from all pairs within the tolerance."""
    fields = F.struct("success", "imported")
    own = builds.join(runs, builds["cycle"] == runs["cycle_id"]).select("build_id", "source_id", F.struct(F.lit(0).cast("long").alias("kind"), F.lit(0).cast("long").alias("apart"), F.col("cycle_id")).alias("o"), fields.alias("f"))
    near = within(builds, runs, "generated_at", "checked_at", seconds).select("build_id", "source_id", F.struct(F.lit(1).cast("long").alias("kind"), "apart", "cycle_id").alias("o"), fields.alias("f"))
    return own.union(near).groupBy("build_id", "source_id").agg(F.min(F.struct("o", "f"))["f"].alias("f"))


def reigns(runs: DataFrame, seconds: int) -> DataFrame:
    """(source_id, first, last, f): the microseconds from first to last at which a run is its source's nearest within the tolerance; of equally near ones the smaller cycle_id."""
    at = F.unix_micros(F.col("checked_at").cast("timestamp"))
    t = runs.select("source_id", at.alias("at"), F.struct("cycle_id", F.struct("success", "imported").alias("f")).alias("r")).where("at IS NOT NULL")
    t = t.groupBy("source_id", "at").agg(F.min("r").alias("r"))
    w = Window.partitionBy("source_id").orderBy("at")
    # Up to the middle between two runs the earlier one is nearest; in the middle itself the smaller of both.
    twice, beats = F.col("at") + F.lead("at").over(w), F.col("r") <= F.lead("r").over(w)
    t = t.withColumn("until", F.shiftright(twice - F.when(beats, 0).otherwise(1), 1))
    micros = 1_000_000 * seconds
    first = F.greatest(F.col("at") - micros, F.lag("until").over(w) + 1)
    return t.select("source_id", first.alias("first"), F.least(F.col("at") + micros, "until").alias("last"), F.col("r.f").alias("f")).where("first <= last")


def running_sums(rows: DataFrame, at: str, ties: str, names: list[str], partitions: int | None = None) -> DataFrame:
    """rows with each named column replaced by its sum over all rows up to theirs in order of at, then ties: by ranges of `at`, whose sums are carried to the ranges behind them."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(rows.repartitionByRange(n, at).withColumn("_range", F.spark_partition_id()))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    sums = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_{c}") for c in names])
    sums = sums.select("_range", *[F.coalesce(F.sum(f"_{c}").over(ahead), F.lit(0)).alias(f"_{c}") for c in names])
    inside = Window.partitionBy("_range").orderBy(at, ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = dealt.join(F.broadcast(sums), "_range").withColumns({c: F.col(f"_{c}") + F.sum(c).over(inside) for c in names})
    return out.drop("_range", *[f"_{c}" for c in names])


def fresh_coverage(builds: DataFrame, runs: DataFrame, seconds: int) -> DataFrame:
    """(build_id, fresh, successful, imported): the sources whose run nearest to the build's time is fresh: one of its own cycle, else one within the tolerance.

    builds: build_id, cycle, generated_at; runs: cycle_id, source_id, checked_at, success, imported. A run of the
    build's cycle comes before all others, then the nearest, then the smaller cycle_id.

    Each run is its source's nearest for one stretch of time, so a build's totals are running sums of what begins and
    ends before it, and no build meets the runs around it. For the few sources that have a run of the build's own cycle,
    the nearest run is looked up in order of time and taken off. Only builds whose id stands for several are paired.
    """
    builds = written(builds.distinct().withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("build_id"))))
    again = builds.where("_n > 1").drop("_n")
    builds = builds.where("_n = 1").select("build_id", "cycle", F.unix_micros(F.col("generated_at").cast("timestamp")).alias("at"))
    names = ["fresh", "successful", "known", "imported"]

    def counted(f: Column, sign: int) -> list[Column]:
        values = [F.lit(1), f["success"].cast("int"), f["imported"].isNotNull().cast("int"), f["imported"]]
        return [(F.coalesce(v.cast("long"), F.lit(0)) * sign).alias(n) for n, v in zip(names, values, strict=True)]

    nearest = written(reigns(runs, seconds))
    nobody = F.lit(None).cast(builds.schema["build_id"].dataType).alias("build_id")
    changes = nearest.select("first", "last", "f")
    steps = changes.select(F.col("first").alias("at"), nobody, F.lit(0).alias("asks"), *counted(F.col("f"), 1)).union(changes.select(F.col("last") + 1, nobody, F.lit(0), *counted(F.col("f"), -1)))
    steps = steps.groupBy("at", "build_id", "asks").agg(*[F.sum(n).alias(n) for n in names])
    asked = builds.where("at IS NOT NULL").select("at", "build_id", F.lit(1).alias("asks"), *[F.lit(0).cast("long").alias(n) for n in names])
    near = running_sums(steps.union(asked), "at", "asks", names).where("asks = 1").select("build_id", *names)

    # A run of the build's own cycle takes the place of its source's nearest one.
    own = builds.join(runs, builds["cycle"] == runs["cycle_id"]).groupBy("build_id", "source_id", "at").agg(F.min(F.struct("success", "imported")).alias("f"))
    own = written(own)
    line = nearest.select("source_id", F.col("first").alias("at"), F.lit(0).alias("asks"), nobody, F.struct("last", "f").alias("now"))
    line = line.union(own.where("at IS NOT NULL").select("source_id", "at", F.lit(1), "build_id", F.lit(None).cast(line.schema["now"].dataType)))
    sofar = Window.partitionBy("source_id").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    off = line.withColumn("now", F.last("now", True).over(sofar)).where("asks = 1 AND at <= now.last")
    parts = near.union(own.select("build_id", *counted(F.col("f"), 1))).union(off.select("build_id", *counted(F.col("now.f"), -1)))
    parts = parts.union(best_by_pairs(again, runs, seconds).select("build_id", *counted(F.col("f"), 1)))
    total = parts.groupBy("build_id").agg(*[F.sum(n).alias(n) for n in names]).where("fresh > 0")
    return total.select("build_id", "fresh", "successful", F.when(F.col("known") > 0, F.col("imported")).alias("imported"))


def sitemap_pages(maps: DataFrame, starts: DataFrame, most_maps: int | None = None) -> DataFrame:
    """(source_id, url): the distinct pages in all sitemaps that each source's start map (source_id, url) leads to.

    maps(url, xml): an index names further maps, any other map pages. Rounds follow the indexes until none names a map
    that is new to its source, so cycles end; a source reads at most `most_maps` maps, in order of round and url.
    """
    locs = F.transform(F.regexp_extract_all("xml", F.lit("(?i)<loc>([^<]+)</loc>"), F.lit(1)), lambda x: F.trim(F.replace(x, F.lit("&amp;"), F.lit("&"))))
    read = maps.select("url", F.col("xml").rlike(r"(?i)<sitemapindex\b").alias("is_index"), F.filter(locs, lambda x: x != "").alias("locs"))
    seen = written(starts.select("source_id", "url").distinct().withColumn("round", F.lit(0)))
    now, n = seen, 0
    while True:
        n += 1
        named = now.join(read.where("is_index"), "url").select("source_id", F.explode("locs").alias("url")).distinct()
        now = written(named.join(seen, ["source_id", "url"], "left_anti").withColumn("round", F.lit(n)))
        if now.isEmpty():
            break
        seen = written(seen.unionByName(now))
    if most_maps is not None:
        order = Window.partitionBy("source_id").orderBy("round", "url")
        seen = seen.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most_maps)
    return seen.join(read.where("NOT is_index"), "url").select("source_id", F.explode("locs").alias("url")).distinct()
