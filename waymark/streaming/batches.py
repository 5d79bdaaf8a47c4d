"""Bounded crawl batches over a versioned frontier, and the same upserts as a Structured Streaming sink."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.tables import append_unique, dedupe_frontier, next_batch, one_of_key, retried, upsert


class Versions:
    """A table kept as numbered Parquet versions under a path that all executors share; the newest whole one counts.

    A version is whole once its writer has committed it, so a job that dies leaves the version before. A new object, in this
    session or after a restart, goes on from what the path holds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.at = max(self.numbers(), default=0)

    def numbers(self) -> list[int]:
        """The numbers of all whole versions."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v=*/_SUCCESS")) or []
        return sorted(int(m[1]) for f in found if (m := re.search(r"/v=(\d+)/_SUCCESS$", f.getPath().toString())))

    def write(self, rows: DataFrame, number: int | None = None) -> DataFrame:
        """Write the next version, or the one of that number, and read it: lineage ends here, and the version read before is not touched."""
        number = self.at + 1 if number is None else number
        rows.write.mode("overwrite").parquet(f"{self.path}/v={number:06d}")
        self.at = number
        return self.read()

    def read(self, number: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={self.at if number is None else number:06d}")

    def beside(self, name: str, key: Column) -> Versions:
        """A table of the same kind whose path has the name at its end, keyed by an expression where the kind has keys."""
        return Versions(self.spark, f"{self.path}-{name}")

    def holding(self, keys: DataFrame) -> DataFrame:
        """Rows among which all those with these rows' keys are."""
        return self.read()

    def change(self, number: int, keys: DataFrame, make: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
        """As step(); keys are those of the rows that may differ. Tables in buckets read and write only what these touch."""
        return self.step(number, make)

    def step(self, number: int, change: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
        """The version of that number, made from the newest one before it, or from None: the same when it is made again."""
        before = max((n for n in self.numbers() if n < number), default=0)
        return self.write(change(self.read(before) if before else None), number)

    def drop_before(self, keep: int = 2) -> None:
        """Delete all but the newest `keep` versions."""
        for n in self.numbers()[:-keep]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={n:06d}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(rows: DataFrame, above: int) -> DataFrame:
    """Rows without seq get one above all that were given before; the order among them is that of their partitions."""
    return rows.withColumn("seq", F.lit(above + 1).cast("bigint") + F.monotonically_increasing_id())


def candidate_key(kind: Column | str = "kind", source: Column | str = "source", value: Column | str = "value") -> Column:
    """What two candidates must not share, as text; a null is a value like others."""
    return F.to_json(F.struct(F.col(kind).alias("k"), F.col(source).alias("s"), F.lower(value).alias("v")), {"ignoreNullFields": "false"})


def crawl(frontier: Versions, visit: Callable[[DataFrame], DataFrame], size: int, rounds: int, max_depth: int = 3, gaps: Callable[[DataFrame], DataFrame] | None = None, land: Callable[[DataFrame, int], object] | None = None) -> DataFrame:
    """Run batches: take the best candidates, visit them, and put children, retries and the rest back.

    visit returns the batch's rows with outcome (done, failed) and children (array of struct<kind, value, source, priority>); a
    batch is one distributed job, so its candidates are visited side by side. gaps, if given, gets the visits' rows and
    returns candidates (kind, source, value, priority) that the found entities ask for: they join the same queue at depth 0.
    land, if given, gets the visits' rows and the batch's number before the frontier goes on; visits that were whole when a run
    broke off are not made again, so it may get the rows of one number twice.
    Children are one deeper; a candidate once visited does not come back but as a retry. Visited keys and those that may not be
    retried are kept as tables beside the frontier, so a later run, in this session or after a restart, knows them. Their versions have
    the number of the frontier that the batch leads to, so a batch that is run again after a crash writes them again, not twice.
    A null kind, source or value is a value like others: such a candidate is visited once.
    """
    spark = frontier.spark
    rows = frontier.read()
    seen, failed = frontier.beside("seen", F.col("key")), frontier.beside("failed", candidate_key())
    for _ in range(rounds):
        pending = dedupe_frontier(rows)
        batch = next_batch(pending, size, max_depth)
        visits = Versions(spark, f"{frontier.path}-visits-{frontier.at}")
        result = visits.read(1) if visits.at and not visits.read(1).isEmpty() else visits.write(visit(batch), 1)
        if result.isEmpty():
            break
        if land is not None:
            land(result, frontier.at)
        number, key = frontier.at + 1, candidate_key().alias("key")
        visited = result.select("kind", "source", "value")
        done = visited.select(key).distinct()
        seen.change(number, done, lambda before: append_unique(before, done, ["key"]) if before is not None else done)
        lost = result.where("outcome = 'failed'").select(pending.columns)
        again = retried(lost)
        final = lost.withColumn("key", key).join(again.select(key), "key", "left_anti").drop("key")
        failed.change(number, final, lambda before: before.unionByName(final) if before is not None else final)
        top = pending.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("top")).collect()[0]["top"]
        kids = result.where("outcome = 'done'").select("depth", F.explode("children").alias("c"))
        kids = kids.select("c.kind", "c.source", "c.value", "c.priority", (F.col("depth") + 1).cast("int").alias("depth"), F.lit(0).alias("retry_count"))
        if gaps is not None:
            kids = kids.unionByName(gaps(result).select("kind", "source", "value", "priority", F.lit(0).alias("depth"), F.lit(0).alias("retry_count")))
        kids = kids.where(F.col("depth") <= max_depth).withColumn("key", key)
        fresh = kids.join(seen.holding(kids), "key", "left_anti").drop("key")
        added = again.select(pending.columns).unionByName(numbered(fresh, int(top)).select(pending.columns))

        def after(before: DataFrame) -> DataFrame:
            left = dedupe_frontier(before).withColumn("key", key).join(done, "key", "left_anti").drop("key")
            return left.unionByName(added.select(left.columns))

        rows = frontier.change(number, visited.unionByName(added.select("kind", "source", "value")), after)
    return rows


def stream_upserts(stream: DataFrame, table: Versions, key: str, checkpoint: str, keep: list[str] = ()):
    """Upsert micro-batches into a versioned table, whole or in buckets by the key: of rows with one key in a batch the last by time
    wins, ties go to the largest row as JSON, and rows without a time come before all others. Rows with a null key are all added.
    Returns the query.

    A batch is the version of its own number over what the batch before left, so a batch that is played again after a restart gives
    the same version and loses nothing. The numbers of a checkpoint start above the versions that the table had when it was first
    used, so a table with other writers, or whose checkpoint was lost, goes on from its newest version.
    """
    base = table.at
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def first_number() -> int:
        marker = Versions(table.spark, f"{table.path}-base-{name}")
        return marker.read().collect()[0]["base"] if marker.at else marker.write(table.spark.createDataFrame([(base,)], "base long")).collect()[0]["base"]

    def apply(batch: DataFrame, number: int) -> None:
        own = first_number() + number + 1
        last = one_of_key(batch, key, [F.desc_nulls_last("ts")])
        table.change(own, last, lambda before: upsert(before, last, key, keep) if before is not None else last)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_frontier(spark: SparkSession) -> DataFrame:
    """The candidates of a new frontier: map categories, knowledge bases, web queries."""
    from waymark.functions import lexicons as lex

    rows = [("query", "openstreetmap", c, 1.0) for c in lex.SEED_CATEGORIES] + [("query", s, "Hyderabad", 0.9) for s in ("wikipedia", "wikidata")] + [("query", "google_search", q, 0.85) for q in lex.SEED_QUERIES]
    return spark.createDataFrame([(*r, 0, 0, i + 1) for i, r in enumerate(rows)], "kind string, source string, value string, priority double, depth int, retry_count int, seq long")


def seeded(frontier: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seeds joined to a frontier, keep-best by kind, source and value; of equal priority the frontier's own stay."""
    top = frontier.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("top")).collect()[0]["top"]
    return dedupe_frontier(frontier.unionByName(seeds.withColumn("seq", F.col("seq") + int(top)).select(frontier.columns)))
