"""Journals, progress logs and incremental artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The events that may follow each other for one key.
ALLOWED = [(None, "intent"), ("intent", "deleted"), ("intent", "recovered_deleted")]


def transitions(journal: DataFrame, key: list[str], event: str, seq: str, allowed: list[tuple] | None = None) -> DataFrame:
    """Adds previous and legal to every journal row."""
    before = F.lag(event).over(Window.partitionBy(*key).orderBy(seq))
    pairs = [F.col("previous").eqNullSafe(F.lit(a)) & (F.col(event) == b) for a, b in (allowed or ALLOWED)]
    legal = pairs[0]
    for p in pairs[1:]:
        legal = legal | p
    return journal.withColumn("previous", before).withColumn("legal", legal)


def last_state(journal: DataFrame, key: list[str], event: str, seq: str) -> DataFrame:
    """The last event of each key."""
    return journal.groupBy(*key).agg(F.max_by(event, seq).alias("state"), F.count("*").alias("n"))


def replay(states: DataFrame, live: DataFrame, key: list[str]) -> DataFrame:
    """What a restart does with each key: recovered_deleted for an intent whose file is gone, error for a deleted one that is there, else nothing."""
    told = states.join(live.select(*key, F.lit(True).alias("live")), key, "left").withColumn("live", F.coalesce("live", F.lit(False)))
    act = F.when((F.col("state") == "intent") & ~F.col("live"), "recovered_deleted").when(F.col("state").isin("deleted", "recovered_deleted") & F.col("live"), "error")
    return told.withColumn("action", F.coalesce(act, F.lit("none")))


def last_progress(lines: DataFrame, order: str, pattern: str = r"Done\s+(\d+) tasks") -> DataFrame:
    """(done): the number in the last line that has one; the last, not the largest."""
    n = F.regexp_extract("line", pattern, 1).try_cast("long")
    return lines.withColumn("n", n).where("n IS NOT NULL").agg(F.max_by("n", order).alias("done"))


def stale(rows: DataFrame, source: DataFrame, key: list[str], digest: str, schema_version: int) -> DataFrame:
    """Keys of source whose artifact is missing, of another digest or of another schema: what must be made again."""
    good = rows.where(F.col("schema_version") == schema_version).select(*key, digest)
    return source.select(*key, digest).join(good, [*key, digest], "left_anti")


def upsert(there: DataFrame, made: DataFrame, key: list[str]) -> DataFrame:
    """What is there with what was made anew in its place."""
    return there.join(made.select(*key), key, "left_anti").unionByName(made)


def fresh(at: Column, now: Column, oldest: int = 900, ahead: int = 60) -> Column:
    """Whether evidence is at most so many seconds old, or so many ahead."""
    age = F.unix_timestamp(now) - F.unix_timestamp(at)
    return (age >= -ahead) & (age <= oldest)


#: What orders the splits of log files.
PLACE = ["file_modification_time", "file_path", "file_block_start"]


def watch_log(spark: SparkSession, folder: str, on_progress, pattern: str = r"Done\s+(\d+) tasks"):
    """A stream over the files of a log folder; on_progress(batch id, done) gets every batch's last progress.

    Lines are in the order of their files' times and names, and in a file as they stand. The caller starts and stops the
    query; a batch is read again after a failure, so on_progress must be idempotent.
    """
    lines = spark.readStream.format("text").load(folder).select(F.col("value").alias("line"), F.struct(*[F.col(f"_metadata.{c}") for c in PLACE]).alias("place"))

    def each(batch: DataFrame, batch_id: int) -> None:
        row = last_progress(batch.withColumn("pos", F.struct("place", F.monotonically_increasing_id())), "pos", pattern).first()
        if row and row["done"] is not None:
            on_progress(batch_id, row["done"])

    return lines.writeStream.foreachBatch(each)


def not_monotonic(rows: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Rows whose value is less than that of the row before them."""
    before = F.lag(value).over(Window.partitionBy(*key).orderBy(order))
    return rows.withColumn("previous", before).where(F.col(value) < F.col("previous"))
