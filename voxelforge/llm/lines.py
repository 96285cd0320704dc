"""Line dedup by overlapping three-line windows.

Every three consecutive lines are hashed to 128 bits. A window that occurs more
than once anywhere stays where it occurs first (smallest id, then place); the
lines that its later occurrences cover are removed, covered places merging.

Windows, not texts, are shuffled to find the repeats, counted before they move;
a window that a third of all documents have is one row of each task there, and
the join that marks its later occurrences is one that Spark splits.

Defined results: a null text is one empty line; a text of fewer than three lines
has no window and stays; a null id comes after all others; rows that share id and
text are one document, so that they aren't held against each other; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.llm.rows import KEY, text_or_empty, with_key
from voxelforge.session import cut, table

WINDOW = 3


def with_lines(docs: DataFrame) -> DataFrame:
    """Key, id and lines."""
    return with_key(docs).select(*KEY, F.col("doc_id").cast("long").alias("doc_id"), F.split(text_or_empty(), "\n", -1).alias("lines"))


def windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(h1, h2, _k1, _k2, pos, no_id): every window of every document once."""
    lines = lambda i: [F.get("lines", i + k) for k in range(width)]
    hashed = F.transform(
        F.sequence(F.lit(0), F.size("lines") - width),
        lambda i: F.struct(F.xxhash64(*lines(i)).alias("h1"), F.xxhash64(F.lit(width), *lines(i)).alias("h2"), i.alias("pos")),
    )
    return (
        with_lines(docs)
        .where(F.size("lines") >= width)
        .select(*KEY, F.col("doc_id").isNull().alias("no_id"), F.explode(hashed).alias("w"))
        .select("w.h1", "w.h2", "no_id", *KEY, "w.pos")
    )


def later_windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(_k1, _k2, at): of each document the sorted starts of windows that occur earlier."""
    every = cut(windows(docs, width))
    place = F.struct("no_id", "_k1", "_k2", "pos")
    repeated = every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return every.join(repeated, ["h1", "h2"]).where(place != F.col("first")).groupBy(*KEY).agg(F.sort_array(F.collect_set("pos")).alias("at"))


def line_dedup(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """For each row: doc_id, n_lines, removed (sorted line numbers), kept_text."""
    covered = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + width - 1))))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    return (
        with_lines(docs)
        .join(later_windows(docs, width).select(*KEY, covered.alias("found")), KEY, "left")
        .withColumn("removed", F.coalesce("found", F.array().cast("array<int>")))
        .withColumn("stays", stays)
        .select(
            "doc_id", F.size("lines").cast("long").alias("n_lines"), "removed",
            F.array_join(F.transform("stays", lambda i: F.get("lines", i)), "\n").alias("kept_text"),
        )
    )


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup removes from every document and leaves, by digest."""
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"),
    )


OP4_SQL = """
WITH l AS (
  SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) - 1 AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)
), w AS (
  SELECT doc_id, pos, line, lead(line) OVER d AS b, lead(line, 2) OVER d AS c FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, pos) > 1 AS later FROM w WHERE c IS NOT NULL
), m AS (
  SELECT l.doc_id, l.pos, l.line,
    coalesce(max(r.later) OVER (PARTITION BY l.doc_id ORDER BY l.pos ROWS 2 PRECEDING), false) AS removed
  FROM l LEFT JOIN r USING (doc_id, pos)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
