"""Exact dedup by a tree-merge of sorted digest runs, in DataFrame operations alone.

Each scan partition gives a run: its distinct digests, sorted, with the smallest
id and the number of rows of each. In every round a fan of runs is exchanged and
merged into one, keeping for each digest the smallest identifier and the sum of
the counts, until one run is left (spread over partitions by digest). The result
then goes down the tree in one step: it meets the first runs' distinct digests,
and only then, run by run, the rows. So a digest that a third of all rows have
is one row of each run in every exchange, and its rows stay spread over the runs.

A digest is verified: it is the SHA-256 of the normalised text together with the
text's length in bytes and an independent 64-bit hash, and only rows that agree
in all three are equal.

Defined results: a null text counts as empty; among equal texts the row with the
smallest id stays, a null id coming after all others, and of rows that also share
the id one stays; an empty table gives an empty result; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.llm.rows import KEY, keep_rows, text_or_empty, with_key
from voxelforge.session import cut, table

WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Runs at the leaves, and how many of them a merge takes.
RUNS, FAN_IN = 256, 16
DIGEST = ["sha", "n_bytes", "check"]


def digests(docs: DataFrame, runs: int = RUNS) -> DataFrame:
    """A light row for each document: key, id, digest, run."""
    normal = F.regexp_replace(text_or_empty(), WHITE_SPACE, " ")
    return (
        with_key(docs)
        .select(*KEY, F.col("doc_id").cast("long").alias("doc_id"), normal.alias("normal"))
        .select(
            *KEY,
            "doc_id",
            F.unhex(F.sha2(F.encode("normal", "UTF-8"), 256)).alias("sha"),
            F.octet_length("normal").cast("long").alias("n_bytes"),
            F.xxhash64("normal").alias("check"),
            F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def merge_round(runs: DataFrame, fan_in: int) -> DataFrame:
    """Exchanges runs so that fan_in of them meet, and merges each such set, sorted."""
    met = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
    return (
        met.repartition("run", *DIGEST)
        .sortWithinPartitions("run", *DIGEST)
        .groupBy("run", *DIGEST)
        .agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    )


def exact_groups(docs: DataFrame, runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """For each row: _k1, _k2, doc_id, sha, keep_id, group_size, kept."""
    rows = cut(digests(docs, runs))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))
    leaves = rows.groupBy("run", *DIGEST).agg(F.min(first).alias("first"), F.count("*").alias("n"))
    top = leaves
    for _ in range(max(1, math.ceil(math.log(runs, fan_in)))):
        top = merge_round(top, fan_in)
    top = top.select(*DIGEST, F.col("first").alias("keep"), F.col("n").alias("group_size"))
    down = leaves.select("run", *DIGEST).join(top, DIGEST)
    return rows.join(down, ["run", *DIGEST]).select(
        *KEY,
        "doc_id",
        "sha",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    return keep_rows(docs, exact_groups(docs).where("kept").select(*KEY))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, dropped ones too."""
    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


OP3_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""
