"""Decisions about documents, joined back to their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["_k1", "_k2"]


def text_or_empty() -> Column:
    """The text, a null as the empty string."""
    return F.coalesce(F.col("text"), F.lit(""))


def key_columns() -> list[Column]:
    """The key under which a row's decision is found: its id and 63 bits of a hash of its text.

    The sign of the second tells whether there is an id: it is negative where there is one. So every
    id is itself, and a null id comes after all others. Rows that agree in both are repeats of one
    document and share a decision; two texts without an id share one by chance in n^2 / 2^64 cases.
    """
    some = F.col("doc_id").isNotNull()
    low = F.xxhash64(text_or_empty()).bitwiseAND(F.lit(2**63 - 1))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("_k1"), F.when(some, low.bitwiseOR(F.lit(-(2**63)))).otherwise(low).alias("_k2")]


def id_of(k1: str, k2: str) -> Column:
    """The id in a key, null where there is none."""
    return F.when(F.col(k2) < 0, F.col(k1))


def with_key(docs: DataFrame) -> DataFrame:
    """The columns of documents with the key."""
    return docs.select(*key_columns(), *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in KEY])


def keep_rows(docs: DataFrame, decisions: DataFrame, once: bool = True) -> DataFrame:
    """Rows of docs with a decision (columns _k1 and _k2, unique), with all their columns.

    once: of repeats one stays, the first by its other columns; Spark cuts each
    key to one row before the shuffle, so that a key with many repeats doesn't
    gather anywhere. With a column _copies, a row comes back that many times.
    The columns travel as one struct, so that their names can't clash.
    """
    rows = docs.select(*key_columns(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    if once:
        order = [F.col("_row").getField(c) for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind and "variant" not in kind]
        w = Window.partitionBy(*KEY).orderBy(*(order or [F.lit(0)]))
        rows = rows.withColumn("_nth", F.row_number().over(w)).where("_nth = 1")
    out = rows.join(decisions, KEY)
    if "_copies" in decisions.columns:
        out = out.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return out.select("_row.*")
