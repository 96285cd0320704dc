"""Mixing sources to target weights by cube-method balanced sampling.

A source whose target is r times its size has every document taken floor(r)
times, and once more with probability r - floor(r). Which ones is a sample that
balances tokens and documents: the flight phase moves three undecided documents
at a time along the null-space of the two constraints until one of them is
decided, so that the sums of tokens and of documents stay as they are. Blocks of
a source fly on their own, at most two documents each stay undecided, and these
fly again as one. About RESERVE documents of a block, and then of a source, don't
fly: with the last undecided ones they are the landing problem, solved by
exchanges for the corner nearest to the expected tokens and documents. So a
single long document that stays undecided can be weighed up by others.

A block is a stream over sorted rows with three of them in hand, so that neither
a large source nor a large block needs memory. What is drawn follows from ids
and texts alone, and reruns agree.

Defined results: a null text has size 0; the null source is a source, last in
order; repeated rows are documents of their own; a source without words gets
nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelforge.llm.rows import KEY, keep_rows, text_or_empty, with_key
from voxelforge.session import cut, table

WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Most that a target is of its source's size; weights by the source's rank; documents in a block.
MOST, WEIGHTS, BLOCK = 3.0, (1, 2, 3), 20_000
#: Documents that are kept for the landing, as expected; at most four times as many are.
RESERVE = 32


def sizes(docs: DataFrame) -> DataFrame:
    """Key, id, source and number of words of each row."""
    words = F.filter(F.split("_text", WHITE_SPACE), lambda x: x != "")
    return (
        with_key(docs)
        .select(*KEY, F.col("doc_id").cast("long").alias("doc_id"), "source", text_or_empty().alias("_text"))
        .select(*KEY, "doc_id", "source", F.size(words).cast("long").alias("size"))
    )


def source_key() -> Column:
    """A string that tells sources apart, null too."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))


def targets(rows: DataFrame, most: float = MOST) -> DataFrame:
    """src, source_size, n_docs, target: one row for each source.

    With c the level at which sum(min(c * weight, most * size)) is all words,
    a target is the smaller of the two. Sources sorted by the level at which they
    are full, c follows from running sums. The sort is over one row a source.
    """
    by = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = by.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = ranked.withColumn("weight", F.get(weights, (F.col("rank") - 1) % len(WEIGHTS)).cast("double"))
    full = weighed.withColumn("full", most * F.col("source_size") / F.col("weight"))
    w = Window.orderBy("full", "rank")
    every = Window.partitionBy()
    before = full.withColumns(
        {
            "held": F.coalesce(F.sum("source_size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * most,
            "open": F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing)),
            "all": F.sum("source_size").over(every),
        }
    ).withColumn("level", (F.col("all") - F.col("held")) / F.col("open"))
    level = F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "rank", "level"))).over(every)["level"]
    capped = F.coalesce(F.col("c") * F.col("weight") >= most * F.col("source_size"), F.lit(True))
    return before.withColumn("c", level).select(
        source_key().alias("src"), "source_size", "n_docs",
        F.when(capped, most * F.col("source_size")).otherwise(F.col("c") * F.col("weight")).alias("target"),
    )


class Flight:
    """Undecided units of one stream. A unit is [p, size, payload]."""

    def __init__(self, seed: int) -> None:
        self.held: list[list] = []
        self.kept: list[list] = []
        self.rng = np.random.default_rng(seed)
        self.draws: list[float] = []

    def draw(self) -> float:
        """The next uniform number."""
        if not self.draws:
            self.draws = self.rng.random(4096).tolist()
        return self.draws.pop()

    def add(self, unit: list, reserve: bool) -> list[list]:
        """Takes a unit in; gives back those that are decided."""
        if not 0.0 < unit[0] < 1.0:
            return [unit]
        if reserve and len(self.kept) < 4 * RESERVE:
            self.kept.append(unit)
            return []
        out = []
        self.held.append(unit)
        while len(self.held) == 3:
            out += self.move()
        return out

    def move(self) -> list[list]:
        """One step in the null-space of (size, 1) over three units."""
        a, b, c = self.held
        v = (b[1] - c[1], c[1] - a[1], a[1] - b[1])
        if not any(v):
            v = (1.0, -1.0, 0.0)
        up = min((1 - u[0]) / d if d > 0 else -u[0] / d for u, d in zip(self.held, v, strict=True) if d)
        down = min(u[0] / d if d > 0 else (u[0] - 1) / d for u, d in zip(self.held, v, strict=True) if d)
        go = up if self.draw() * (up + down) < down else -down
        for u, d in zip(self.held, v, strict=True):
            u[0] += go * d
            u[0] = 0.0 if u[0] < 1e-9 else 1.0 if u[0] > 1 - 1e-9 else u[0]
        done = [u for u in self.held if u[0] in (0.0, 1.0)]
        self.held = [u for u in self.held if 0.0 < u[0] < 1.0]
        return done

    def undecided(self) -> list[list]:
        """What is left."""
        return self.held + self.kept

    def land(self) -> list[list]:
        """Decides what is left: from a systematic draw, exchanges of one or two units while they bring the sums nearer."""
        left = self.undecided()
        if not left:
            return left
        p, size = np.array([u[0] for u in left]), np.array([float(u[1]) for u in left])
        x = np.diff(np.floor(np.cumsum(p) + self.draw()), prepend=np.floor(0.0))
        x = np.clip(x, 0, 1)
        scale = max(1.0, float(size.mean()))
        while True:
            tokens, count = float((size * (x - p)).sum()), float((x - p).sum())
            d = 1 - 2 * x
            t, n = tokens + (d * size)[:, None] + (d * size)[None, :], count + d[:, None] + d[None, :]
            np.fill_diagonal(t, tokens + d * size)
            np.fill_diagonal(n, count + d)
            cost = np.abs(t) / scale + 0.01 * np.abs(n)
            i, j = np.unravel_index(int(cost.argmin()), cost.shape)
            if cost[i, j] >= abs(tokens) / scale + 0.01 * abs(count) - 1e-9:
                break
            for k in {i, j}:
                x[k] = 1 - x[k]
        for u, v in zip(left, x.tolist(), strict=True):
            u[0] = v
        return left


def fly(rows: DataFrame, landing: bool) -> DataFrame:
    """Rows (src, block, order, p, size, ...), sorted by stream, with p moved; landing decides all."""
    names = rows.columns
    at = {n: i for i, n in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, flight, schema = None, None, None
        for batch in batches:
            schema = batch.schema
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = (row[at["src"]], row[at["block"]])
                if key != stream:
                    if flight:
                        out += flight.land() if landing else flight.undecided()
                    stream, flight = key, Flight(row[at["seed"]] & (2**63 - 1))
                out += flight.add([row[at["p"]], row[at["size"]], row], row[at["reserve"]])
            yield as_batch(out, schema)
        if flight:
            yield as_batch(flight.land() if landing else flight.undecided(), schema)

    def as_batch(units: list[list], schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*(u[2][: at["p"]] + (u[0],) + u[2][at["p"] + 1 :] for u in units), strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.repartition("src", "block").sortWithinPartitions("src", "block", F.desc("size"), "order", *KEY).mapInArrow(run, rows.schema)


def mix(docs: DataFrame, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """For each row: _k1, _k2, doc_id, size, source_size, target, copies."""
    rows = cut(sizes(docs))
    by = cut(targets(rows, most))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    order = F.xxhash64("doc_id", "_k2")
    units = (
        rows.withColumn("src", source_key())
        .join(by, "src")
        .withColumn("ratio", ratio)
        .withColumn("order", order)
        .withColumn("block", F.pmod(F.xxhash64("order", F.lit(7)), F.ceil(F.col("n_docs") / block)))
        .withColumn("reserve", F.pmod(F.xxhash64("order", F.lit(11)), F.greatest(F.lit(1), F.floor(F.least("n_docs", F.lit(block)) / RESERVE))) == 0)
        .withColumn("blocks", F.ceil(F.col("n_docs") / block))
        .withColumn("whole", F.floor("ratio"))
        .withColumn("p", (F.col("ratio") - F.col("whole")).cast("double"))
        .withColumn("seed", F.xxhash64("src", "block"))
        .select(*KEY, "doc_id", "src", "block", "order", "seed", "reserve", "blocks", "size", "source_size", "target", "whole", "p")
    )
    flown = cut(fly(units, landing=False))
    open_ = (F.col("p") > 0) & (F.col("p") < 1)
    rest = flown.where(open_).withColumns(
        {
            "block": F.lit(-1).cast("long"),
            "seed": F.xxhash64("src"),
            "reserve": F.col("reserve") & (F.pmod(F.xxhash64("order", F.lit(13)), F.col("blocks")) == 0),
        }
    )
    landed = fly(rest, landing=True)
    return (
        flown.where(~open_)
        .unionByName(landed)
        .select(*KEY, "doc_id", "size", "source_size", "target", (F.col("whole") + F.col("p").cast("long")).alias("copies"))
    )


def take(docs: DataFrame) -> DataFrame:
    """The mix: every row as often as it is taken, with all its columns."""
    copies = mix(docs).groupBy(*KEY).agg(F.sum("copies").alias("_copies"))
    return keep_rows(docs, copies)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )
