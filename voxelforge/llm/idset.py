"""Texts of a set of keys, with little moved: the others left out before the shuffle, these packed for it.

The set is a bitmap of fixed size with two bits a key (a Bloom filter). A row
that isn't in it can't be wanted; a row that is may still not be, so that an
exact join follows. The bitmap is all that the driver and the tasks ever hold,
whatever the number of keys; when it is full it lets every row pass, and the
join alone decides.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelforge.llm.rows import KEY, text_or_empty, with_key
from voxelforge.llm.words import mix

#: Bits of the bitmap: 4 MB.
BITS = 1 << 25


def _places(k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(k1.view(np.uint64) ^ mix(k2.view(np.uint64)))
    return h & np.uint64(BITS - 1), h >> np.uint64(32) & np.uint64(BITS - 1)


def bitmap(keys: DataFrame) -> np.ndarray:
    """The bitmap of the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BITS >> 6, dtype=np.uint64)
        for batch in batches:
            for p in _places(batch.column(0).to_numpy(), batch.column(1).to_numpy()):
                np.bitwise_or.at(held, p >> np.uint64(6), np.uint64(1) << (p & np.uint64(63)))
        word = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(held[word].view(np.int64))], names=["word", "bits"])

    words = keys.select(*KEY).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS >> 6, dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def unpacked(packed: pa.Scalar) -> bytes:
    """A text that texts_of has packed."""
    return zlib.decompress(packed.as_buffer())


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_k1, _k2, packed, and the columns of wanted) of the keys in wanted, which are unique; a row of each.

    packed is the text's bytes, deflated so that the shuffle moves less; see unpacked().
    """
    held = docs.sparkSession.sparkContext.broadcast(bitmap(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            ok = np.ones(batch.num_rows, dtype=bool)
            for p in _places(batch.column(0).to_numpy(), batch.column(1).to_numpy()):
                ok &= (bits[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
            rest = batch.filter(pa.array(ok))
            packed = pa.array([zlib.compress(x.as_buffer(), 1) for x in rest.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([rest.column(0), rest.column(1), packed], names=[*KEY, "packed"])

    rows = with_key(docs).select(*KEY, text_or_empty().cast("binary").alias("text"))
    nth = F.row_number().over(Window.partitionBy(*KEY).orderBy(*KEY))  # the join has sorted by the key
    return rows.mapInArrow(run, "_k1 long, _k2 long, packed binary").join(wanted, KEY).withColumn("_nth", nth).where("_nth = 1").drop("_nth")
