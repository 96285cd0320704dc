"""Packing by power-of-two decomposition.

Every document's token list is cut into pieces whose lengths are powers of two:
whole sequences first, then the binary digits of what is left. A piece is a
sequence of its own, of a length that needs no padding, so that no sequence
crosses documents; a trainer draws its batches from one length bucket at a time.

The work is one pass without a shuffle: a piece depends on its document alone.

Defined results: a null text counts as empty and gives the end mark alone;
repeated rows are packed once each; an empty table gives no pieces; columns of
the input other than the id and the text are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.session import table

SEQUENCE = 1024
END_ID = 0
#: Pieces handed on at once.
ROWS = 10_000


class ByteBpe:
    """Ids of whole texts under the byte-level BPE of a tokenizers JSON file.

    The file's vocabulary is handed to a faster encoder of the same merges. With
    specials, the string of one of the file's added tokens in a text is that
    token, as tokenizers reads it by default; without, it is ordinary text.
    """

    #: How the file's byte-level pre-tokenizer splits a text (fixed value; possessive where that changes nothing).
    SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

    def __init__(self, path: str, specials: bool = False) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        special = {x["content"]: x["id"] for x in said["added_tokens"]}
        if specials and any(x[k] for x in said["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("an added token that takes in or asks for what stands beside it can't be read")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        as_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(as_byte[c] for c in k): v for k, v in said["model"]["vocab"].items() if k not in special}
        encoding = tiktoken.Encoding("file", pat_str=self.SPLIT, mergeable_ranks=ranks, special_tokens=special if specials else {})
        self.encode = partial(encoding.encode, allowed_special="all") if specials else encoding.encode_ordinary

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return np.array(self.encode(text), dtype="<u4").tobytes()


def piece_lengths(n: int, longest: int) -> list[int]:
    """n as whole sequences, then its remaining binary digits, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


def default_vocabulary() -> str:
    """The installed file of the 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(docs: DataFrame, vocabulary: str | None = None, longest: int = SEQUENCE, with_ids: bool = True, specials: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, bucket, doc_tokens, ids, ids_crc32, sequence_id, offset.

    bucket is the power of two. sequence_id is unique; a sequence holds one
    piece, at offset 0. with_ids=False leaves the ids out of the rows. specials
    reads the strings of the file's added tokens as those tokens.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the sequence length must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(vocabulary or default_vocabulary(), specials)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = bpe.ids(text.as_py() or "") + END_ID.to_bytes(4, "little")
                n, start, view = len(ids) // 4, 0, memoryview(ids)
                for length in piece_lengths(n, longest):
                    part = view[4 * start : 4 * (start + length)]
                    rows.append((doc_id.as_py(), start, length, length.bit_length() - 1, n, zlib.crc32(part), bytes(part) if with_ids else None))
                    start += length
                if len(rows) >= ROWS:
                    yield as_batch(rows)
                    rows = []
            if rows:
                yield as_batch(rows)

    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
        .mapInArrow(run, "doc_id long, start long, length long, bucket int, doc_tokens long, ids_crc32 long, ids binary")
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )


NAMES = ["doc_id", "start", "length", "bucket", "doc_tokens", "ids_crc32", "ids"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows as Arrow."""
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), KINDS, strict=True)], names=NAMES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all documents, by digest."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False, specials=True).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"
    )
