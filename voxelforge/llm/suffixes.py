"""Suffix-array dedup by a depth-limited radix sort.

Which THRESHOLD-byte strings occur more than once follows from the order of the
suffixes to that depth alone: equal groups are the repeated windows. The passes go
by most significant digit, and only groups that can still split go on.

Digit 1 is an anchor of GRAM bytes. Every window has one, the smallest by hash
(leftmost of equals) of the grams inside it, so that equal windows have equal
anchors at equal offsets and only one suffix in some thirty bytes needs sorting.
Digit 2 is the whole stretch that an anchor's windows cover: where it equals an
earlier one, all its windows repeat and are settled in one row. Left are stretches
that share an anchor but differ, such as the edges of a passage. Digit 3 is the
anchor with half of what is missing to a window on its right, or on its left; a
repeated window has one of these in it. Digit 4 is the window itself.

Every pass is a shuffle by digit and a sort within the partitions, read as a
stream; no group is held in memory.

Positions are bytes of the UTF-8 text. Order is by id, then place; a null id
comes after all others; rows that share id and text are one document, so that
they aren't held against each other. A null text counts as empty; texts shorter
than the threshold lose nothing; texts of any length are read whole; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelforge.llm.idset import texts_of, unpacked
from voxelforge.llm.rows import KEY, text_or_empty, with_key
from voxelforge.llm.words import mix, text_groups
from voxelforge.session import cut, table

#: Bytes of a window and of an anchor.
THRESHOLD, GRAM = 100, 32
#: Bits of a place within a segment of text; segments are as long at most.
PLACE = 21

_rng = np.random.default_rng(20240608)
_OF_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M = np.uint64(0xD6E8FEB86659FD93)
_ROOT = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _power(base: int) -> np.ndarray:
    if base not in _powers:
        out = np.full((1 << PLACE) + 1, base, dtype=np.uint64)
        out[0] = 1
        _powers[base] = np.cumprod(out)
    return _powers[base]


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes from each place on, by doubling."""
    join = lambda x, y: (x * _M ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + y
    part, size, out, done = _OF_BYTE[b], 1, None, 0
    while k:
        if k & 1:
            out = part if out is None else join(out[: len(part) - done], part[done:])
            done += size
        k >>= 1
        if k:
            part = join(part[:-size], part[size:])
            size *= 2
    return mix(out)


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` values the place of the smallest, leftmost of equals."""
    low = np.uint64((1 << PLACE) - 1)
    c = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    n = len(h) - width + 1
    block = np.concatenate([c, np.full(-len(c) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)


def stretches(b: np.ndarray, ends: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: (first window, last window, anchor place, gram hash, stretch hash).

    ends[p] is the end of the text at p. A stretch is the run of windows that share an anchor.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(b) < depth:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    h = gram_hashes(b, gram)
    anchor = least_places(h, depth - gram + 1)
    p = np.flatnonzero(np.arange(len(anchor)) + depth <= ends[: len(anchor)])
    if not len(p):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    a, e = anchor[p], ends[p]
    new = np.ones(len(p), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (e[1:] != e[:-1])
    at = np.flatnonzero(new)
    lo, hi, a = p[at], p[np.concatenate([at[1:], [len(p)]]) - 1], a[at]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[b] * _power(_ROOT)[: len(b)])])
    body = (sums[hi + depth] - sums[lo]) * _power(pow(_ROOT, -1, 2**64))[lo]
    shape = ((a - lo) * 1000 + (hi - lo)).astype(np.uint64)
    return lo, hi, a, h[a], mix(body + mix(shape + np.uint64(1)))


def segments(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts, cut where they are too long for a segment, with their number and start; a window lies whole in one part."""
    most = 1 << PLACE
    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - THRESHOLD + 1), most - THRESHOLD):
            part = t[at : at + most - 1]
            if held[0] and size + len(part) >= most:
                yield held
                held, size = ([], [], []), 0
            for x, v in zip(held, (i, at, part), strict=True):
                x.append(v)
            size += len(part)
    if held[0]:
        yield held


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def anchors(docs: DataFrame) -> DataFrame:
    """Digit 1 and 2 of every stretch: (gram, body, _k1, _k2, at), at packing first window, anchor and last window.

    Of stretches that are alike within a group of texts only the first goes to
    its digit. The others are settled: their at is negative, and they go with
    their document, neighbours as one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches, 2):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for number, start, parts in segments(texts):
                n = np.array([len(x) for x in parts])
                ends = np.cumsum(n)
                lo, hi, a, gram, body = stretches(np.frombuffer(b"".join(parts), np.uint8), np.repeat(ends, n), THRESHOLD, GRAM)
                of = np.searchsorted(ends, lo, side="right")
                first = lo - (ends - n)[of] + np.array(start, dtype=np.int64)[of]
                doc = np.array(number)[of]
                at = pack_at(first, a - lo, hi - lo)
                again = later_alike(gram, body, k1[doc], k2[doc], at)
                run_at, run_doc = as_runs(first[again], (hi - lo)[again], doc[again])
                owner = mix(k1[run_doc].view(np.uint64) ^ mix(k2[run_doc].view(np.uint64)))
                doc = np.concatenate([doc[~again], run_doc])
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(np.concatenate([gram[~again], owner])), _signed(np.concatenate([body[~again], np.zeros(len(owner), np.uint64)])),
                        pa.array(k1[doc]), pa.array(k2[doc]), pa.array(np.concatenate([at[~again], -1 - run_at])),
                    ],
                    names=["gram", "body", *KEY, "at"],
                )

    return with_key(docs).select(*KEY, text_or_empty().cast("binary").alias("text")).mapInArrow(run, "gram long, body long, _k1 long, _k2 long, at long")


def later_alike(gram: np.ndarray, body: np.ndarray, k1: np.ndarray, k2: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which rows have a row before them, in order of key and place, with the same two digits."""
    order = np.lexsort((at, k2, k1, body, gram))
    g, s = gram[order], body[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))]
    out = np.zeros(len(g), dtype=bool)
    out[order] = (k1[order] != k1[head]) | (k2[order] != k2[head]) | (at[order] != at[head])
    return out


def as_runs(first: np.ndarray, last: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(at, doc): stretches in order of place, those that follow on each other as one of up to 255 windows."""
    if not len(first):
        return first, doc
    apart = np.ones(len(first), dtype=bool)
    apart[1:] = (doc[1:] != doc[:-1]) | (first[1:] != (first + last)[:-1] + 1)
    start = first[np.maximum.accumulate(np.where(apart, np.arange(len(first)), 0))]
    part = (first - start) // (255 - THRESHOLD + GRAM)
    new = apart.copy()
    new[1:] |= part[1:] != part[:-1]
    lo = np.flatnonzero(new)
    hi = np.concatenate([lo[1:], [len(first)]]) - 1
    return pack_at(first[lo], np.zeros(len(lo), np.int64), (first + last)[hi] - first[lo]), doc[lo]


def pack_at(first: np.ndarray, anchor: np.ndarray, last: np.ndarray) -> np.ndarray:
    """First window, and the anchor's and the last window's distance from it, in one long."""
    return first << 16 | anchor << 8 | last


def unpack_at(at: int) -> tuple[int, int, int]:
    """What pack_at packed."""
    return at >> 16, at >> 8 & 255, at & 255


def settle(rows: DataFrame) -> DataFrame:
    """From anchors: (_k1, _k2, at, later). later: the stretch occurs earlier. Otherwise it is the first of its
    kind in a group with others, and goes on. Stretches that are alone with their anchor, or all alike, are gone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # In hand: the group's gram, its kind, that kind's first row, and whether that row still waits for a second kind.
        gram = body = None
        first: tuple | None = None
        waits = False
        for batch in batches:
            g, s, k1, k2, at = (c.to_numpy() for c in batch.columns)
            done = at < 0
            if done.any():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (k1[done], k2[done], -1 - at[done], done[done])], names=[*KEY, "at", "later"])
                g, s, k1, k2, at = (x[~done] for x in (g, s, k1, k2, at))
            n = len(g)
            if not n:
                continue
            new_g, new_s = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
            new_g[1:] = g[1:] != g[:-1]
            new_s[1:] = new_g[1:] | (s[1:] != s[:-1])
            new_g[0] = gram is None or int(g[0]) != gram
            new_s[0] = new_g[0] or int(s[0]) != body
            head = np.maximum.accumulate(np.where(new_s, np.arange(n), -1))  # the first row of each row's kind; -1: in an earlier batch
            same = np.zeros(n, dtype=bool)
            own = head >= 0
            same[own] = (k1[own] == k1[head[own]]) & (k2[own] == k2[head[own]]) & (at[own] == at[head[own]])
            if first is not None:
                same[~own] = (k1[~own] == first[0]) & (k2[~own] == first[1]) & (at[~own] == first[2])
            later = ~new_s & ~same
            # A kind's first row goes on if its group has another kind, before or after it.
            group = np.cumsum(new_g)
            kinds = np.bincount(group, weights=new_s, minlength=int(group[-1]) + 1)
            several = kinds[group] > 1
            old = group == 0  # goes on with the group of the batch before
            several |= old & (kinds[0] > 0)
            go = new_s & several
            out = [(k1[later | go], k2[later | go], at[later | go], later[later | go])]
            if waits and kinds[0] > 0 and old.any():
                out.append((np.array([first[0]]), np.array([first[1]]), np.array([first[2]]), np.array([False])))
            last = int(head[-1])
            if last >= 0:
                first = (int(k1[last]), int(k2[last]), int(at[last]))
                waits = not bool(several[last])
            gram, body = int(g[-1]), int(s[-1])
            for x in out:
                if len(x[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in x], names=[*KEY, "at", "later"])

    ordered = rows.repartition("gram").sortWithinPartitions("gram", "body", *KEY, "at")
    return ordered.mapInArrow(run, "_k1 long, _k2 long, at long, later boolean")


def halves(docs: DataFrame, going: DataFrame) -> DataFrame:
    """Digit 3 of the stretches that go on: (half, _k1, _k2, first, offset, body): windows from `first` on,
    the first of which has its anchor `offset` bytes in; body is what they cover."""
    side = (THRESHOLD - GRAM) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k1, k2, text, ats in zip(*(batch.column(i) for i in range(4)), strict=True):
                b = unpacked(text)
                k1, k2 = k1.as_py(), k2.as_py()
                for at in ats.as_py():
                    lo, a, last = unpack_at(at)
                    cut_ = max(0, a - side)  # windows from here on have the anchor at most `side` bytes in
                    if cut_ <= last:
                        half = xxhash.xxh64_intdigest(b[lo + a : lo + a + GRAM + side], 1)
                        out.append((half - 2**63, k1, k2, lo + cut_, a - cut_, b[lo + cut_ : lo + last + THRESHOLD]))
                    if cut_ > 0:
                        half = xxhash.xxh64_intdigest(b[lo + a - side : lo + a + GRAM], 2)
                        out.append((half - 2**63, k1, k2, lo, a, b[lo : lo + min(cut_ - 1, last) + THRESHOLD]))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["half", *KEY, "first", "offset", "body"]
                )

    wanted = going.where(F.size("going") > 0).select(*KEY, "going")
    return texts_of(docs, wanted).select(*KEY, "packed", "going").mapInArrow(run, "half long, _k1 long, _k2 long, first long, offset int, body binary")


def later_windows(rows: DataFrame) -> DataFrame:
    """From halves: (_k1, _k2, start) of the windows that occur earlier, each window by itself."""
    one = F.transform(
        F.sequence(F.lit(0), F.octet_length("body") - THRESHOLD),
        lambda j: F.struct(
            (F.col("first") + j).alias("start"), (F.col("offset") - j).alias("offset"), F.xxhash64(F.substring("body", j + 1, F.lit(THRESHOLD))).alias("h")
        ),
    )
    place = F.struct("_k1", "_k2", "start")
    return (
        rows.repartition("half")
        .withColumn("n", F.count("*").over(Window.partitionBy("half")))
        .where("n > 1")
        .select("half", *KEY, F.explode(one).alias("w"))
        .select("half", *KEY, "w.start", "w.offset", "w.h")
        .withColumn("earliest", F.min(place).over(Window.partitionBy("half", "offset", "h")))
        .where(place != F.col("earliest"))
        .select(*KEY, "start")
    )


def cover(text: bytes, runs: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """The maximal runs that the (start, end) pairs make, and what they leave of the text."""
    merged: list[list[int]] = []
    for lo, hi in sorted(runs):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    kept, at = [], 0
    for lo, hi in merged:
        kept.append(text[at:lo])
        at = hi
    return [(a, b) for a, b in merged], b"".join([*kept, text[at:]])


def repeats(docs: DataFrame) -> DataFrame:
    """(_k1, _k2, spans, starts) of documents with later windows: packed stretches that go as a whole, and single windows."""
    by_doc = settle(anchors(docs)).groupBy(*KEY).agg(
        F.collect_list(F.when(F.col("later"), F.col("at"))).alias("spans"), F.collect_list(F.when(~F.col("later"), F.col("at"))).alias("going")
    )
    settled = cut(by_doc)
    single = later_windows(halves(docs, settled)).groupBy(*KEY).agg(F.collect_set("start").alias("starts"))
    return settled.where(F.size("spans") > 0).select(*KEY, "spans").join(single, KEY, "full_outer")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(_k1, _k2, n_bytes, n_removed, spans, kept_text, kept_sha256) of the documents that lose something.

    kept_text is binary, since a repeated string may end within a character.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k1, k2, text, spans, starts in zip(*(c for c in batch.columns), strict=True):
                b = unpacked(text)
                runs = [(x >> 16, (x >> 16) + (x & 255) + THRESHOLD) for x in spans.as_py() or []]
                runs += [(x, x + THRESHOLD) for x in starts.as_py() or []]
                gone, kept = cover(b, runs)
                row = (k1.as_py(), k2.as_py(), len(b), len(b) - len(kept), [{"start": x, "end": y} for x, y in gone], kept, hashlib.sha256(kept).hexdigest())
                out.append(row)
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.string())
                names = [*KEY, "n_bytes", "n_removed", "spans", "kept_text", "kept_sha256"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    found = cut(repeats(docs))
    texts = texts_of(docs, found).select(*KEY, "packed", "spans", "starts")
    return texts.mapInArrow(
        run, "_k1 long, _k2 long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_text binary, kept_sha256 string"
    )


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to repeated strings, and the digest of what it keeps."""
    docs = table(spark, sf_dir, "documents")
    lost = remove_repeats(docs).select(
        *KEY, F.col("n_removed").alias("lost"), F.size("spans").alias("runs"), F.col("kept_sha256").alias("left_sha256")
    )
    whole = with_key(docs).select(
        *KEY, F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
        F.sha2(F.encode(text_or_empty(), "UTF-8"), 256).alias("sha256"),
    )
    return whole.join(lost, KEY, "left").select(
        "doc_id", "n_bytes",
        F.coalesce("lost", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("runs", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("left_sha256", "sha256").alias("kept_sha256"),
    )
