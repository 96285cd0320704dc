"""Near-dedup by MinHash: one-permutation hashing, banded buckets, star-shaped candidates, exact links.

A text's distinct shingles fall into BINS bins by the top of their hash, and a
bin's smallest hash is its signature there. An empty bin takes the value of a bin
drawn by a fixed sequence of its own until a full one is met (optimal
densification). Bands of ROWS bins make a text's buckets. Two texts of similarity
0.85 fail to share a bucket twice in 10^8 cases, of 0.8 three times in 10^6.

Texts with equal shingle sets are one class, and classes go on as one. In every
bucket the candidates form a star: all members against one hub, the member that
shares most with others, so that a bucket of m gives m - 1 pairs. Links are
confirmed on the full sets. What a member and its hub don't share is kept, their
difference. Two members of one hub that aren't both linked with it may still be
linked with each other; how much they share follows exactly from their
differences, which are counted against each other in blocks where a hub's members
are of more than one component. So no component that a link between texts of a
bucket makes is lost, and a block gives no more links than join its members.

Defined results: words part at space and 09 to 0D; a null, empty or blank text has
no shingles, is linked with nothing and stays; a text with fewer words than a
shingle has one shingle; a null id comes after all others; of rows that share id
and text one decision holds, and in op2_near_dedup a row is kept whose id is that
of its component, nulls alike; rows of one id with other texts are documents of
their own; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.llm.idset import texts_of, unpacked
from voxelforge.llm.rows import KEY, id_of, keep_rows, text_or_empty, with_key
from voxelforge.llm.words import SPACE, Words, mix, shingles, text_groups
from voxelforge.operators.components import connected_components
from voxelforge.operators.joins import small_join
from voxelforge.session import cut, table

#: Bins of a signature and bins of a band.
BINS, ROWS = 96, 4
#: Differing shingles, and members, in a block of a hub's members.
BLOCK, MEMBERS = 1_000_000, 20_000
#: Sets that are held against one copy of a hub's set.
SPREAD = 1_000
#: Bytes of sets that are sent on at once; a text's set goes to each of its hubs.
SENT = 8_000_000
#: Draws after which an empty bin takes the next full one instead.
DRAWS = 1024

_DONORS = np.random.default_rng(20240609).integers(0, BINS, (DRAWS, BINS))


def signatures(text: np.ndarray, h: np.ndarray, n_texts: int) -> np.ndarray:
    """The BINS values of each text, from (text, hash) sorted; rows of texts without shingles are zero."""
    bins = ((h >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    slot = text * BINS + bins
    new = np.ones(len(slot), dtype=bool)
    new[1:] = slot[1:] != slot[:-1]
    sig, full = np.zeros(n_texts * BINS, dtype=np.uint64), np.zeros(n_texts * BINS, dtype=bool)
    sig[slot[new]], full[slot[new]] = h[new], True  # hashes are sorted, and their top is the bin: the first is the smallest
    sig, full = sig.reshape(-1, BINS), full.reshape(-1, BINS)
    rows = np.flatnonzero(full.any(axis=1) & ~full.all(axis=1))
    r, b = np.nonzero(~full[rows])
    r = rows[r]
    for draw in _DONORS:
        if not len(r):
            break
        hit = full[r, draw[b]]
        sig[r[hit], b[hit]] = sig[r[hit], draw[b[hit]]]
        r, b = r[~hit], b[~hit]
    for i, j in zip(r.tolist(), b.tolist(), strict=True):
        sig[i, j] = sig[i, (j + np.flatnonzero(np.roll(full[i], -j))[0]) % BINS]
    return sig


def bands(sig: np.ndarray) -> np.ndarray:
    """The bucket of each band of each text."""
    parts = sig.reshape(len(sig), -1, ROWS)
    out = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        out = mix(out * np.uint64(3) + parts[:, :, i] + np.uint64(1))
    return out


def sketched(docs: DataFrame, k: int) -> DataFrame:
    """(_k1, _k2, n, c1, c2, bands): size and digest of the shingle set of each row, and its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches, 2):
            w = Words(texts, SPACE)
            t, h = shingles(w, w.hashes(), k)
            n = np.bincount(t, minlength=len(texts))
            ends = np.cumsum(n)
            digests = np.array(
                [np.frombuffer(hashlib.blake2b(h[e - c : e].tobytes(), digest_size=16).digest(), np.int64) for e, c in zip(ends, n, strict=True)]
            ).reshape(-1, 2)
            of = bands(signatures(t, h, len(texts))).view(np.int64)
            some = np.where(n > 0, of.shape[1], 0)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some)]), pa.int32()), pa.array(of[n > 0].ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), lists],
                names=[*KEY, "n", "c1", "c2", "bands"],
            )

    rows = with_key(docs).select(*KEY, text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, "_k1 long, _k2 long, n long, c1 long, c2 long, bands array<long>")


def as_sets(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (a, part, member, v, h) as Arrow."""
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["a", "part", "member", "v", "h"])


def is_link(n: int | np.ndarray, m: int | np.ndarray, apart: int | np.ndarray, percent: int) -> bool | np.ndarray:
    """Whether sets of n and m shingles that differ in `apart` meet the similarity."""
    both = (n + m - apart) // 2
    return 100 * both >= percent * (n + m - both)


def against_hubs(docs: DataFrame, places: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, v, n, linked, apart): each pair of hub and member, with the shingles that only one has. places: v, _k1, _k2.

    Each text that is in a pair makes its set once, and sends it to where its
    hub's set comes too: SPREAD sets at a time meet one copy of it, read as a
    stream, so that a hub with many members is work for many tasks.
    """
    spread = cut(pairs.groupBy("a").agg(F.ceil(F.count("*") / SPREAD).cast("int").alias("spread")))
    hubs = spread.select(F.col("a").alias("v"), "a", F.explode(F.sequence(F.lit(0), F.col("spread") - 1)).alias("part"))
    many = cut(spread.where("spread > 1"))
    own = small_join(pairs, many, "a", ["v"], "left").withColumn("spread", F.coalesce("spread", F.lit(1)))
    members = own.select("v", "a", F.pmod(F.xxhash64("v"), F.col("spread")).cast("int").alias("part"))
    asked = hubs.union(members).groupBy("v").agg(F.collect_list(F.struct("a", "part")).alias("to"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in text_groups(batches, 1, read=unpacked):
            w = Words(held, SPACE)
            t, h = shingles(w, w.hashes(), k)
            ends = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=len(held)))]) * 8
            data, out, size = h.tobytes(), [], 0
            for v, to, lo, hi in zip(batch.column(0).to_pylist(), batch.column(2), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                own = data[lo:hi]
                for x in to:
                    x = x.as_py()
                    out.append((x["a"], x["part"], v != x["a"], v, own))
                    size += len(own)
                    if size >= SENT:
                        yield as_sets(out)
                        out, size = [], 0
            if out:
                yield as_sets(out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        names, kinds = ["a", "v", "n", "linked", "apart"], (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        for batch in batches:
            out, size = [], 0
            for a, part, member, v, h in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column(4), strict=True):
                x = np.frombuffer(h.as_buffer(), np.uint64)
                if not member:
                    hub, own = (a, part), x
                elif (a, part) == hub:  # else a hub's text is gone
                    apart = np.setxor1d(own, x, assume_unique=True)
                    out.append((a, v, len(x), bool(is_link(len(own), len(x), len(apart), percent)), apart.tobytes()))
                    size += 8 * len(apart)
                if size >= SENT:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    texts = texts_of(docs, cut(places.join(asked, "v")))
    made = texts.select("v", "packed", "to").mapInArrow(sets, "a long, part int, member boolean, v long, h binary")
    return made.repartition("a", "part").sortWithinPartitions("a", "part", "member").mapInArrow(compare, "a long, v long, n long, linked boolean, apart binary")


def links_within(members: list[tuple[int, int, int, bool, bytes, int]], cross: bool, percent: int) -> list[tuple[int, int]]:
    """Links that join members of a hub beyond their components: at most one fewer than there are members.

    A member is (v, block, n, linked, apart, label); members with one label are joined already. Each member that isn't
    linked with the hub is held against all others, and of its links one for each part that it joins is given, until
    all are joined. cross: only links with members of another block count.
    """
    n = np.array([m[2] for m in members], np.int64)
    block = np.array([m[1] for m in members])
    sizes = np.array([len(m[4]) // 8 for m in members], np.int64)
    tokens = np.frombuffer(b"".join(m[4] for m in members), np.uint64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(tokens, kind="stable")
    by = owner[order]
    t = tokens[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = t[1:] != t[:-1]
    number = np.zeros(len(t), np.int64)
    number[order] = np.cumsum(new) - 1
    first = np.concatenate([np.flatnonzero(new), [len(t)]])
    of = np.unique([m[5] for m in members], return_inverse=True)[1]  # the part that each is in
    out: list[tuple[int, int]] = []
    for i, m in enumerate(members):
        if m[3]:
            continue
        if (of == of[0]).all():
            break
        mine = number[ends[i] - sizes[i] : ends[i]]
        lo, size = first[mine], first[mine + 1] - first[mine]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        shared = np.bincount(by[at], minlength=len(members))
        ok = is_link(n[i], n, sizes[i] + sizes - 2 * shared, percent)
        ok[i] = False
        if cross:
            ok &= block != m[1]
        near = np.flatnonzero(ok & (of != of[i]))
        for part, nearest in zip(*np.unique(of[near], return_index=True), strict=True):
            out.append((m[0], members[near[nearest]][0]))
            of[of == part] = of[i]
    return out


def among_members(compared: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between members of a hub, where they are of more than one component.

    Two members share n + m - |difference of their differences| from the hub, over
    2. Blocks of a hub's members are held two at a time.
    """
    told = cut(compared.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v")))
    open_ = told.groupBy("a").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("m"), F.sum(F.octet_length("apart")).alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("bytes") / (8 * BLOCK), F.col("m") / MEMBERS))
    open_ = cut(open_.where("m > 1 AND x < y").select("a", blocks.cast("int").alias("blocks")))
    rows = small_join(told, open_, "a", ["v"]).withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    met = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "a", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "v", "block", "n", "linked", "apart", "label"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            got = links_within(held, key[1] != key[2], percent) if held else []
            return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for a, i, j, v, block, n, linked, apart, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, i, j) != key:
                    if key:
                        yield done()
                    key, held = (a, i, j), []
                held.append((v, block, n, linked, apart, label))
        if key:
            yield done()

    return met.repartition("a", "i", "j").sortWithinPartitions("a", "i", "j").mapInArrow(run, "a long, b long")


def labelled(links: DataFrame) -> DataFrame:
    """(v, label) of the nodes of links."""
    return connected_components(links, "a", "b").select(F.col("node").alias("v"), F.col("component").alias("label"))


def components(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(v, label) of the classes that are linked with another."""
    entries = classes.select("v", F.explode("bands").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    shared = entries.join(sizes, "bucket")
    mass = shared.groupBy("v").agg(F.sum("m").alias("mass"))
    live = cut(shared.select("bucket", "v").join(mass, "v").withColumn("draw", F.xxhash64("v")))
    hub = live.groupBy("bucket").agg(F.max(F.struct("mass", "draw", F.col("v").alias("a"))).alias("hub"))
    pairs = cut(live.join(hub, "bucket").where(F.col("v") != F.col("hub.a")).select(F.col("hub.a").alias("a"), "v").distinct())
    places = classes.select("v", F.col("place._k1").alias("_k1"), F.col("place._k2").alias("_k2"))
    compared = cut(against_hubs(docs, places, pairs, k, percent))
    labels = labelled(compared.where("linked").select("a", F.col("v").alias("b")))
    edges = labels.select(F.col("v").alias("a"), F.col("label").alias("b"))
    return labelled(edges.union(among_members(compared, labels, percent)))


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """For each row: _k1, _k2, n (size of its set), first_k1 and first_k2 (key of its component's first row), kept."""
    rows = cut(sketched(docs, k))
    place = F.struct("_k1", "_k2")
    classes = rows.where("n > 0").groupBy("c1", "c2", "n").agg(F.min(place).alias("place"), F.first("bands").alias("bands"))
    classes = cut(classes.withColumn("v", F.monotonically_increasing_id()))
    told = classes.select("v", "c1", "c2", "n", "place").join(components(docs, classes, k, percent), "v", "left").withColumn("label", F.coalesce("label", "v"))
    first = told.groupBy("label").agg(F.min("place").alias("first"))
    of_class = told.join(first, "label").select("c1", "c2", "n", "first")
    out = rows.select(*KEY, "n", "c1", "c2").join(of_class, ["c1", "c2", "n"], "left").withColumn("first", F.coalesce("first", place))
    return out.select(*KEY, "n", F.col("first._k1").alias("first_k1"), F.col("first._k2").alias("first_k2"), (place == F.col("first")).alias("kept"))


def drop_near(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with all its columns."""
    return keep_rows(docs, near_groups(docs, k, percent).where("kept").select(*KEY).distinct())


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document: three-word shingles, similarity 0.85."""
    groups = near_groups(table(spark, sf_dir, "documents"), 3, 85)
    told = groups.select(id_of("_k1", "_k2").alias("doc_id"), F.col("n").alias("n_shingles"), id_of("first_k1", "first_k2").alias("component_id"))
    return told.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
