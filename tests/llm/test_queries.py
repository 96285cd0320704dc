"""Every query function on a small table of odd rows, against brute force or its SQL."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import frame
from voxelforge.llm import licenses, near_dedup, packing
from voxelforge.llm.registry import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 2**63 - 1


@pytest.fixture(scope="module")
def table(spark, corpus, tmp_path_factory):
    """(folder, rows): the corpus with repeated ids of other texts, the largest id, special strings and notices."""
    extra = [
        (5, "another text under the id five " * 9, "en", "s0"), (LAST, corpus[4][1], "en", "s1"), (None, corpus[4][1], "en", "s1"),
        (700, "<|endoftext|>", "en", "s0"), (701, "start <|endoftext|> middle <|endoftext|><|endoftext|> end", "en", "s0"), (702, "<|endoftext|> x", "de", "s0"),
        (703, "Released under the MIT license. " + "word " * 40 + "CC-BY NC", "en", "s2"), (704, "Apache License, Version 2.0 " * 3, "en", "s2"),
        (705, "You may not use this file except in compliance with the License; you may get a copy of the License at", "en", "s2"),
    ]
    rows = [(*r, *[None] * (4 - len(r))) for r in [*corpus, *extra]]
    folder = str(tmp_path_factory.mktemp("queries"))
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def answers(spark, table, name):
    return QUERIES[name](spark, table[0]).collect()


def test_op1(spark, table):
    def brute(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        own = set()
        for label, t in licenses.TEMPLATES:
            span = 1 << (len(t.split()) - 1).bit_length()
            for at in range(0, max(1, len(words)), span):
                if len(set(t.split()) & set(words[at : at + 2 * span])) >= licenses.THRESHOLD * len(set(t.split())) - 1e-9:
                    own.add(label)
        starts = [i for i, _ in places]
        base = {x for _, x in places}
        return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)))

    got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in answers(spark, table, "op1_licenses"))
    assert got == Counter((r[0], *brute(r[1])) for r in table[1])


def test_op2(spark, table):
    sets = []
    for r in table[1]:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(LOWER))
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set()))
    above = list(range(len(sets)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same_row = table[1][i][:2] == table[1][j][:2]
            if same_row or (a and b and 100 * len(a & b) >= 85 * len(a | b)):
                above[root(i)] = root(j)
    least = defaultdict(lambda: None)
    for i, r in enumerate(table[1]):
        if r[0] is not None and (least[root(i)] is None or r[0] < least[root(i)]):
            least[root(i)] = r[0]
    want = Counter((r[0], len(sets[i]), least[root(i)], r[0] == least[root(i)]) for i, r in enumerate(table[1]))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in answers(spark, table, "op2_near_dedup")) == want


def test_a_crowd_gives_no_more_links_than_join_it():
    """Two crowds of 400 members that are all alike, and loners, none linked with the hub."""
    import numpy as np

    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64)
    crowds = draw(40), draw(40)
    apart = [np.sort(np.append(crowds[i % 2], draw(1))) for i in range(800)] + [np.sort(draw(60)) for _ in range(5)]
    members = [(i, 0, 100, False, x.tobytes(), i) for i, x in enumerate(apart)]
    links = near_dedup.links_within(members, False, 85)
    assert len(links) == 798 and all(a % 2 == b % 2 for a, b in links) and {x for link in links for x in link} == set(range(800))


def test_op3(spark, table):
    groups = defaultdict(list)
    for r in table[1]:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, i or 0))
        for n, i in enumerate(order):
            want[i, order[0], len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in answers(spark, table, "op3_exact_dedup")) == want


def test_op6(spark, table):
    rows = answers(spark, table, "op6_mixing")
    again = answers(spark, table, "op6_mixing")
    key = lambda r: str((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    size, words = defaultdict(int), lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for r in table[1]:
        size[r[3]] += words(r[1])
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight, target, free = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}, {}, set(order)
    while free:
        rest = sum(size.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * size[s]}
        target.update({s: 3.0 * size[s] for s in full} if full else share)
        free = free - full if full else set()
    by_total = {size[s]: target[s] for s in order}
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((r[0], words(r[1])) for r in table[1])
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        largest[r["source_size"]] = max(largest[r["source_size"]], r["size"])
        assert r["target"] == pytest.approx(by_total[r["source_size"]], rel=1e-9)
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[r["source_size"]] += r["taken"]
    for total, n in taken.items():
        assert abs(n - by_total[total]) <= max(0.02 * by_total[total], largest[total] / 2)  # a document is taken whole


def test_op10(spark, table):
    tokenizers = pytest.importorskip("tokenizers")
    import numpy as np

    t = tokenizers.Tokenizer.from_file(packing.default_vocabulary())
    want = Counter()
    for r in table[1]:
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 0]
        start = 0
        for length in packing.piece_lengths(len(ids), 1024):
            want[r[0], start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()), len(ids)] += 1
            start += length
    got = answers(spark, table, "op10_packing")
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    assert len({r["sequence_id"] for r in got}) == len(got) and all(r["offset"] == 0 for r in got)


def test_op8(spark, table):
    from tests.llm.test_text_operators import statistics_brute

    got = answers(spark, table, "op8_quality")
    want = Counter((r[0], *statistics_brute(r[1] or "")[:5]) for r in table[1])
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in got)


def test_op5(spark, table, tmp_path):
    """Brute force over every 100-byte string, on the rows but for the one long text."""
    rows = sorted({(r[0] is None, r[0] or 0, r[1] or ""): r for r in table[1] if len(r[1] or "") < 20000 and r[0] not in (5, None)}.values(), key=lambda r: r[0])
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    seen, want = set(), {}
    for r in rows:
        b = (r[1] or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = b"\x01" * 100
            seen.add(b[i : i + 100])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        want[r[0]] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    got = QUERIES["op5_suffixes"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want and len(got) == len(rows)
