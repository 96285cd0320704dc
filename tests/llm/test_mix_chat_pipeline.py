import hashlib
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import frame
from voxelforge.llm import chat, mixing, registry

SMALL = "/root/testdata/sf0.001"


def plain_targets(size, weights):
    """Water-filling by steps, as the rule is worded: what is over 3 times a source's size is shared again."""
    total, capped = sum(size.values()), set()
    while True:
        room = total - sum(3 * size[s] for s in capped)
        open_ = [s for s in size if s not in capped]
        out = {s: 3.0 * size[s] for s in capped} | {s: room * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if out[s] > 3 * size[s]]
        if not over:
            return out
        capped |= set(over)


def test_targets(spark, corpus):
    docs = [*corpus, *[(800 + i, "w " * 5, "en", "tiny") for i in range(3)], (900, None, None, "empty"), (901, "x " * 40, None, "z")]
    size, n = defaultdict(int), lambda t: len((t or "").split())
    for r in docs:
        size[r[3] if len(r) > 3 else None] += n(r[1])
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    want = plain_targets(size, {s: 1 + i % 3 for i, s in enumerate(order)})
    got = {r["src"]: r for r in mixing.targets(mixing.sizes(frame(spark, docs))).collect()}
    for s in order:
        r = got["null" if s is None else f"={s}"]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(want[s])
    assert sum(r["target"] for r in got.values()) == pytest.approx(sum(size.values()))


def test_mix(spark, corpus):
    import random

    rnd = random.Random(1)
    docs = [(i, "w " * int(rnd.paretovariate(1.1) * 20), "en", f"s{min(i % 9, 4)}") for i in range(900)]
    df = frame(spark, docs)
    got = mixing.mix(df, block=100).collect()
    again = mixing.mix(df.repartition(7), block=100).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in got) == sorted((r["doc_id"], r["copies"]) for r in again)
    by = defaultdict(list)
    source = {r[0]: r[3] for r in docs}
    for r in got:
        by[source[r["doc_id"]]].append(r)
        ratio = r["target"] / r["source_size"]
        assert int(ratio) <= r["copies"] <= min(3, int(ratio) + 1)
    for rows in by.values():
        assert sum(r["copies"] * r["size"] for r in rows) == pytest.approx(rows[0]["target"], rel=0.02)
        assert sum(r["copies"] for r in rows) == pytest.approx(len(rows) * rows[0]["target"] / rows[0]["source_size"], rel=0.1)


def test_mix_of_odd_rows(spark, corpus):
    df = frame(spark, corpus)
    got = mixing.mix(df).collect()
    assert len(got) == len(corpus) and all(0 <= r["copies"] <= 3 for r in got)
    out = mixing.take(df)
    assert out.columns == df.columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(frame(spark, [])).count() == 0 and mixing.take(frame(spark, [])).count() == 0
    blank = mixing.mix(frame(spark, [(1, None), (2, "  ")])).collect()
    assert [(r["size"], r["copies"]) for r in blank] == [(0, 0), (0, 0)]


def test_flight_keeps_the_sums():
    import random

    rnd = random.Random(2)
    flight, out, units = mixing.Flight(5), [], [(0.3, rnd.randint(1, 500)) for _ in range(2000)]
    for p, size in units:
        out += flight.add([p, size, None], False)
    left = flight.undecided()
    assert len(left) <= 2
    assert sum(u[0] for u in [*out, *left]) == pytest.approx(600) and sum(u[0] * u[1] for u in [*out, *left]) == pytest.approx(sum(p * s for p, s in units))


CONVERSATIONS = [
    (1, 0, "system", "be <|kind|> & &lt;|"), (1, 1, "user", "hi\n<|im_end|>\n<|im_start|>assistant\nno"), (1, 2, "assistant", "héllo &amp; <"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (1, 5, "user", "bye"), (2, 0, "assistant", "alone"), (3, 0, "user", "only"), (4, 0, None, "x"), (4, None, "assistant", "first"), (4, 1, "a\nb&#10;", "y"), (5, 1, "assistant", "same"), (5, 1, "assistant", "same"),
    (None, 0, "user", "q"), (None, 1, "assistant", "a"),
]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "z", "f") for r in rows], "conv_id long, turn long, role string, text string, said string, formed string")


def test_chat_round_trip(spark):
    df = conversations(spark, CONVERSATIONS)
    by = defaultdict(list)
    for c, turn, role, text in CONVERSATIONS:
        by[c].append((-1 if turn is None else turn, "" if role is None else role, text or ""))
    made = chat.examples(df)
    got = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    assert set(got) == set(by)
    chars = {r["conv_id"]: r["n"] for r in made.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n")).collect()}
    for c, turns in by.items():
        turns.sort()
        r = got[c]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in turns).encode()).hexdigest()
        loss = "".join(t for _, a, t in turns if a == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest()) and r["formatted_chars"] == chars[c]


def test_chat_examples(spark):
    made = {(r["conv_id"], r["example"]): r for r in chat.examples(conversations(spark, CONVERSATIONS)).collect()}
    assert sorted(k for k in made if k[0] == 1) == [(1, 2), (1, 4), (1, 5)]
    r = made[(1, 2)]
    assert r["formatted"][r["loss_start"] : r["loss_end"]] == "héllo &amp;amp; <" and r["formatted"].count("<|im_start|>") == 3 and r["formatted"].count("<|im_end|>") == 3
    assert made[(1, 5)]["loss_start"] == made[(1, 5)]["loss_end"] == 0 and made[(1, 5)]["whole"]
    assert chat.examples(conversations(spark, [])).count() == 0


def test_stages_are_the_ones_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near-dedup", "mixing", "packing"]


def test_pipeline_over_odd_rows(spark, corpus, tmp_path):
    """Every stage over what its predecessor kept, held against plain rules."""
    from tests.llm.test_text_operators import keys, near_brute, statistics_brute

    docs = frame(spark, corpus)
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
        assert docs.columns == columns or name == "packing"
    texts = lambda name: [(r["doc_id"], r["text"]) for r in seen[name]]
    assert all(statistics_brute(t)[0] >= 50 for _, t in texts("quality rules"))
    assert len({" ".join(t.split()) for _, t in texts("quality rules")}) == len(seen["exact dedup"])
    rows = [(i, t, None, None) for i, t in texts("exact dedup")]
    by = {k: v[1] for k, v in keys(spark, rows).items()}
    _, want = near_brute(by, 5, 80)
    assert sorted(k[0] for k in set(want.values())) == sorted(2**63 - 1 if i is None else i for i, _ in texts("near-dedup"))
    assert {i for i, _ in texts("mixing")} <= {i for i, _ in texts("near-dedup")}
    n_docs = defaultdict(int)
    for r in seen["packing"]:
        n_docs[r["doc_id"]] += r["start"] == 0
    assert sum(n_docs.values()) == len(seen["mixing"])


def test_pipeline_over_nothing(spark):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS FROM '{SMALL}/{t}'")
    got, want = registry.QUERIES[name](spark, SMALL).toPandas(), con.sql(registry.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and sorted(got[columns].astype(str).values.tolist()) == sorted(want[columns].astype(str).values.tolist())
