import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _k1 string, _row string, size string, x0 string"


def frame(spark, rows):
    """Documents (doc_id, text, lang, source) with columns whose names the operators use themselves."""
    full = [(*r, *[None] * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(*r, len(r[1] or ""), "k", "r", "s", "x") for r in full], SCHEMA)


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact and near copies, repeats within and across, blanks, nulls, ties and a long one."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base = [say(rnd.randint(60, 200)) for _ in range(30)]
    passage, line = say(60), "\n".join(say(9) for _ in range(4))
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    for i, t in enumerate(base[:12]):
        w = t.split()
        for _ in range(1 + i % 2):
            w[rnd.randrange(len(w))] = "changed"
        rows.append((100 + i, " ".join(w), "de", "s0"))
        rows.append((200 + i, t.replace(" ", "\n \t", 3), "de", None))
        rows.append((300 + i, f"{say(20)} {passage} {say(30)}", None, "s1"))
        rows.append((400 + i, f"{say(8)}\n{line}\n{say(8)}", "en", "s2"))
    rows += [(500, None), (501, ""), (502, "   \n\t "), (503, "one"), (504, "one"), (None, base[0], "en", "s0"), (None, "lonely words here", None, None)]
    rows += [(505, "ab " * 3000, "en", "s1"), (506, f"{say(30000)} {passage}", "en", "s1"), (507, "é" * 250 + " Ü" * 80, "de", "s2"), (508, "Is onhe. " * 400, "en", "s0")]
    rows += [rows[3], rows[3]]
    return rows
