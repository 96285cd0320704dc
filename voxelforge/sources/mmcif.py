"""mmCIF text as rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKEN = re.compile(r"""'((?:[^'\n]|'(?=\S))*)'(?=\s|$)|"((?:[^"\n]|"(?=\S))*)"(?=\s|$)|(#[^\n]*)|(\S+)""")


def tokens(text: str) -> Iterator[tuple[str, bool]]:
    """(value, bare): what a file's syntax is made of; quoted values and text fields aren't bare."""
    lines, i = text.split("\n"), 0
    while i < len(lines):
        if lines[i].startswith(";"):
            block = [lines[i][1:]]
            i += 1
            while i < len(lines) and not lines[i].startswith(";"):
                block.append(lines[i])
                i += 1
            yield "\n".join(block), False
            lines[i : i + 1] = [lines[i][1:]] if i < len(lines) else []
            continue
        for m in _TOKEN.finditer(lines[i]):
            if m[1] is not None or m[2] is not None:
                yield m[1] if m[1] is not None else m[2], False
            elif m[4] is not None:
                yield m[4], True
        i += 1


def categories(text: str) -> dict[str, list[dict[str, str]]]:
    """The rows of every category of the first block, as strings; item pairs make one row."""
    out: dict[str, list[dict[str, str]]] = {}
    got, i, blocks = list(tokens(text)), 0, 0
    control = lambda t: t[1] and (t[0].startswith("_") or t[0].lower() == "loop_" or t[0].lower().startswith(("data_", "save_")))
    while i < len(got):
        value, bare = got[i]
        if bare and value.lower().startswith("data_"):
            blocks += 1
            if blocks > 1:
                break
            i += 1
        elif bare and value.lower() == "loop_":
            i += 1
            names = []
            while i < len(got) and got[i][1] and got[i][0].startswith("_"):
                names.append(got[i][0])
                i += 1
            values = []
            while i < len(got) and not control(got[i]):
                values.append(got[i][0])
                i += 1
            if names:
                category = names[0].partition(".")[0]
                keys = [n.partition(".")[2] for n in names]
                out.setdefault(category, []).extend(dict(zip(keys, values[k : k + len(keys)], strict=True)) for k in range(0, len(values), len(keys)))
        elif bare and value.startswith("_"):
            category, _, key = value.partition(".")
            rows = out.setdefault(category, [{}])
            rows[0][key] = got[i + 1][0] if i + 1 < len(got) else ""
            i += 2
        else:
            i += 1
    return out


def read_category(spark: SparkSession, path: str, category: str, columns: list[str]) -> DataFrame:
    """(path, file_pos, columns...): rows of a category of each file, all strings; a missing category gives none, a missing column nulls."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, text in zip(frame["path"], frame["value"], strict=True):
                rows = categories(text).get(category, [])
                yield pd.DataFrame([[file, i, *[r.get(c) for c in columns]] for i, r in enumerate(rows)], columns=["path", "file_pos", *columns], dtype=object)

    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return texts.mapInPandas(run, "path string, file_pos long, " + ", ".join(f"`{c}` string" for c in columns))


def model_text(atoms: DataFrame, columns: list[str], atom_only: bool = False, key: str = "pdb_id") -> DataFrame:
    """(key, value): a minimal file for each entry with its id and atom rows in their original order."""
    from voxelforge.operators.select import atom_only as only

    rows = only(atoms) if atom_only else atoms
    quoted = lambda c: F.when(F.coalesce(c, F.lit("")) == "", ".").when(c.rlike(r"""[\s'"#;]|^[_$\[]"""), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c)
    line = F.concat_ws(" ", *[quoted(F.col(c).cast("string")) for c in columns])
    head = F.concat(F.lit("data_"), F.col(key), F.lit("\n_entry.id "), F.col(key), F.lit("\nloop_\n" + "".join(f"_atom_site.{c}\n" for c in columns)))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("file_pos", line.alias("line")))), lambda r: r["line"]), "\n")
    return rows.groupBy(key).agg(body.alias("body")).select(key, F.concat(head, "body", F.lit("\n")).alias("value"))
