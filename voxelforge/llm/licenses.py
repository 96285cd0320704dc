"""License scans by an exact set-similarity join with notice templates.

A text is cut into overlapping blocks of words. A template is found in a block
that holds at least THRESHOLD of the template's distinct words. The join is
exact: words are ordered by their document frequency over the whole corpus,
rarest first; a template and a block that meet the threshold must share a word
of their prefixes (prefix filter), the block must have enough words at all
(length filter), and enough must be left behind the first shared one (positional
filter). What passes is verified on the whole sets.

Only words of templates can matter, so that the frequencies brought to the
driver, and the templates sent to all tasks, are bounded by the template table,
whatever the corpus. The scan itself shuffles nothing.

Besides, places of fixed phrases are reported.

Defined results: a null or empty text has no words and no labels; repeated rows
get a row each; texts of any length are read whole; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.llm.words import SIGNS, Words, text_groups
from voxelforge.session import table

#: Phrases whose places are reported, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Public license notices, with their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl", "it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: Share of a template's distinct words that a block must hold.
THRESHOLD = 0.9


@dataclass(frozen=True)
class Template:
    """A template in the global order: its words' ranks, rarest first, and what a block must share."""

    label: str
    ranks: tuple[int, ...]
    least: int
    span: int

    @property
    def prefix(self) -> tuple[int, ...]:
        """The words of which a block must have one."""
        return self.ranks[: len(self.ranks) - self.least + 1]


def vocabulary(templates: list[tuple[str, str]]) -> list[str]:
    """The templates' distinct words."""
    return sorted({w for _, t in templates for w in t.split()})


def hashes_of(words: list[str]) -> np.ndarray:
    """The hash of each word; words have no part in common, so that they keep their order."""
    return Words([w.encode() for w in words], SIGNS).hashes()


def frequencies(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """In how many documents each word is; a row for each word and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = hashes_of(words)
        order = np.argsort(hashed)
        total = np.zeros(len(words), dtype=np.int64)
        for _, texts in text_groups(batches, 0):
            w = Words(texts, SIGNS)
            h = w.hashes()
            at = np.minimum(np.searchsorted(hashed[order], h), len(words) - 1)
            hit = hashed[order][at] == h
            pairs = np.unique(w.of_text()[hit] * len(words) + order[at[hit]])
            total += np.bincount(pairs % len(words), minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(total, pa.int64())], names=["word", "n"])

    return {r["word"]: r["n"] for r in docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}


def prepared(templates: list[tuple[str, str]], seen: dict[str, int], threshold: float) -> tuple[list[str], list[Template]]:
    """The vocabulary in global order and the templates in it."""
    order = sorted(vocabulary(templates), key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    out = []
    for label, text in templates:
        words = text.split()
        ranks = tuple(sorted({rank[w] for w in words}))
        out.append(Template(label, ranks, math.ceil(threshold * len(ranks) - 1e-9), 1 << (len(words) - 1).bit_length()))
    return order, out


def first_shared(template: Template, block: list[int]) -> tuple[int, int] | None:
    """The places of the first word that the template's and the block's prefix share."""
    cut = len(block) - template.least + 1
    if cut < 1:  # length filter
        return None
    place = {r: j for j, r in enumerate(block[:cut])}
    return next(((i, place[r]) for i, r in enumerate(template.prefix) if r in place), None)


def containment(template: Template, block: list[int]) -> float:
    """The share of the template in the block (sorted ranks), 0 if a filter shows that it is below the threshold."""
    at = first_shared(template, block)
    if at is None or 1 + min(len(template.ranks) - at[0], len(block) - at[1]) - 1 < template.least:  # positional filter
        return 0.0
    shared = len(set(template.ranks).intersection(block))
    return shared / len(template.ranks) if shared >= template.least else 0.0


RESULT = (
    "doc_id long, n_words long, places array<struct<label:string,start:long>>, "
    "blocks array<struct<label:string,first_word:long,last_word:long,containment:double>>"
)
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
_BLOCKS = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("containment", pa.float64())]))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """For each row: doc_id, n_words, places of phrases, and the blocks that meet the threshold, with their words' range."""
    templates, phrases = templates or TEMPLATES, PHRASES if phrases is None else phrases
    order, ready = prepared(templates, frequencies(docs, vocabulary(templates)), threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = hashes_of(order)
        by_hash = np.argsort(hashed)
        by_rank: dict[int, list[Template]] = {}
        for t in ready:
            for r in t.prefix:
                by_rank.setdefault(r, []).append(t)
        triggers = np.zeros(len(order) + 1, dtype=bool)
        triggers[list(by_rank)] = True
        wanted = [(label, hashes_of(p.split()), [w.encode() for w in p.split()]) for p, label in phrases.items()]
        for batch, texts in text_groups(batches, 1):
            w = Words(texts, SIGNS)
            h, of = w.hashes(), w.of_text()
            at = np.minimum(np.searchsorted(hashed[by_hash], h), len(order) - 1)
            rank = np.where(hashed[by_hash][at] == h, by_hash[at], len(order))
            places: list[list] = [[] for _ in texts]
            blocks: list[list] = [[] for _ in texts]
            for label, wordhash, spelt in wanted:
                n = len(h) - len(wordhash) + 1
                if n > 0:
                    same = of[:n] == of[len(wordhash) - 1 :]
                    for i, x in enumerate(wordhash):
                        same &= h[i : i + n] == x
                    for p in np.flatnonzero(same).tolist():
                        if all(w.bytes[w.starts[p + i] : w.ends[p + i]].tobytes() == x for i, x in enumerate(spelt)):
                            places[of[p]].append({"label": label, "start": p - int(w.first[of[p]])})
            tried = set()
            for p in np.flatnonzero(triggers[rank]).tolist():
                d = int(of[p])
                first, end = int(w.first[d]), int(w.first[d + 1])
                for t in by_rank[int(rank[p])]:
                    k = (p - first) // t.span
                    for b in (k - 1, k):
                        if b < 0 or (d, b, t) in tried:
                            continue
                        tried.add((d, b, t))
                        lo, hi = first + b * t.span, min(first + (b + 2) * t.span, end)
                        block = np.unique(rank[lo:hi])
                        share = containment(t, block[block < len(order)].tolist())
                        if share:
                            blocks[d].append({"label": t.label, "first_word": lo - first, "last_word": hi - first - 1, "containment": share})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(w.first), pa.int64()), pa.array(places, _PLACES), pa.array(blocks, _BLOCKS)],
                names=["doc_id", "n_words", "places", "blocks"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every document."""
    starts = F.transform("places", lambda x: x["start"])
    base = F.transform("places", lambda x: x["label"])
    own = F.transform("blocks", lambda x: x["label"])
    joined = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("blocks", lambda x: x["containment"])), F.lit(0.0))).alias("score"),
    )
