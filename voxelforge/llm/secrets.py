"""Secret scans over an incremental blob ledger, in DataFrame operations alone.

Every version of a text is content-addressed: its blob is the SHA-256 of its
bytes. A blob is scanned once for each version of a rule; pairs of blob and rule
version that the ledger has are not scanned again. The findings of a blob then
go to all paths (here documents) that hold it.

Positions come from the text itself: what a pattern leaves between its matches
and the matches, taken in turn, add up to the starts.

Defined results: a null text is the empty blob; repeated rows get a row each; a
text of any length is scanned whole; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelforge.llm.rows import text_or_empty
from voxelforge.operators.joins import small_join
from voxelforge.session import cut, table


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Of the group's match at least `least` characters are asked for."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1

    @property
    def id(self) -> str:
        """The rule with its version, as the ledger knows it."""
        return f"{self.kind}@{self.version}"


def either_case(word: str) -> str:
    """A pattern of the word in either case, ASCII letters only."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: The base kinds first, then well-known public key formats.
BASE = [
    Rule("assign", rf"({NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
]
RULES = [
    *BASE,
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
]


def scanned(rule: Rule) -> str:
    """The pattern that is run. A rule that is one greedy run of a class can ask for its length at once.

    The run may begin with a word of the class's own characters: a later start
    then lies in the same run and gives less.
    """
    parts = re.fullmatch(r"([A-Za-z0-9_]*)(\[[A-Za-z0-9_-]+\])\+", rule.pattern)
    if rule.group or not parts or not re.fullmatch(f"{parts[2]}*", parts[1]):
        return rule.pattern
    return f"{parts[1]}{parts[2]}{{{max(1, rule.least - len(parts[1]))},}}"


def matches(text: Column, rule: Rule, number: int) -> Column:
    """An array of (rule number, index, characters since the last match, characters, whether it counts), or null."""
    p = F.lit(scanned(rule))
    found = F.arrays_zip(
        F.split(text, scanned(rule), -1).alias("gap"),
        F.regexp_extract_all(text, p, 0).alias("all"),
        F.regexp_extract_all(text, p, F.lit(rule.group)).alias("value"),
    )
    rows = F.transform(
        found,
        lambda x, i: F.struct(
            F.lit(number).alias("rule"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["all"]).alias("n"),
            (F.length(x["value"]) >= rule.least).alias("counts"),
        ),
    )
    return F.when(text.rlike(scanned(rule)), F.filter(rows, lambda x: x["n"].isNotNull()))


def blobs(docs: DataFrame) -> DataFrame:
    """blob and text, each blob once."""
    text = text_or_empty()
    return docs.select(F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("blob"), text.alias("text")).dropDuplicates(["blob"])


def scan(unseen: DataFrame, rules: list[Rule]) -> DataFrame:
    """Findings (blob, rule, start, end) in blobs; a column seen lists the rule ids not to run on a blob."""
    seen = "seen" in unseen.columns
    parts = [matches(F.col("text"), r, k) for k, r in enumerate(rules)]
    if seen:
        parts = [F.when(~F.coalesce(F.array_contains("seen", r.id), F.lit(False)), p) for r, p in zip(rules, parts, strict=True)]
    w = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return (
        unseen.select("blob", F.array(*parts).alias("found"))
        .select("blob", F.explode("found").alias("found"))
        .select("blob", F.inline("found"))
        .withColumn("end", F.sum((F.col("gap") + F.col("n")).cast("long")).over(w))
        .where("counts")
        .select("blob", "rule", (F.col("end") - F.col("n")).alias("start"), "end")
    )


def ledger_rows(docs: DataFrame, rules: list[Rule], ledger: DataFrame | None = None) -> DataFrame:
    """The ledger after docs: (blob, rule_id, spans) with spans an array of (start, end); old pairs stay as they are."""
    todo = blobs(docs)
    if ledger is not None:
        todo = todo.join(ledger.groupBy("blob").agg(F.collect_set("rule_id").alias("seen")), "blob", "left")
        todo = todo.where(F.coalesce(F.size(F.array_intersect("seen", F.array(*[F.lit(r.id) for r in rules]))), F.lit(0)) < len(rules))
    found = scan(todo, rules).groupBy("blob", "rule").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    ids = F.array(*[F.lit(r.id) for r in rules])
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    unseen = F.array_except(ids, F.coalesce("seen", F.array().cast("array<string>"))) if ledger is not None else ids
    new = (
        todo.select("blob", F.explode(unseen).alias("rule_id"))
        .join(found.select("blob", F.get(ids, F.col("rule")).alias("rule_id"), "spans"), ["blob", "rule_id"], "left")
        .select("blob", "rule_id", F.coalesce("spans", none).alias("spans"))
    )
    return new if ledger is None else ledger.select("blob", "rule_id", "spans").unionByName(new)


def ledger_findings(ledger: DataFrame, rules: list[Rule]) -> DataFrame:
    """Findings (blob, rule, start, end) that the ledger holds of these rule versions; rule is the place in the list."""
    place = F.array_position(F.array(*[F.lit(r.id) for r in rules]), F.col("rule_id")).cast("int") - 1
    return ledger.select("blob", place.alias("rule"), F.inline("spans")).where("rule >= 0").select("blob", "rule", "start", "end")


def by_path(docs: DataFrame, findings: DataFrame) -> DataFrame:
    """For each row: doc_id and the columns that findings has for its blob, null where it has none."""
    paths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.encode(text_or_empty(), "UTF-8"), 256)).alias("blob"))
    return small_join(paths, cut(findings), "blob", ["doc_id"], "left")


def _count(rule: int) -> Column:
    return F.size(F.filter("spans", lambda x: x["rule"] == rule)).cast("long")


def digest(found: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row for each blob with findings: counts of the base kinds, the digest of their spans, all spans."""
    kind = F.get(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule"))
    spans = F.sort_array(F.collect_list(F.struct("start", "rule", F.concat_ws(":", kind, "start", "end").alias("said"))))
    base = F.filter("spans", lambda x: x["rule"] < len(BASE))
    return (
        found.groupBy("blob")
        .agg(spans.alias("spans"))
        .select(
            "blob",
            *[_count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)],
            F.sha2(F.encode(F.array_join(F.transform(base, lambda x: x["said"]), ","), "UTF-8"), 256).alias("base_sha256"),
            F.array_join(F.transform("spans", lambda x: x["said"]), ",").alias("spans"),
        )
    )


NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings of every document, from the ledger after them; it starts empty and is written with all its pairs."""
    docs = table(spark, sf_dir, "documents")
    ledger = cut(ledger_rows(docs, RULES))
    out = by_path(docs, digest(ledger_findings(ledger, RULES), RULES))
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")).alias(f"n_{r.kind}") for r in BASE],
        F.coalesce("base_sha256", F.lit(NOTHING)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def _sql() -> str:
    one = """SELECT doc_id, {k} AS k, '{kind}' AS kind, generate_subscripts(m, 1) AS i, unnest(m) AS m, unnest(v) AS v, unnest(g[:len(m)]) AS g
      FROM (SELECT doc_id, regexp_extract_all(t, p) AS m, regexp_extract_all(t, p, {group}) AS v, string_split_regex(t, p) AS g
            FROM (SELECT doc_id, coalesce(text, '') AS t, {p} AS p FROM documents) WHERE regexp_matches(t, p))"""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    least = " ".join(f"WHEN {k} THEN {r.least}" for k, r in enumerate(RULES))
    return f"""
WITH f AS (
  {" UNION ALL ".join(one.format(k=k, kind=r.kind, group=r.group, p=quoted(r.pattern)) for k, r in enumerate(RULES))}
), e AS (
  SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY i ROWS UNBOUNDED PRECEDING) AS stop FROM f
), s AS (
  SELECT doc_id, k, CAST(stop - length(m) AS BIGINT) AS start, kind || ':' || CAST(stop - length(m) AS BIGINT) || ':' || CAST(stop AS BIGINT) AS said
  FROM e WHERE length(v) >= CASE k {least} END
), a AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(said, ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(said, ',' ORDER BY start, k) AS spans
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""


OP9_SQL = _sql()
