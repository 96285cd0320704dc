"""Quality rules: base statistics and robust multivariate outliers, in DataFrame operations alone.

Each text gives a vector of transformed statistics. For every language and
source a minimum-covariance-determinant estimate is made: from several starts,
concentration steps take mean and covariance of the half nearest under the last
estimate until the determinant stops falling, and the start that ends with the
smallest determinant gives the estimate. Junk in just under half of a group
doesn't move it. Rows whose Mahalanobis distance is over a limit are rejected.

Steps don't read rows. Vectors are counted on a grid much finer than the floors
below, all rows of them, with a partial count in every task; a step joins these
counts with the estimates, finds the half by a histogram of distances (the cell
of the histogram in which the half ends counts by the share that is needed) and
sums up. What a step costs follows from the distinct vectors, not from the rows,
and a group that has a third of all rows is a row for each of its vectors.

A covariance needs rows: each group's estimate is drawn to its language's, and
that to the one of all rows, with a weight that falls smoothly with the rows of
the group; no size switches from one to another. Every direction has a floor variance, so that a statistic which is zero nearly
everywhere doesn't make each row with one symbol an outlier.

Words are compared within their row, whatever its length.

Defined results: a null or empty text has no words and fails the base rules;
null languages and sources are groups of their own; repeated rows count each and
get the same verdict; an empty table gives an empty result; other columns are
not read, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.llm.rows import KEY, key_columns, text_or_empty
from voxelforge.operators.joins import small_join
from voxelforge.session import cut, discard, stored, table

WHITE_SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Rows that the wider estimate weighs against a group's own: as many as an estimate has numbers, 4 means and 10 covariances.
OWN = 14
#: Share of rows in the half-sample; steps that are taken at most, of which each has lowered the determinant.
SHARE, STEPS = 0.5, 60
#: A determinant that falls by less than this share has stopped.
LEAST_FALL = 1e-3
#: Vectors are counted on a grid of 1/GRID; distances in histogram cells of a factor 2^(1/CELLS).
GRID, CELLS = 256, 32
#: Counted vectors, or states, in a partition.
ROWS = 50_000
#: Where steps start from: a group's medians with their median deviations, or with the correlations of signs, or of squashed values.
STARTS = ("deviations", "signs", "squashed")
#: Transformed statistics, with the standard deviation that each has at least. Where the floors rule, a statistic that
#: lies LIMIT floors off rejects alone: word length by 1.54 times, 0.18 symbols a word, 64 % of lines or 43 % of words repeated.
FEATURES = {"x0": 0.10, "x1": 0.10, "x2": 0.15, "x3": 0.10}
NAMES = list(FEATURES)
#: Places in the lower triangle of a covariance.
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def windows(hashes: str) -> Column:
    """A hash of each three words that follow on each other, from the words' hashes; no array where there are fewer than four words."""
    n = F.size(hashes) - 2
    return F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2))))


def repeated_words(words: str, windows: str) -> Column:
    """Words in three-word windows that occur twice or more in the array column.

    windows holds a 64-bit hash of each window. Where all differ, no word is
    repeated. Otherwise hashes are sorted with their places, so that equal windows
    stand side by side, and the words of neighbours with one hash are compared.
    """
    n = F.size(windows)
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def same(x: Column, y: Column) -> Column:
        equal = x["h"] == y["h"]
        for d in range(3):
            equal = equal & (F.get(words, x["i"] + d) == F.get(words, y["i"] + d))
        return F.coalesce(equal, F.lit(False))

    def places(rows: Column) -> Column:
        beside = F.zip_with(F.slice(rows, F.lit(1), n - 1), F.slice(rows, F.lit(2), n - 1), lambda x, y: F.when(same(x, y), F.array(x["i"], y["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.array_compact(beside))))

    total = F.aggregate(
        F.get(F.transform(F.array(ordered), places), F.lit(0)),  # as a variable, so that it is sorted once
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum")),
        lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(3), p - a["last"])).alias("sum")),
        lambda a: a["sum"],
    )
    return F.when((n > 1) & (F.size(F.array_distinct(windows)) < n), total).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame, rows: bool = False) -> DataFrame:
    """Key, id, group columns, base statistics and their transforms, a light row for each document; with rows, also _row, all its columns."""
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if rows else []
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    long = lambda c, name: c.cast("long").alias(name)
    base = (
        docs.select(*key_columns(), F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", text_or_empty().alias("_text"), *whole)
        .withColumn("_words", F.filter(F.split(text, WHITE_SPACE), lambda x: x != ""))
        .withColumn("_lines", lines)
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_windows", windows("_hashes"))
        .select(
            *KEY, "doc_id",
            F.concat_ws("/", F.lit("lang"), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null"))).alias("wide"),
            F.concat_ws("/", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))).alias("narrow"),
            long(F.size("_words"), "n_words"),
            long(F.length(F.array_join("_words", "")), "word_chars"),
            long(F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, "")), "n_symbols"),
            long(F.size("_lines") - F.size(F.array_distinct("_lines")), "n_dup_lines"),
            long(repeated_words("_words", "_windows"), "n_repeat_words"),
            long(F.size("_lines"), "n_lines"),
            *[F.col("_row") for _ in whole],
        )
    )
    words = F.greatest("n_words", F.lit(1)).cast("double")
    return base.withColumns(
        {
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "x0": F.log(F.greatest("word_chars", F.lit(1)) / words),
            "x1": F.sqrt(F.col("n_symbols") / words),
            "x2": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "x3": F.col("n_repeat_words") / words,
        }
    )


def cholesky(parameters: DataFrame) -> DataFrame:
    """Adds the lower triangle l_ij of the floored covariance s_ij; each column is made of those before it in the same select."""
    made = []
    for i, j in PAIRS:
        rest = f"s{i}{j}" + (f" + {FEATURES[NAMES[i]] ** 2}D" if i == j else "") + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        made.append(f"sqrt(greatest({rest}, 1e-12D)) AS l{i}{i}" if i == j else f"({rest}) / l{j}{j} AS l{i}{j}")
    return parameters.selectExpr("*", *made)


def distance(rows: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, from x_i, m_i and l_ij, by forward substitution."""
    made = [f"({x} - m{i}" + "".join(f" - l{i}{k} * y{k}" for k in range(i)) + f") / l{i}{i} AS y{i}" for i, x in enumerate(NAMES)]
    return rows.selectExpr("*", *made, " + ".join(f"y{i} * y{i}" for i in range(len(NAMES))) + " AS d2")


CENTRES = [f"m{i}" for i in range(len(NAMES))]
SPREADS = [f"s{i}{j}" for i, j in PAIRS]
PARAMETERS = CENTRES + [f"l{i}{j}" for i, j in PAIRS]


def chi_square(share: float) -> float:
    """The quantile of chi-square with a degree for each of the four statistics."""
    lo, hi = 0.0, 100.0
    for _ in range(100):
        q = (lo + hi) / 2
        lo, hi = (q, hi) if 1 - math.exp(-q / 2) * (1 + q / 2) < share else (lo, q)
    return q


def consistency(share: float = SHARE) -> float:
    """What makes the half-sample's covariance that of a normal distribution of four dimensions."""
    q = chi_square(share)
    return share / (1 - math.exp(-q / 2) * (1 + q / 2 + (q / 2) ** 2 / 2))


#: Distance over which a row is rejected: one in a thousand rows of a normal distribution lies beyond.
LIMIT = math.sqrt(chi_square(0.999))


STATE = [*PARAMETERS, *SPREADS, "volume", "done"]


def vectors(stats: DataFrame) -> DataFrame:
    """(grp, x_i, n): the distinct vectors on the grid of each source, of each language and of all rows, counted."""
    on_grid = [(F.round(F.col(x) * GRID) / GRID).alias(x) for x in NAMES]
    own = cut(stats.where("NOT base_failed").select("wide", "narrow", *on_grid).groupBy("wide", "narrow", *NAMES).agg(F.count("*").alias("n")))
    levels = F.array(F.concat(F.lit("n/"), "narrow"), F.concat(F.lit("w/"), "wide"), F.lit("all"))
    every = own.select(F.explode(levels).alias("grp"), *NAMES, "n").groupBy("grp", *NAMES).agg(F.sum("n").alias("n"))
    return cut(every.coalesce(tasks(3 * own.count())))


def tasks(rows: int) -> int:
    """Partitions of a table of so many light rows, so that steps over a small one aren't many empty tasks and files."""
    return rows // ROWS + 1


def starts(rows: DataFrame) -> DataFrame:
    """The state of each grp and start: the medians, with a covariance from each of STARTS.

    A median's buffer holds a statistic's distinct values, which the grid bounds.
    """
    few = tasks(len(STARTS) * rows.select("grp").distinct().count())
    medians = cut(rows.groupBy("grp").agg(*[F.expr(f"percentile({x}, 0.5D, n) AS m{i}") for i, x in enumerate(NAMES)]).coalesce(few))
    off = small_join(rows, medians, "grp", NAMES).groupBy("grp", *CENTRES)
    mads = off.agg(*[F.expr(f"percentile(abs({x} - m{i}), 0.5D, n) AS d{i}") for i, x in enumerate(NAMES)])
    mads = cut(mads.selectExpr("*", *[f"sqrt(pow(1.4826D * d{i}, 2) + {FEATURES[x] ** 2}D) AS sd{i}" for i, x in enumerate(NAMES)]).coalesce(few))
    z = small_join(rows, mads, "grp", NAMES).selectExpr(
        "*", *[f"({x} - m{i}) / sd{i} AS z{i}" for i, x in enumerate(NAMES)], "greatest(" + " + ".join(f"z{i} * z{i}" for i in range(len(NAMES))) + ", 1e-18D) AS norm"
    )
    sums = z.groupBy("grp", *CENTRES, *[f"{d}{i}" for d in ("d", "sd") for i in range(len(NAMES))]).agg(
        *[F.expr(f"sum(n * z{i} * z{j} / norm) / sum(n) AS a{i}{j}") for i, j in PAIRS], *[F.expr(f"sum(n * tanh(z{i}) * tanh(z{j})) / sum(n) AS b{i}{j}") for i, j in PAIRS]
    )
    shape = {
        "deviations": lambda i, j: f"pow(1.4826D * d{i}, 2)" if i == j else "0.0D",
        "signs": lambda i, j: f"{len(NAMES)} * a{i}{j} * sd{i} * sd{j}",
        "squashed": lambda i, j: f"sd{i} * sd{j}" if i == j else f"b{i}{j} / sqrt(greatest(b{i}{i}, 1e-9D) * greatest(b{j}{j}, 1e-9D)) * sd{i} * sd{j}",
    }
    each = [f"named_struct('start', '{k}', {', '.join(f"'s{i}{j}', {shape[k](i, j)}" for i, j in PAIRS)})" for k in STARTS]
    told = sums.selectExpr("grp", *CENTRES, f"inline(array({', '.join(each)}))")
    return stored(cholesky(told).selectExpr("grp", "start", *PARAMETERS, *SPREADS, "double('infinity') AS volume", "false AS done").coalesce(few))


def concentrated(rows: DataFrame, now: DataFrame) -> DataFrame:
    """A step of every grp and start that isn't done; one whose determinant doesn't fall stays as it was and is done.

    It is written as Parquet: a checkpoint remembers what its plan implied of the columns, which would grow with each step.
    """
    key = ["grp", "start"]
    few = tasks(now.count())
    far = distance(small_join(rows, now.where("NOT done").select(*key, *PARAMETERS), "grp", NAMES))
    far = far.selectExpr(*key, "n", *CENTRES, *NAMES, f"floor(log2(d2 + 1e-12D) * {CELLS}) AS cell")
    half = f"{SHARE} * aggregate(cells, 0L, (a, x) -> a + x.c)"
    walk = f"""aggregate(cells, named_struct('before', 0L, 'last', CAST(NULL AS BIGINT), 'part', 0.0D, 'half', double({half})),
      (a, x) -> IF(a.before >= a.half, a, named_struct('before', a.before + x.c, 'last', x.cell, 'part', double(least(1.0D, (a.half - a.before) / x.c)), 'half', a.half)))"""
    cells = far.groupBy(*key, "cell").agg(F.expr("sum(n) AS c")).groupBy(*key).agg(F.expr("sort_array(collect_list(struct(cell, c))) AS cells"))
    last = cut(cells.selectExpr(*key, f"{walk} AS w").selectExpr(*key, "w.last", "w.part").coalesce(few))
    near = both_join(far, last, key).where("cell <= last").selectExpr(*key, *CENTRES, *NAMES, "n * IF(cell < last, 1.0D, part) AS k")
    off = [f"({x} - m{i})" for i, x in enumerate(NAMES)]
    sums = near.groupBy(*key, *CENTRES).agg(
        *[F.expr(f"sum(k * {x}) / sum(k) AS t{i}") for i, x in enumerate(off)], *[F.expr(f"sum(k * {off[i]} * {off[j]}) / sum(k) AS u{i}{j}") for i, j in PAIRS]
    )
    moved = cholesky(sums.selectExpr(*key, *[f"m{i} + t{i} AS m{i}" for i in range(len(NAMES))], *[f"u{i}{j} - t{i} * t{j} AS s{i}{j}" for i, j in PAIRS]))
    volume = "2 * (" + " + ".join(f"ln(l{i}{i})" for i in range(len(NAMES))) + ")"
    after = moved.selectExpr(*key, f"{volume} AS volume", "false AS done", *PARAMETERS, *SPREADS).selectExpr(*key, f"struct({', '.join(STATE)}) AS after")
    told = now.selectExpr(*key, f"struct({', '.join(STATE)}) AS before").join(after, key, "left")
    fell = f"coalesce(after.volume < before.volume - {LEAST_FALL}D, false)"
    return stored(told.selectExpr(*key, f"inline(array(IF({fell}, after, struct({', '.join('true AS done' if c == 'done' else f'before.{c}' for c in STATE)}))))").coalesce(few))


def both_join(rows: DataFrame, small: DataFrame, key: list[str]) -> DataFrame:
    """small_join by two columns."""
    one = F.struct(*key)
    return small_join(rows.withColumn("_key", one), small.select(one.alias("_key"), *[c for c in small.columns if c not in key]), "_key", NAMES).drop("_key")


def settled(rows: DataFrame) -> DataFrame:
    """The state of each grp and start of counted vectors after its steps; volume is the logarithm of its determinant."""
    now = starts(rows)
    for _ in range(STEPS):
        if now.where("NOT done").isEmpty():
            break
        before, now = now, concentrated(rows, now)
        discard(before)
    return now


def spreads(rows: DataFrame) -> DataFrame:
    """The estimate of each grp of counted vectors before the floors: m_i and s_ij of the start with the smallest determinant, and its volume."""
    now = settled(rows)
    best = now.groupBy("grp").agg(F.min_by(F.struct(*CENTRES, *SPREADS, "volume"), F.struct("volume", "start")).alias("b")).select("grp", "b.*")
    return stored(best.coalesce(tasks(now.count())).select("grp", *CENTRES, *[(F.col(s) * consistency()).alias(s) for s in SPREADS], "volume"))


def by_source(stats: DataFrame) -> DataFrame:
    """m_i and l_ij by narrow: the estimate of its rows, drawn to its language's, and that to the one of all rows.

    An estimate of n rows weighs n, what it is drawn to weighs OWN rows, whatever the size.
    """
    good = stats.where("NOT base_failed")
    found = spreads(vectors(stats))
    names = [*CENTRES, *SPREADS]
    level = lambda name: found.select(F.col("grp").alias(f"{name}_grp"), F.struct(*names).alias(name))
    sizes = good.groupBy("wide", "narrow").agg(F.count("*").alias("n_own"))
    out = (
        sizes.join(sizes.groupBy("wide").agg(F.sum("n_own").alias("n_wide")), "wide")
        .withColumns({"own_grp": F.concat(F.lit("n/"), "narrow"), "lang_grp": F.concat(F.lit("w/"), "wide"), "every_grp": F.lit("all")})
        .join(level("own"), "own_grp").join(level("lang"), "lang_grp").join(level("every"), "every_grp")
    )
    drawn = lambda n, x, to: (F.col(n) * x + OWN * to) / (F.col(n) + OWN)
    both = {c: drawn("n_own", F.col(f"own.{c}"), drawn("n_wide", F.col(f"lang.{c}"), F.col(f"every.{c}"))) for c in names}
    return cholesky(out.select("narrow", *[x.alias(c) for c, x in both.items()])).select("narrow", *PARAMETERS)


def verdicts(docs: DataFrame, limit: float = LIMIT, rows: bool = False) -> DataFrame:
    """Statistics of every row with distance (null where the base rules failed) and kept; with rows, also _row, the row itself.

    Statistics, and the rows with them, are written once; the estimates then come to them, so that no text is shuffled.
    """
    stats = stored(statistics(docs, rows))
    out = distance(small_join(stats, cut(by_source(stats)), "narrow", KEY, "left")).drop(*PARAMETERS)
    return out.withColumn("distance", F.when(~F.col("base_failed"), F.sqrt("d2"))).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that stay, repeats too, with all their columns."""
    return verdicts(docs, rows=True).where("kept").select("_row.*")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    return verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )
