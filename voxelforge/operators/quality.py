"""Quality scores per occurrence, their distributions, and the filter of whole maps."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelforge.functions import fixed as X
from voxelforge.functions.chemistry import is_finite
from voxelforge.operators.select import place_of


@dataclass(frozen=True)
class FilterConfig:
    """The map filter's settings: eleven, all stated."""

    schema_version: int
    cc_field: str
    cc_min: float
    resolution_max: float
    resolution_comparison: str
    ligand_q_min: float
    pocket_q_min: float
    qualified_pair_fraction_min: float
    empty_pocket: str
    keep_only_maps_that_pass: bool
    keep_all_occurrences_in_passing_map: bool

    @classmethod
    def of(cls, given: dict) -> FilterConfig:
        """The settings of a mapping that has exactly these keys, with valid values."""
        names = [f.name for f in fields(cls)]
        if sorted(given) != sorted(names):
            raise ValueError(f"missing {sorted(set(names) - set(given))}, extra {sorted(set(given) - set(names))}")
        out = cls(**given)
        fixed = {
            "schema_version": 2, "resolution_comparison": "inclusive", "empty_pocket": "fail_and_count_denominator",
            "keep_only_maps_that_pass": True, "keep_all_occurrences_in_passing_map": True,
        }
        wrong = [k for k, v in fixed.items() if getattr(out, k) != v or isinstance(getattr(out, k), bool) != isinstance(v, bool)]
        number = lambda k: isinstance(given[k], (int, float)) and not isinstance(given[k], bool) and abs(given[k]) < float("inf")
        wrong += [k for k in ("cc_min", "ligand_q_min", "pocket_q_min") if not (number(k) and -1 <= given[k] <= 1)]
        wrong += [] if number("qualified_pair_fraction_min") and 0 <= out.qualified_pair_fraction_min <= 1 else ["qualified_pair_fraction_min"]
        wrong += [] if number("resolution_max") and out.resolution_max > 0 else ["resolution_max"]
        wrong += [] if out.cc_field in X.CC_FIELDS else ["cc_field"]
        if wrong:
            raise ValueError(f"invalid: {wrong}")
        return out


def pair_reasons(q: Column, pocket_q: Column, ligand_min: float, pocket_min: float) -> Column:
    """Why an occurrence fails: its own score and its pocket's must be above the minima; an empty pocket fails."""
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(q > F.lit(float(ligand_min)), F.lit(False)), "ligand_q_not_strictly_above_min"),
            F.when(pocket_q.isNull(), "empty_pocket").when(~(pocket_q > F.lit(float(pocket_min))), "pocket_q_not_strictly_above_min"),
        )
    )


def one_value(rows: DataFrame, key: str, column: str) -> DataFrame:
    """Keys whose rows differ in a column that must have one finite value, or be null throughout."""
    return (
        rows.groupBy(key)
        .agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(column).alias("n"), F.count("*").alias("all"))
        .where("lo <> hi OR (n > 0 AND n < all) OR isnan(cast(hi AS double))")
        .select(key, F.lit(column).alias("column"))
    )


def map_diagnostics(rows: DataFrame, config: FilterConfig, key: str = "pdb_id", check: bool = True) -> DataFrame:
    """(key, n_pairs, n_pass, n_empty, fraction, cc, resolution, reasons, keep): one row for each map.

    rows: key, candidate_id, q_score, pocket_q_score, map_resolution and the chosen
    correlation. check raises where a map has more than one value of these.
    """
    cc = F.col(config.cc_field).cast("double")
    good = F.size(pair_reasons(F.col("q_score"), F.col("pocket_q_score"), config.ligand_q_min, config.pocket_q_min)) == 0
    by = rows.groupBy(key).agg(
        F.count("*").alias("n_pairs"), F.count_if(good).alias("n_pass"), F.count_if(F.col("pocket_q_score").isNull()).alias("n_empty"),
        F.min(cc).alias("cc"), F.max(cc).alias("cc_max"), F.count(cc).alias("n_cc"),
        F.min(F.col("map_resolution").cast("double")).alias("resolution"), F.max(F.col("map_resolution").cast("double")).alias("resolution_max"),
    )
    if check:
        single = (F.coalesce(F.col("cc") == F.col("cc_max"), F.lit(True))) & (F.col("resolution") == F.col("resolution_max")) & ((F.col("n_cc") == 0) | (F.col("n_cc") == F.col("n_pairs")))
        by = by.where(F.when(single, True).otherwise(F.raise_error(F.concat(F.lit("not one finite value in a map: "), F.col(key).cast("string")))))
    fraction = F.col("n_pass") / F.col("n_pairs")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("cc").isNull(), "selected_cc_unavailable").when(F.col("cc") < F.lit(float(config.cc_min)), "selected_cc_below_min"),
            F.when(~(F.col("resolution") <= F.lit(float(config.resolution_max))), "resolution_above_max"),
            F.when(fraction < F.lit(float(config.qualified_pair_fraction_min)), "qualified_pair_fraction_below_min"),
        )
    )
    return by.select(key, "n_pairs", "n_pass", "n_empty", fraction.alias("fraction"), "cc", "resolution", reasons.alias("reasons")).withColumn("keep", F.size("reasons") == 0)


def keep_list(rows: DataFrame, config: FilterConfig, key: str = "pdb_id", candidate: str = "candidate_id", check: bool = True) -> DataFrame:
    """(key, candidate): all occurrences of the maps that pass."""
    passed = map_diagnostics(rows, config, key, check).where("keep").select(key)
    return rows.select(key, candidate).join(passed, key, "left_semi")


def describe(config: FilterConfig) -> dict:
    """The settings as a mapping."""
    return asdict(config)


def exact_quantiles(rows: DataFrame, column: str, by: list[str], quantiles: list[float]) -> DataFrame:
    """(by..., quantiles): linearly interpolated, exact, nulls left out.

    Rows are sorted by range over all partitions, equal ones by where they come from, and only
    the two rows around each quantile are picked, by their place; no task holds a group or all rows of a value.
    """
    values = rows.select(*by, F.col(column).cast("double").alias("_v")).where("_v IS NOT NULL").withColumn("_tie", F.monotonically_increasing_id())
    placed = place_of(values, [*[F.col(c) for c in by], F.col("_v"), F.col("_tie")], "_place")
    sizes = placed.groupBy(*by).agg(F.min("_place").alias("_start"), F.count("*").alias("_n"))
    asked = F.posexplode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("_i", "_q")
    at = sizes.select(*by, "_start", "_n", asked).withColumn("_at", F.col("_q") * (F.col("_n") - 1))
    ends = at.select(*by, "_i", "_at", F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_rank"), "_start").withColumn("_place", F.col("_start") + F.col("_rank"))
    found = ends.join(placed.select("_place", "_v"), "_place").groupBy(*by, "_i", "_at").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    one = found.withColumn("_value", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at")))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_i", "_value"))), lambda x: x["_value"])
    return one.groupBy(*by).agg(listed.alias("quantiles"))


def _with_quantiles(rows: DataFrame, column: str, by: list[str] | None, counts: list[Column], quantiles: list[float]) -> DataFrame:
    key = by or ["_all"]
    told = rows if by else rows.withColumn("_all", F.lit(0))
    out = told.groupBy(*key).agg(*counts).join(exact_quantiles(told, column, key, quantiles), key, "left")
    return out.withColumn("quantiles", F.coalesce("quantiles", F.array().cast("array<double>"))).drop("_all")


def distribution(rows: DataFrame, column: str, by: list[str] | None = None, quantiles: list[float] | None = None) -> DataFrame:
    """n_finite, n_null and an array of linearly interpolated quantiles (empty without values); a value that isn't finite raises."""
    c = F.col(column).cast("double")
    ok = F.when(c.isNull() | is_finite(c), c).otherwise(F.raise_error(F.lit(f"not finite: {column}")).cast("double"))
    told = rows.select(*(by or []), ok.alias("_v"))
    return _with_quantiles(told, "_v", by, [F.count("_v").alias("n_finite"), F.count_if(F.col("_v").isNull()).alias("n_null")], quantiles or X.QUANTILES)


def against_one(rows: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Counts below, at and above 1, seven quantiles, mean, min and max."""
    names = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    c = F.col(column).cast("double")
    counts = [
        F.count(c).alias("n"), F.count_if(c < 1).alias("n_less"), F.count_if(c == 1).alias("n_equal"), F.count_if(c > 1).alias("n_greater"),
        F.min(c).alias("min"), F.avg(c).alias("mean"), F.max(c).alias("max"),
    ]
    got = _with_quantiles(rows, column, by, counts, list(names.values()))
    return got.withColumns({n: F.get("quantiles", F.lit(i)) for i, n in enumerate(names)}).drop("quantiles")


def summary(rows: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """n, sum, median (by exact_quantiles) and max, zeros without rows."""
    if not by:  # a null counts nowhere, and gives an empty table its row of zeros
        rows = rows.select(column).unionByName(rows.sparkSession.range(1).select(F.lit(None).cast(rows.schema[column].dataType).alias(column)))
    c = F.col(column)
    zero = lambda x, n: F.coalesce(x, F.lit(0)).alias(n)
    got = _with_quantiles(rows, column, by, [F.count(c).alias("n"), zero(F.sum(c), "sum"), zero(F.max(c), "max")], [0.5])
    return got.select(*(by or []), "n", "sum", zero(F.get("quantiles", F.lit(0)), "median"), "max")


def counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of each combination of values."""
    return rows.groupBy(*columns).agg(F.count("*").alias("n"))


def score_rows(occurrences: DataFrame, scores: DataFrame, key: list[str], prefix: str) -> DataFrame:
    """Adds mean (in double), median (kept as float), min and count of scores; occurrences without any stay, with nulls and 0."""
    by = scores.groupBy(*key).agg(
        F.avg(F.col("q").cast("double")).alias(prefix), F.median("q").cast("float").alias(f"{prefix}_median"),
        F.min("q").alias(f"{prefix}_min"), F.count("q").alias(f"{prefix}_n"),
    )
    return occurrences.join(by, key, "left").withColumn(f"{prefix}_n", F.coalesce(f"{prefix}_n", F.lit(0)))


def pocket_status(n: Column) -> Column:
    """Whether a pocket has atoms."""
    return F.when(n > 0, "ok").otherwise("no_receptor_atoms_within_radius")


def map_correlations(pairs: DataFrame, key: list[str], a: str, b: str, level: str | None = None) -> DataFrame:
    """Correlations of two maps over the first's voxels that aren't zero, and over those above its contour.

    Plain: sum(ab) / sqrt(sum(aa) sum(bb)). About the mean: of the values less
    their means over the mask. Null without a contour, or where a sum is zero.
    """
    x, y = F.col(a).cast("double"), F.col(b).cast("double")

    def over(mask: Column, name: str) -> list[Column]:
        at = lambda c: F.sum(F.when(mask, c))
        n, sx, sy, sxx, syy, sxy = at(F.lit(1.0)), at(x), at(y), at(x * x), at(y * y), at(x * y)
        cov, vx, vy = sxy - sx * sy / n, sxx - sx * sx / n, syy - sy * sy / n
        return [
            F.when(sxx * syy > 0, sxy / F.sqrt(sxx * syy)).alias(name),
            F.when(vx * vy > 0, cov / F.sqrt(vx * vy)).alias(f"{name}_about_mean"),
        ]

    return pairs.groupBy(*key).agg(*over(x != 0, "cc_all"), *(over(x >= F.col(level).cast("double"), "cc_contour") if level else []))


def drop_is_enough(matched: Column, shifted: Column, least: float) -> Column:
    """Whether a shift lowers a correlation by at least so much."""
    return matched - shifted >= least


def shifted_x(voxels: DataFrame, k: int, nx: Column) -> DataFrame:
    """Voxels moved along x without coming in again at the other side."""
    return voxels.withColumn("x", F.col("x") + k).where((F.col("x") >= 0) & (F.col("x") < nx))
