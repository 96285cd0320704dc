"""Integrity constraints as queries: each gives the rows that break a rule, with a stable code; none is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelforge.functions import fixed as X
from voxelforge.functions.chemistry import is_finite
from voxelforge.functions.text import is_sha256
from voxelforge.operators.joins import coverage


def violations(rows: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """(key..., code) for each rule that a row breaks; a rule that can't be told is broken."""
    codes = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), code) for code, c in rules.items()]))
    return rows.select(*key, F.explode(codes).alias("code"))


def all_of(*parts: DataFrame) -> DataFrame:
    """Violations of several constraints together."""
    return reduce(DataFrame.unionByName, parts)


def require(found: DataFrame, most: int = 20) -> None:
    """Raises with the first violations if there are any."""
    rows = found.limit(most).collect()
    if rows:
        raise ValueError("; ".join(str(r.asDict()) for r in rows))


def schema_faults(df: DataFrame, wanted: dict[str, str]) -> list[str]:
    """Columns that are missing, not asked for, or of another type."""
    has = dict(df.dtypes)
    out = [f"missing:{c}" for c in wanted if c not in has] + [f"extra:{c}" for c in has if c not in wanted]
    return out + [f"type:{c}:{has[c]}" for c, kind in wanted.items() if c in has and has[c] != kind]


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key, F.lit("duplicate_key").alias("code"))


def occurrence_keys(rows: DataFrame) -> DataFrame:
    """Occurrences need an entry and a rank of 0 or more, once."""
    key = ["pdb_id", "candidate_id"]
    rules = {"missing_entry": F.col("pdb_id").rlike("^[a-z0-9]{4}$"), "invalid_candidate": F.col("candidate_id") >= 0}
    return all_of(violations(rows, key, rules), duplicates(rows, key))


def receptor_faults(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """Receptor atoms are finite, in class 0 to 28, with 49 finite features; bonds join atoms of the entry in order, with a code of 0 to 6."""
    finite = reduce(lambda a, b: a & b, [is_finite(F.col(c)) for c in "xyz"])
    rows = violations(
        atoms.withColumn("key", F.col("row_idx").cast("string")), ["pdb_id", "key"],
        {
            "coordinates": finite, "res_type": F.col("res_type").between(0, 28), "atom_name": F.length("atom_name") <= 4,
            "feature_length": F.size("feat") == 49, "feature_finite": F.forall("feat", lambda v: is_finite(v)),
        },
    )
    sizes = atoms.groupBy("pdb_id").agg(F.count("*").alias("n_atoms"))
    told = bonds.join(sizes, "pdb_id", "left").withColumn("key", F.concat_ws("-", "src", "dst"))
    rules = {"bond_order": F.col("src") < F.col("dst"), "bond_range": (F.col("src") >= 0) & (F.col("dst") < F.col("n_atoms")), "bond_type": F.col("bond_type").between(0, 6)}
    return all_of(rows, violations(told, ["pdb_id", "key"], rules))


def coordinate_faults(coords: DataFrame, template: DataFrame) -> DataFrame:
    """Ligand rows are those of the template; a present atom has finite coordinates, an absent one none."""
    none = F.col("x").isNull() & F.col("y").isNull() & F.col("z").isNull()
    finite = reduce(lambda a, b: a & b, [is_finite(F.col(c)) for c in "xyz"])
    key = ["pdb_id", "candidate_id", "row_idx"]
    return all_of(
        violations(coords, key, {"present": F.when(F.col("present"), finite).otherwise(none)}),
        coverage(coords, template, key).select(*key, F.lit("template_rows").alias("code")),
    )


def centroid_faults(stored: DataFrame, computed: DataFrame, key: list[str], tolerance: float = 1e-5) -> DataFrame:
    """Stored centres against computed ones."""
    both = stored.join(computed.select(*key, *[F.col(a).alias(f"c_{a}") for a in "xyz"]), key, "full_outer")
    near = reduce(lambda a, b: a & b, [F.abs(F.col(a) - F.col(f"c_{a}")) <= tolerance for a in "xyz"])
    return violations(both, key, {"centroid": near})


def label_faults(labels: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """Binding is within the threshold, background has no instance, instances are candidates."""
    known = labels.join(candidates.select("pdb_id", F.col("candidate_id").alias("instance"), F.lit(True).alias("known")), ["pdb_id", "instance"], "left")
    bound = F.col("dist") <= F.lit(threshold).cast("float")
    rules = {
        "distance": is_finite(F.col("dist")) & (F.col("dist") >= 0), "binding": F.col("binding") == bound,
        "background": F.col("binding") | (F.col("instance") == -1), "instance": ~F.col("binding") | F.coalesce("known", F.lit(False)),
    }
    return violations(known, ["pdb_id", "row_idx"], rules)


def density_faults(voxels: DataFrame, key: str = "map_id") -> DataFrame:
    """(key, code), the first of: not finite, all zero, no variance, fewer than two active planes on an axis."""
    top = voxels.groupBy(key).agg(
        F.count_if(~is_finite(F.col("value"))).alias("bad"), F.max(F.abs("value")).alias("most"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    active = voxels.join(top.select(key, "most"), key).where(F.abs("value") > 1e-6 * F.col("most"))
    planes = active.groupBy(key).agg(*[F.count_distinct(a).alias(f"n{a}") for a in "zyx"])
    told = top.join(planes, key, "left")
    few = reduce(lambda a, b: a | b, [F.coalesce(f"n{a}", F.lit(0)) < 2 for a in "zyx"])
    code = F.when(F.col("bad") > 0, "nonfinite").when(F.col("most") == 0, "all_zero").when(F.col("lo") == F.col("hi"), "zero_variance").when(few, "inactive_axis")
    return told.select(key, code.alias("code")).where("code IS NOT NULL")


HEADER = ["nx", "ny", "nz", "vx", "vy", "vz", "ox", "oy", "oz"]


def pair_faults(left: DataFrame, right: DataFrame, key: str, tolerance: float = 1e-5) -> DataFrame:
    """Two maps' headers: the same shape, voxel and origin."""
    both = left.select(key, *[F.col(c).alias(f"a_{c}") for c in HEADER]).join(right.select(key, *[F.col(c).alias(f"b_{c}") for c in HEADER]), key, "full_outer")
    near = lambda names: reduce(lambda a, b: a & b, [F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) <= tolerance for c in names])
    return violations(both, [key], {"shape": near(HEADER[:3]), "voxel": near(HEADER[3:6]), "origin": near(HEADER[6:])})


def header_faults(headers: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """Density headers: positive lengths and voxels, contour null throughout or the scaled native value, sources unchanged."""
    told = headers.join(sources.select(key, F.col("sha256").alias("now")), key, "left")
    positive = reduce(lambda a, b: a & b, [F.col(c) > 0 for c in HEADER[:6]])
    scaled = F.col("contour_canonical").eqNullSafe((F.col("contour_native").cast("double") * F.col("scale")).cast("float"))
    rules = {
        "geometry": positive, "scale": is_finite(F.col("scale")) & (F.col("scale") > 0), "contour": scaled,
        "contour_status": (F.col("contour_status") == "ok") == F.col("contour_native").isNotNull(),
        "source_digest": is_sha256(F.col("source_sha256")) & F.col("source_sha256").eqNullSafe(F.col("now")),
    }
    return violations(told, [key], rules)


def mask_faults(stored: DataFrame, rebuilt: DataFrame, grids: DataFrame) -> DataFrame:
    """Voxel masks: inside the grid, each voxel once, the same as when made again."""
    key = ["pdb_id", "candidate_id", "z", "y", "x"]
    inside = reduce(lambda a, b: a & b, [F.col(a).between(0, F.col(f"n{a}") - 1) for a in "zyx"])
    return all_of(
        violations(stored.join(grids, "pdb_id", "left"), key, {"range": inside}),
        duplicates(stored, key),
        coverage(stored.select(*key).distinct(), rebuilt.select(*key), key).select(*key, F.lit("rebuild").alias("code")),
    )


def correlation_codes(has_contour: Column) -> Column:
    """Codes of the four correlations in a row: null where they must be, otherwise in -1 to 1."""
    out = []
    for c in X.CC_FIELDS:
        v = F.col(c).cast("double")
        bad = (
            F.when(v.isNull(), F.concat(F.lit("cc_unexpected_null:"), F.lit(c)))
            .when(~is_finite(v), F.concat(F.lit("cc_nonfinite:"), F.lit(c)))
            .when((v < -1 - 1e-6) | (v > 1 + 1e-6), F.concat(F.lit("cc_out_of_range:"), F.lit(c)))
        )
        out.append(F.when(~has_contour, F.when(v.isNotNull(), F.concat(F.lit("cc_expected_null:"), F.lit(c)))).otherwise(bad) if c.startswith("cc_contour") else bad)
    return F.array_compact(F.array(*out))


def quality_faults(rows: DataFrame, computed: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Quality rows against recomputed aggregates: values, counts, status, and nulls just where a pocket is empty."""
    key = ["pdb_id", "candidate_id"]
    values = ["q_score", "q_score_median", "q_score_min", "pocket_q_score", "pocket_q_score_median", "pocket_q_score_min"]
    both = rows.join(computed.select(*key, *[F.col(c).alias(f"c_{c}") for c in values], F.col("pocket_n_atoms").alias("c_n")), key, "full_outer")
    near = {c: F.when(F.col(c).isNull() | F.col(f"c_{c}").isNull(), F.col(c).isNull() & F.col(f"c_{c}").isNull()).otherwise(F.abs(F.col(c) - F.col(f"c_{c}")) <= tolerance) for c in values}
    rules = near | {
        "counts": F.col("pocket_n_atoms") == F.col("c_n"),
        "empty_pocket": (F.col("pocket_n_atoms") == 0) == F.col("pocket_q_score").isNull(),
        "pocket_status": F.col("pocket_status") == F.when(F.col("pocket_n_atoms") > 0, "ok").otherwise("no_receptor_atoms_within_radius"),
    }
    return violations(both, key, rules)


STATES = ["success", "skipped", "known_failed", "unknown_failed"]


def ledger_faults(statuses: DataFrame, universe: DataFrame, stage: str, key: str = "pdb_id") -> DataFrame:
    """(key, code): every entry of the universe has one row, of the stage, in one of four states; nothing else has."""
    extra = coverage(statuses, universe, [key])
    code = F.when(F.col("n_left") == 0, "missing").when(F.col("n_right") == 0, "extra").otherwise("duplicate")
    rules = {"stage": F.col("stage") == stage, "state": F.col("status").isin(STATES), "key": F.length(key) > 0}
    return all_of(extra.select(key, code.alias("code")), violations(statuses, [key], rules))


def release(statuses: DataFrame, universe: DataFrame, stage: str, strict: bool = False, waived: DataFrame | None = None, key: str = "pdb_id") -> DataFrame:
    """What keeps a stage from its release: faults of the ledger, unknown failures that aren't waived, when strict also known ones."""
    unknown = statuses.where("status = 'unknown_failed'").select(key)
    unknown = (unknown if waived is None else unknown.join(waived.select(key), key, "left_anti")).withColumn("code", F.lit("unknown_failed"))
    parts = [ledger_faults(statuses, universe, stage, key), unknown]
    return all_of(*parts, statuses.where("status = 'known_failed'").select(key, F.lit("known_failed").alias("code"))) if strict else all_of(*parts)


def universe_faults(pairs: DataFrame, count: int | None = None) -> DataFrame:
    """(pdb_id, code): ids of four characters, maps with their prefix, each entry once; a wrong number as a row of its own."""
    rules = {"pdb_id": F.col("pdb_id").rlike("^[a-z0-9]{4}$"), "emdb_id": F.col("emdb_id").rlike("^EMD-[0-9]+$")}
    out = all_of(violations(pairs, ["pdb_id"], rules), duplicates(pairs, ["pdb_id"]))
    if count is None:
        return out
    n = pairs.agg(F.count("*").alias("n")).where(F.col("n") != count).select(F.lit(None).cast("string").alias("pdb_id"), F.lit("count").alias("code"))
    return out.unionByName(n)


EXCLUSION = ["schema_version", "pdb_id", "run_id", "stages", "reason", "detail", "authorization", "decision_scope", "downstream_policy", "evidence"]


def exclusion_faults(rows: DataFrame, run_id: str) -> DataFrame:
    """(pdb_id, code): ten fields, of this run, for the stages that may be excluded, with a reason and evidence."""
    text = lambda c: F.length(F.trim(F.col(c))) > 0
    rules = {
        "schema_version": F.col("schema_version") == 1, "pdb_id": F.col("pdb_id").rlike("^[a-z0-9]{4}$"), "run_id": F.col("run_id") == run_id,
        "stages": (F.size("stages") > 0) & (F.size(F.array_except("stages", F.array(F.lit("stage_e"), F.lit("stage_f")))) == 0),
        "reason": text("reason"), "detail": text("detail"), "authorization": text("authorization"),
        "decision_scope": F.col("decision_scope") == "current_run_only",
        "downstream_policy": F.col("downstream_policy") == "exclude_from_training_and_inference", "evidence": F.size("evidence") > 0,
    }
    return all_of(violations(rows, ["pdb_id"], rules), duplicates(rows, ["pdb_id"]))


def excluded(rows: DataFrame, stage: str) -> DataFrame:
    """Entries that are excluded from a stage."""
    return rows.where(F.array_contains("stages", stage))


def additive_faults(base: DataFrame, view: DataFrame, stage: str) -> DataFrame:
    """(pdb_id, code): a later view must hold the stage's base rows unchanged and add only rows of that stage alone."""
    digest = F.sha2(F.to_json(F.struct(*sorted(base.columns))), 256)
    a = excluded(base, stage).select("pdb_id", digest.alias("a"))
    b = view.select("pdb_id", digest.alias("b"), "stages")
    both = a.join(b, "pdb_id", "full_outer")
    code = F.when(F.col("b").isNull(), "base_row_missing").when(F.col("a").isNotNull() & (F.col("a") != F.col("b")), "base_row_changed").when(
        F.col("a").isNull() & ~(F.size("stages").eqNullSafe(F.lit(1)) & F.array_contains("stages", stage)), "addition_beyond_stage"
    )
    return both.select("pdb_id", code.alias("code")).where("code IS NOT NULL")


def provenance_faults(rows: DataFrame, wanted: dict[str, str], key: str = "pdb_id") -> DataFrame:
    """Rows whose provenance differs from what it must be."""
    return violations(rows, [key], {c: F.col(c).eqNullSafe(F.lit(v)) for c, v in wanted.items()})


def waiver_faults(header: DataFrame, rows: DataFrame, unknown: DataFrame, policy_excluded: int) -> DataFrame:
    """(pdb_id, code): a waiver holds the unknown failures exactly, digest by digest, and with the policy's exclusions stays within its cap."""
    from voxelforge.operators.joins import waived_exactly

    cap = header.crossJoin(rows.agg(F.count("*").alias("n"))).where(F.col("n") + policy_excluded > F.col("cap"))
    return waived_exactly(unknown, rows, "pdb_id", "status_sha256").unionByName(cap.select(F.lit(None).cast("string").alias("pdb_id"), F.lit("cap").alias("code")))


def artifact_state(inspected: DataFrame) -> DataFrame:
    """Adds state: COMPLETE, UPGRADE where only what can be derived is missing, else REBUILD."""
    base = reduce(lambda a, b: a & b, [F.col(c) for c in ("has_occurrences", "has_coords", "has_receptor_base")])
    new = reduce(lambda a, b: a & b, [F.col(c) for c in ("has_features", "has_descriptors", "has_centroids")])
    return inspected.withColumn("state", F.when(base & new, "COMPLETE").when(base, "UPGRADE").otherwise("REBUILD"))


def header_risks(headers: DataFrame, target: float) -> DataFrame:
    """Adds the canonical geometry and risk_codes: mixed axes, a length that doesn't close, an origin moved off its axis, an unread header."""
    from voxelforge.functions.geometry import canonical, to_zyx

    shape = to_zyx(F.array("nz", "ny", "nx"), F.col("mapc"), F.col("mapr"), F.col("maps"))
    told = headers.withColumn("geometry", canonical(shape, F.array("voxel_x", "voxel_y", "voxel_z"), F.array("origin_x", "origin_y", "origin_z"), target))
    codes = F.array_compact(
        F.array(
            F.when(F.col("status") != "ok", "header_read"), F.when(F.col("geometry.mode") == "mixed", "mixed_axes"),
            F.when(F.col("geometry.moved"), "origin_shift_axis_order"),
        )
    )
    return told.withColumn("risk_codes", codes)


def process_rows(rows: DataFrame, stage: str, recovery: str, exception: tuple[int, int, int, str] | None = None) -> DataFrame:
    """Adds category by script name (stage, recovery, opaque for an interpreter that reads its input) and blocked;
    one process may be excepted, by pid, parent, start and digest of its arguments."""
    runs = lambda script: F.exists("args", lambda a: F.substring_index(a, "/", -1) == script)
    opaque = F.exists("args", lambda a: a == "-") & F.get("args", F.lit(0)).rlike("python[0-9.]*$|(ba)?sh$")
    kind = F.when(runs(stage), "stage").when(runs(recovery), "recovery").when(opaque, "opaque")
    told = rows.withColumn("category", kind).withColumn("args_sha256", F.sha2(F.array_join("args", "\x00"), 256))
    free = F.lit(False)
    if exception:
        pid, ppid, ticks, digest = exception
        free = (F.col("pid") == pid) & (F.col("ppid") == ppid) & (F.col("start_ticks") == ticks) & (F.col("args_sha256") == digest)
    return told.withColumn("blocked", F.col("category").isNotNull() & ~free)


def payload_faults(occurrences: DataFrame, coords: DataFrame, template: DataFrame, atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """(part, key, code): all constraints of a parsed entry together."""
    as_rows = lambda d, part, key: d.select(F.lit(part).alias("part"), F.concat_ws("/", *key).alias("key"), "code")
    return all_of(
        as_rows(occurrence_keys(occurrences), "occurrences", ["pdb_id", "candidate_id"]),
        as_rows(coordinate_faults(coords, template), "coords", ["pdb_id", "candidate_id", "row_idx"]),
        as_rows(receptor_faults(atoms, bonds), "receptor", ["pdb_id", "key"]),
    )


def isolated(run_id: str, formal: list[str], filtered: bool) -> None:
    """A filtered run may not go under a formal run's name."""
    if filtered and run_id in formal:
        raise ValueError(f"{run_id} is a formal run")
