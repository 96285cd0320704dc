"""Audits, migrations and plans of repair, as queries. Nothing here moves or deletes a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelforge.operators.joins import coverage, equal_sets
from voxelforge.operators.select import place_of


def source_class(old: DataFrame, new: DataFrame, key: list[str], name: str, features: str) -> DataFrame:
    """(key[0], class, n_changed): exact, atom_name_only where names alone differ, else blocked."""
    a = old.select(*key, F.col(name).alias("a_name"), F.col(features).alias("a_rest"), F.lit(True).alias("a"))
    b = new.select(*key, F.col(name).alias("b_name"), F.col(features).alias("b_rest"), F.lit(True).alias("b"))
    both = a.join(b, key, "full_outer")
    lost = F.col("a").isNull() | F.col("b").isNull() | ~F.col("a_rest").eqNullSafe(F.col("b_rest"))
    named = ~F.col("a_name").eqNullSafe(F.col("b_name"))
    by = both.groupBy(key[0]).agg(F.count_if(lost).alias("n_blocked"), F.count_if(named).alias("n_changed"))
    return by.select(key[0], F.when(F.col("n_blocked") > 0, "blocked").when(F.col("n_changed") > 0, "atom_name_only").otherwise("exact").alias("class"), "n_changed")


def transaction(files: DataFrame, journal: DataFrame, key: str) -> DataFrame:
    """(key, files, state, action) of a rebuild: what its files are (before, after, mixed, unknown) and what may be done.

    files: key, path, now, before, after (digests). journal: key, state.
    """
    side = F.when(F.col("now") == F.col("after"), "after").when(F.col("now") == F.col("before"), "before").otherwise("unknown")
    by = files.withColumn("side", side).groupBy(key).agg(F.collect_set("side").alias("sides"))
    one = lambda s: F.array_contains("sides", s)
    what = F.when(one("unknown"), "unknown").when(one("after") & one("before"), "mixed").when(one("after"), "after").otherwise("before")
    told = by.withColumn("files", what).join(journal.select(key, "state"), key, "left")
    f, s = F.col("files"), F.coalesce("state", F.lit(""))
    action = (
        F.when((f == "after") & (s == "committed"), "already_committed").when((f == "after") & (s == "committing"), "finish_receipt")
        .when((f == "mixed") & (s == "committing"), "restore_then_commit").when(f == "before", "commit").otherwise("refuse")
    )
    return told.select(key, "files", "state", action.alias("action"))


def frozen_targets(statuses: DataFrame, order: list[Column], parts: int, key: str = "pdb_id") -> DataFrame:
    """(key, part): success and skipped entries, dealt to parts in order."""
    rows = statuses.where(F.col("status").isin("success", "skipped")).select(key)
    return place_of(rows, order).select(key, (F.col("place") % parts).cast("int").alias("part"))


def part_manifest(targets: DataFrame, key: str = "pdb_id") -> DataFrame:
    """(part, n, sha256): what a part's list must be."""
    return targets.groupBy("part").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list(key)), "\n"), 256).alias("sha256"))


def part_faults(targets: DataFrame, results: DataFrame, key: str = "pdb_id") -> DataFrame:
    """Entries that a part lacks, has twice, or has though they are another part's."""
    return coverage(results.select("part", key), targets.select("part", key), ["part", key])


def merged_counters(shards: DataFrame, counters: list[str]) -> DataFrame:
    """Sums of the shards' counters."""
    return shards.agg(*[F.sum(c).alias(c) for c in counters], F.count("*").alias("n_shards"))


def tail_plan(universe: DataFrame, order: list[Column], tail: int, progress: int, gap: int, guard: int, skip: DataFrame, ready: DataFrame, key: str) -> DataFrame:
    """(key, place, stop_at): the last `tail` entries that aren't skipped and are ready; raises if progress is within `gap` of them."""
    placed = place_of(universe.select(key), order)
    n = universe.count()
    start = n - tail
    if start - progress < gap:
        raise ValueError("the tail begins too near to the progress")
    rows = placed.where(F.col("place") >= start).join(skip.select(key), key, "left_anti").join(ready.select(key), key, "left_semi")
    return rows.withColumn("stop_at", F.lit(start - guard))


def completeness(files: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """(key, n_there, state): complete, partial or absent of the wanted artifacts."""
    n = F.count_distinct(F.when(F.col("artifact").isin(wanted), F.col("artifact")))
    by = files.groupBy(key).agg(n.alias("n_there"))
    return by.withColumn("state", F.when(F.col("n_there") == len(wanted), "complete").when(F.col("n_there") > 0, "partial").otherwise("absent"))


def inventory(files: DataFrame, kind: Column, block: int = 512) -> DataFrame:
    """(kind, n, logical, allocated) of files."""
    return files.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sum("size").alias("logical"), (F.sum("blocks") * block).alias("allocated"))


def attempts(files: DataFrame, done: DataFrame) -> DataFrame:
    """(has_transient, has_outputs, n, allocated): attempts by whether they hold intermediates and their entry is done."""
    by = files.groupBy("run", "pdb_id", "attempt").agg(F.bool_or("transient").alias("has_transient"), F.sum(F.when(F.col("transient"), F.col("blocks")).otherwise(0)).alias("blocks"))
    told = by.join(done.select("pdb_id", F.lit(True).alias("has_outputs")), "pdb_id", "left").withColumn("has_outputs", F.coalesce("has_outputs", F.lit(False)))
    return told.groupBy("has_transient", "has_outputs").agg(F.count("*").alias("n"), (F.sum("blocks") * 512).alias("allocated"))


def largest(files: DataFrame, n: int = 20) -> DataFrame:
    """The files that take most room; ties by path."""
    return files.orderBy(F.desc("blocks"), "path").limit(n)


def newest(files: DataFrame, by: str, n: int = 12) -> DataFrame:
    """The newest files of each run; ties by path."""
    w = Window.partitionBy(by).orderBy(F.desc("mtime"), "path")
    return files.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n).drop("nth")


def cutoff_partition(universe: DataFrame, finished: DataFrame, running: DataFrame, cut: DataFrame, key: str = "pdb_id") -> DataFrame:
    """(key, n, code): entries that aren't in just one of three lists, or are in a list but not in the universe."""
    lists = finished.select(key).unionByName(running.select(key)).unionByName(cut.select(key))
    code = F.when(F.col("n_right") == 0, "unknown").when(F.col("n_left") == 0, "in_none").otherwise("in_several")
    return coverage(lists, universe, [key]).select(key, F.col("n_left").alias("n"), code.alias("code"))


def cutoff_exclusions(cut: DataFrame, run_id: str, authorization: str, stage: str = "stage_e") -> DataFrame:
    """Exclusion rows for entries that are cut off."""
    return cut.select(
        F.lit(1).alias("schema_version"), "pdb_id", F.lit(run_id).alias("run_id"), F.array(F.lit(stage)).alias("stages"), F.lit("long_tail_cutoff").alias("reason"),
        "detail", F.lit(authorization).alias("authorization"), F.lit("current_run_only").alias("decision_scope"),
        F.lit("exclude_from_training_and_inference").alias("downstream_policy"), F.create_map(F.lit("detail"), F.col("detail")).alias("evidence"),
    )


def unchanged(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that a step added or took away."""
    return equal_sets(before, after)


def launch_faults(manifest: DataFrame, authorizations: DataFrame, workers: DataFrame) -> DataFrame:
    """(worker, code): a worker must match one authorisation of the manifest, made before it was sealed."""
    told = workers.join(authorizations.select("worker", "manifest_sha256", "kind"), "worker", "left").join(manifest.select(F.col("sha256").alias("manifest_sha256"), F.lit(True).alias("known")), "manifest_sha256", "left")
    by = told.groupBy("worker").agg(F.count("kind").alias("n"), F.count_if(F.col("known")).alias("n_known"))
    return by.select("worker", F.when(F.col("n") == 0, "not_authorized").when(F.col("n") > 1, "several").when(F.col("n_known") == 0, "other_manifest").alias("code")).where("code IS NOT NULL")
