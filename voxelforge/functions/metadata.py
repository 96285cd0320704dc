"""Functions on the JSON metadata of entries and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE = "struct<level:string,primary:string,source:string>"


def contours(json: Column) -> Column:
    """The contours of a map's metadata as an array, whether it holds a list or one object; null if neither."""
    at = "$.map.contour_list.contour"
    raw = F.get_json_object(json, at)
    return F.when(raw.startswith("["), F.from_json(raw, f"array<{ONE}>")).when(raw.startswith("{"), F.array(F.from_json(raw, ONE)))


def recommended_contour(json: Column) -> Column:
    """(status, level, source) of the one primary contour: eight outcomes."""
    found = contours(json)
    first = F.filter(found, lambda c: F.lower(F.trim(c["primary"])).isin("true", "1", "yes"))
    level = F.trim(first[0]["level"]).try_cast("double")
    status = (
        F.when(F.get_json_object(json, "$.map").isNull(), "missing_map_section")
        .when(F.get_json_object(json, "$.map.contour_list").isNull(), "missing_contour_list")
        .when(found.isNull(), "invalid_contour_container")
        .when(F.size(first) == 0, "missing_primary_contour")
        .when(F.size(first) > 1, "ambiguous_primary_contour")
        .when(level.isNull(), "invalid_primary_level")
        .when(F.isnan(level) | (F.abs(level) == float("inf")), "nonfinite_primary_level")
        .otherwise("ok")
    )
    return F.struct(status.alias("status"), F.when(status == "ok", level).alias("level"), F.when(status == "ok", first[0]["source"]).alias("source"))


def numbers_at(json: Column, path: str) -> Column:
    """What is at a path as an array of double, be it a list, one value, text or nothing; what isn't a positive number is left out."""
    raw = F.get_json_object(json, path)
    values = F.when(raw.startswith("["), F.from_json(raw, "array<string>")).when(raw.isNotNull(), F.array(raw)).otherwise(F.array().cast("array<string>"))
    return F.filter(F.transform(values, lambda v: F.trim(v).try_cast("double")), lambda v: v.isNotNull() & ~F.isnan(v) & (v > 0) & (v < float("inf")))


def tolerant_distinct(values: Column, tolerance: float = 1e-6) -> Column:
    """Values in the order in which they come, without those within the tolerance of an earlier one."""
    none = F.array().cast("array<double>")
    return F.aggregate(values, none, lambda seen, v: F.when(F.exists(seen, lambda s: F.abs(s - v) < tolerance), seen).otherwise(F.array_append(seen, v)))


def resolution(emdb: Column, rcsb: Column) -> Column:
    """(selected, status, source, n_candidates, n_unique, rcsb_disagree) from the candidates of both archives, in order."""
    every = F.concat(emdb, rcsb)
    unique, own = F.size(tolerant_distinct(every)), F.size(tolerant_distinct(emdb))
    apart = (F.size(emdb) > 0) & F.exists(rcsb, lambda v: F.abs(v - emdb[0]) >= 1e-6)
    status = (
        F.when((F.size(emdb) == 0) & (F.size(rcsb) == 0), "missing")
        .when(F.size(emdb) == 0, "fallback_rcsb")
        .when(own > 1, "ambiguous_emdb")
        .when((F.size(every) > 1) & (unique == 1), "multi_candidate_consistent")
        .when(apart, "rcsb_disagree")
        .otherwise("single_unique")
    )
    source = F.when(F.size(emdb) > 0, "emdb").when(F.size(rcsb) > 0, "rcsb")
    return F.struct(
        F.try_element_at(every, F.lit(1)).alias("selected"), status.alias("status"), source.alias("source"),
        F.size(every).alias("n_candidates"), unique.alias("n_unique"), F.coalesce(apart, F.lit(False)).alias("rcsb_disagree"),
    )


STATUSES = ["single_unique", "multi_candidate_consistent", "ambiguous_emdb", "fallback_rcsb", "rcsb_disagree", "missing"]


def resolution_summary(rows: DataFrame, key: str = "pdb_id", examples: int = 10) -> DataFrame:
    """status, n, examples (the first keys). A row whose archives disagree under another status counts there too."""
    told = rows.select(F.col(key).alias("key"), "status", "rcsb_disagree")
    also = told.where("rcsb_disagree AND status <> 'rcsb_disagree'").withColumn("status", F.lit("rcsb_disagree"))
    every = rows.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    got = told.unionByName(also).groupBy("status").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("status").orderBy("key"))
    shown = told.unionByName(also).withColumn("nth", nth).where(F.col("nth") <= examples).groupBy("status").agg(F.array_sort(F.collect_list("key")).alias("examples"))
    return every.join(got, "status", "left").join(shown, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"), "examples")


def chosen_map(candidates: Column, pdb_id: Column, references: Column) -> Column:
    """Of several map ids the first whose references list the entry, else the first. references maps an id to entries."""
    hit = F.filter(candidates, lambda m: F.coalesce(F.array_contains(references[m], pdb_id), F.lit(False)))
    return F.coalesce(F.try_element_at(hit, F.lit(1)), F.try_element_at(candidates, F.lit(1)))
