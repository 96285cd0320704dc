"""Nearest, radius, shell and voxel joins over the vectors' first three numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.functions import geometry
from voxelforge.operators import spatial as P
from voxelforge.plans.carriers import POINTS, points
from voxelforge.plans.registry import query
from voxelforge.session import table

_D2 = "((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"


@query(f"""
WITH d AS (SELECT a.row_idx, b.candidate_id, b.row_idx AS lig, sqrt({_D2}) AS d FROM {POINTS} a, {POINTS} b WHERE a.candidate_id < 5 AND b.candidate_id >= 5),
m AS (SELECT row_idx, min(d) AS least FROM d GROUP BY 1),
n AS (SELECT d.*, least, row_number() OVER (PARTITION BY d.row_idx ORDER BY candidate_id, lig) AS i FROM d JOIN m USING (row_idx) WHERE d <= least + 1e-7)
SELECT row_idx, round(least, 4) AS dist, CAST(least AS FLOAT) <= CAST(0.8 AS FLOAT) AS binding, CASE WHEN CAST(least AS FLOAT) <= CAST(0.8 AS FLOAT) THEN candidate_id ELSE -1 END AS instance FROM n WHERE i = 1""")
def nearest_join_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = points(spark, sf_dir)
    got = P.nearest(rows.where("candidate_id < 5"), rows.where("candidate_id >= 5"), 0.8)
    return got.select("row_idx", F.round(F.col("dist").cast("double"), 4).alias("dist"), "binding", "instance")


@query(f"SELECT DISTINCT b.candidate_id, a.row_idx AS atom_id FROM {POINTS} a, {POINTS} b WHERE a.candidate_id < 5 AND b.candidate_id >= 5 AND {_D2} <= 1")
def radius_pocket_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = points(spark, sf_dir)
    receptor = rows.where("candidate_id < 5").withColumn("atom_id", F.col("row_idx"))
    return P.pocket(rows.where("candidate_id >= 5"), receptor, 1.0).select("candidate_id", "atom_id")


@query(f"""
WITH d AS (SELECT a.row_idx, greatest(ceil(sqrt({_D2}) / CAST(0.4 AS DOUBLE)), 1) AS s FROM {POINTS} a, {POINTS} b WHERE a.row_idx <> b.row_idx AND {_D2} <= CAST(3.6 AS DOUBLE) * CAST(3.6 AS DOUBLE))
SELECT p.row_idx, {", ".join(f"count(*) FILTER (s = {i + 1}) AS s{i}" for i in range(9))} FROM {POINTS} p LEFT JOIN d USING (row_idx) GROUP BY p.row_idx""")
def shell_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.shell_counts(points(spark, sf_dir), 0.4, 9).select("row_idx", *[F.get("shells", F.lit(i)).alias(f"s{i}") for i in range(9)])


def _grids(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit("1abc").alias("pdb_id"), *[F.lit(12).alias(f"n{a}") for a in "xyz"], *[F.lit(0.75).alias(f"v{a}") for a in "xyz"], *[F.lit(-4.5).alias(f"o{a}") for a in "xyz"]
    )


_MASK = f"""(WITH g AS (SELECT CAST(range AS INTEGER) AS i, CAST(range * CAST(0.75 AS DOUBLE) - CAST(4.5 AS DOUBLE) + CAST(0.375 AS DOUBLE) AS DOUBLE) AS c FROM range(12))
SELECT DISTINCT a.candidate_id, z.i AS z, y.i AS y, x.i AS x FROM {POINTS} a, g z, g y, g x
WHERE (x.c - a.x) * (x.c - a.x) + (y.c - a.y) * (y.c - a.y) + (z.c - a.z) * (z.c - a.z) <= CAST(1.1 AS DOUBLE) * CAST(1.1 AS DOUBLE) + 1e-8)"""


@query(f"SELECT candidate_id, z, y, x FROM {_MASK}")
def voxel_stencil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.voxels(points(spark, sf_dir).withColumn("radius", F.lit(1.1)), _grids(spark)).select("candidate_id", "z", "y", "x")


@query(f"""
SELECT candidate_id, count(*) AS n, {", ".join(f"round(avg({a} * CAST(0.75 AS DOUBLE) - 4.125), 3) AS c{a}" for a in "xyz")} FROM {_MASK} GROUP BY candidate_id""")
def mask_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    grids = _grids(spark)
    mask = P.voxels(points(spark, sf_dir).withColumn("radius", F.lit(1.1)), grids)
    return P.mask_centroids(mask, grids).select("candidate_id", "n", *[F.round(F.col(f"c{a}").cast("double"), 3).alias(f"c{a}") for a in "xyz"])


@query(f"SELECT DISTINCT (z * 12 + y) * 12 + x AS i FROM {_MASK}")
def mask_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    grids = _grids(spark)
    return P.mask_union(P.voxels(points(spark, sf_dir).withColumn("radius", F.lit(1.1)), grids), grids).select("i")


@query(f"""
WITH b AS (SELECT candidate_id, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz, max(z) AS hz FROM {POINTS} GROUP BY 1)
SELECT candidate_id, hx >= 2.0 - 1e-5 AND lx <= 2.9 + 1e-5 AND hy >= 0 - 1e-5 AND ly <= 0.9 + 1e-5 AND hz >= -3 - 1e-5 AND lz <= -2.1 + 1e-5 AS meets FROM b""")
def bbox_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = P.bounds(points(spark, sf_dir), ["candidate_id"])
    meets = geometry.boxes_meet([F.col(f"lo_{a}") for a in "xyz"], [F.col(f"hi_{a}") for a in "xyz"], [F.lit(2.0), F.lit(0.0), F.lit(-3.0)], [F.lit(3)] * 3, [F.lit(0.3)] * 3)
    return box.select("candidate_id", meets.alias("meets"))


@query(f"SELECT candidate_id, {', '.join(f'round(avg({a}), 3) AS {a}' for a in 'xyz')} FROM {POINTS} GROUP BY 1")
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.centroids(points(spark, sf_dir), ["candidate_id"]).select("candidate_id", *[F.round(F.col(a).cast("double"), 3).alias(a) for a in "xyz"])


@query(f"SELECT candidate_id, round(sqrt(var_pop(x) + var_pop(y) + var_pop(z)), 6) AS rg FROM {POINTS} GROUP BY 1")
def gyration_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelforge.operators.graph import gyration_radius as rg

    return rg(points(spark, sf_dir), ["candidate_id"]).select("candidate_id", F.round("rg", 6).alias("rg"))


@query("SELECT p_partkey AS key, z, y, x FROM (SELECT p_partkey, p_size % 7 AS z, p_size % 5 AS y, p_size % 11 + 2 AS x FROM part) WHERE x < 11")
def shift_no_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelforge.operators.quality import shifted_x

    grid = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), (F.col("p_size") % 7).alias("z"), (F.col("p_size") % 5).alias("y"), (F.col("p_size") % 11).alias("x"))
    return shifted_x(grid, 2, F.lit(11))
