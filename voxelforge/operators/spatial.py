"""Nearest-neighbour, radius and voxel joins through grid cells.

Points meet through cells as wide as the radius: one side's points stand in
their own cell, the other's in the 27 around it, so that a join compares only
points that can be near. Nothing is compared across entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelforge.functions.geometry import linear_index, voxel_centre, within

AXES = ["x", "y", "z"]


def _cell(width: float, prefix: str = "") -> list[Column]:
    return [F.floor(F.col(f"{prefix}{a}") / width).alias(f"c{a}") for a in AXES]


def in_cells(points: DataFrame, width: float) -> DataFrame:
    """Adds the cell of each point."""
    return points.select("*", *_cell(width))


def around_cells(points: DataFrame, width: float) -> DataFrame:
    """Each point in the 27 cells around it."""
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    out = points.select("*", *[c.alias(f"_{a}") for a, c in zip(AXES, _cell(width), strict=True)])
    for a in AXES:
        out = out.withColumn("_d", F.explode(near)).withColumn(f"c{a}", F.col(f"_{a}") + F.col("_d")).drop("_d", f"_{a}")
    return out


def radius_join(left: DataFrame, right: DataFrame, entry: str, radius: float) -> DataFrame:
    """Pairs of points of one entry at most `radius` apart, with d2. Sides need x, y, z; other columns must differ."""
    a = in_cells(left, radius).select(entry, *[F.col(c).alias(f"l_{c}") if c in AXES else F.col(c) for c in left.columns if c != entry], "cx", "cy", "cz")
    b = around_cells(right, radius).select(entry, *[F.col(c).alias(f"r_{c}") if c in AXES else F.col(c) for c in right.columns if c != entry], "cx", "cy", "cz")
    d2 = sum(((F.col(f"l_{x}").cast("double") - F.col(f"r_{x}").cast("double")) ** 2 for x in AXES[1:]), (F.col("l_x").cast("double") - F.col("r_x").cast("double")) ** 2)
    return a.join(b, [entry, "cx", "cy", "cz"]).withColumn("d2", d2).where(F.col("d2") <= radius * radius).drop("cx", "cy", "cz")


def pocket(ligand: DataFrame, receptor: DataFrame, radius: float = 6.0) -> DataFrame:
    """(pdb_id, candidate_id, atom_id): receptor atoms within the radius of any present atom of an occurrence, once each."""
    present = ligand.where("present").select("pdb_id", "candidate_id", *AXES)
    return radius_join(present, receptor.select("pdb_id", "atom_id", *AXES), "pdb_id", radius).select("pdb_id", "candidate_id", "atom_id").distinct()


def nearest(receptor: DataFrame, ligand: DataFrame, threshold: float = 4.0, tie: float = 1e-7) -> DataFrame:
    """(pdb_id, row_idx, dist, binding, instance): the nearest ligand atom of each receptor atom.

    Of ligand atoms within the tie of the least distance, the smallest
    (candidate, row) is taken. Atoms within the threshold find their partner
    through grid cells. For the others only the distance is wanted, and it is
    searched in cells that double in width until each has met one.
    """
    here = receptor.select("pdb_id", "row_idx", *AXES)
    there = ligand.where("present").select("pdb_id", F.col("candidate_id"), F.col("row_idx").alias("lig_row"), *AXES)
    out, width, left = None, threshold, here
    numbers = [abs(float(v)) for v in (*ligand.agg(*[F.max(F.abs(F.col(a))) for a in AXES]).first(), *receptor.agg(*[F.max(F.abs(F.col(a))) for a in AXES]).first()) if v is not None]
    most = 4 * max([threshold, *numbers]) + 1
    while True:
        near = radius_join(left, there, "pdb_id", width).withColumn("d", F.sqrt("d2"))
        least = near.groupBy("pdb_id", "row_idx").agg(F.min("d").alias("least"))
        best = near.join(least, ["pdb_id", "row_idx"]).where(F.col("d") <= F.col("least") + tie)
        got = best.groupBy("pdb_id", "row_idx").agg(F.min("least").alias("dist"), F.min(F.struct("candidate_id", "lig_row")).alias("of"))
        out = got if out is None else out.unionByName(got)
        if width > most:
            break
        left = left.join(got, ["pdb_id", "row_idx"], "left_anti")
        width *= 8
    bound = F.col("dist").cast("float") <= F.lit(threshold).cast("float")
    return out.select("pdb_id", "row_idx", F.col("dist").cast("float").alias("dist"), bound.alias("binding"), F.when(bound, F.col("of.candidate_id")).otherwise(-1).alias("instance"))


def shell_counts(atoms: DataFrame, width: float = 2.0, n: int = 9) -> DataFrame:
    """(pdb_id, row_idx, shells): how many other atoms lie in each shell (lo, hi], the first from 0."""
    a = atoms.select("pdb_id", "row_idx", *AXES)
    pairs = radius_join(a, a.select("pdb_id", F.col("row_idx").alias("other"), *AXES), "pdb_id", width * n).where("row_idx <> other")
    shell = F.greatest(F.ceil(F.sqrt("d2") / width), F.lit(1))
    counts = pairs.groupBy("pdb_id", "row_idx").agg(*[F.count_if(shell == i + 1).alias(f"s{i}") for i in range(n)])
    return a.join(counts, ["pdb_id", "row_idx"], "left").select("pdb_id", "row_idx", F.array(*[F.coalesce(f"s{i}", F.lit(0)) for i in range(n)]).alias("shells"))


def voxels(atoms: DataFrame, grids: DataFrame) -> DataFrame:
    """(pdb_id, candidate_id, z, y, x): voxels whose centre lies within the radius of an atom, once each.

    grids: pdb_id, nx, ny, nz, vx, vy, vz, ox, oy, oz. On every axis only the voxels that the radius reaches are made.
    """
    rows = atoms.join(grids, "pdb_id")
    for a in AXES:
        lo = F.greatest(F.floor((F.col(a) - F.col("radius") - F.col(f"o{a}")) / F.col(f"v{a}") - 0.5) - 1, F.lit(0)).cast("int")
        hi = F.least(F.ceil((F.col(a) + F.col("radius") - F.col(f"o{a}")) / F.col(f"v{a}") - 0.5) + 1, F.col(f"n{a}") - 1).cast("int")
        rows = rows.where(lo <= hi).withColumn(f"i{a}", F.explode(F.sequence(lo, hi)))
    centre = [voxel_centre(F.col(f"i{a}"), F.col(f"v{a}"), F.col(f"o{a}")).cast("double") - F.col(a).cast("double") for a in AXES]
    hit = within(*centre, F.col("radius").cast("double"))
    return rows.where(hit).select("pdb_id", "candidate_id", F.col("iz").alias("z"), F.col("iy").alias("y"), F.col("ix").alias("x")).distinct()


def mask_centroids(mask: DataFrame, grids: DataFrame) -> DataFrame:
    """(pdb_id, candidate_id, n, cx, cy, cz): the mean of the centres of an occurrence's voxels."""
    told = mask.join(grids, "pdb_id")
    means = [F.avg(voxel_centre(F.col(a), F.col(f"v{a}"), F.col(f"o{a}")).cast("double")).cast("float").alias(f"c{a}") for a in AXES]
    return told.groupBy("pdb_id", "candidate_id").agg(F.count("*").alias("n"), *means)


def mask_union(mask: DataFrame, grids: DataFrame) -> DataFrame:
    """(pdb_id, i): the places in row order of voxels that any occurrence covers."""
    return mask.join(grids, "pdb_id").select("pdb_id", linear_index(F.col("z"), F.col("y"), F.col("x"), F.col("ny"), F.col("nx")).alias("i")).distinct()


def bounds(points: DataFrame, key: list[str]) -> DataFrame:
    """The box of each key's points: lo_x to hi_z."""
    return points.groupBy(*key).agg(*[F.min(a).alias(f"lo_{a}") for a in AXES], *[F.max(a).alias(f"hi_{a}") for a in AXES])


def centroids(points: DataFrame, key: list[str]) -> DataFrame:
    """The mean of present points, taken in double and kept as float."""
    return points.where("present").groupBy(*key).agg(*[F.avg(F.col(a).cast("double")).cast("float").alias(a) for a in AXES])
