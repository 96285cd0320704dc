"""Functions on grids. Shapes are arrays ZYX; voxels, origins and points are arrays XYZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def even(n: Column) -> Column:
    """n, or n + 1 where n is odd."""
    return n + n % 2


def out_length(n: Column, voxel: Column, target: Column) -> Column:
    """Length of an axis at the target voxel: rounded up, an odd one to the even neighbour nearer in voxel size, the smaller on a tie."""
    h = F.ceil(n * voxel / target)
    off = lambda k: F.abs(n * voxel / k - target)
    return F.when(h % 2 == 0, h).when(off(h + 1) < off(h - 1), h + 1).otherwise(h - 1).cast("long")


def resample_mode(same: list[Column]) -> Column:
    """all_equal, all_diff or mixed, by which axes keep their length."""
    x, y, z = same
    return F.when(x & y & z, "all_equal").when(~x & ~y & ~z, "all_diff").otherwise("mixed")


def canonical(shape: Column, voxel: Column, origin: Column, target: float) -> Column:
    """How a map goes to the target voxel.

    Odd axes are padded by one at the low end. The origin moves by the ZYX shift
    times the XYZ voxel, as the file format's users have come to rely on; moved
    tells where that differs from the shift along each axis. Fields: even (ZYX),
    out (ZYX), mode, scale (amplitude), voxel, origin, moved.
    """
    n = [even(shape[i]) for i in range(3)]
    out = [out_length(n[i], voxel[2 - i], F.lit(target)) for i in range(3)]
    scale = (n[0] * n[1] * n[2]).cast("double") / (out[0] * out[1] * out[2]).cast("double")
    shift = [shape[i] % 2 for i in range(3)]
    return F.struct(
        F.array(*n).alias("even"),
        F.array(*out).alias("out"),
        resample_mode([a == b for a, b in zip(n, out, strict=True)]).alias("mode"),
        scale.alias("scale"),
        F.array(*[n[2 - i] * voxel[i] / out[2 - i] for i in range(3)]).alias("voxel"),
        F.array(*[origin[i] - shift[i] * voxel[i] for i in range(3)]).alias("origin"),
        (shift[0] != shift[2]).alias("moved"),
    )


def to_zyx(stored: Column, mapc: Column, mapr: Column, maps: Column) -> Column:
    """A shape stored as (sections, rows, columns) in ZYX, by the axis (1 to 3) of each."""
    of = lambda axis: F.when(mapc == axis, stored[2]).when(mapr == axis, stored[1]).when(maps == axis, stored[0])
    return F.array(of(3), of(2), of(1))


def starts_xyz(nstart: Column, mapc: Column, mapr: Column, maps: Column) -> Column:
    """Starts stored by column, row and section, as XYZ."""
    of = lambda axis: F.when(mapc == axis, nstart[0]).when(mapr == axis, nstart[1]).when(maps == axis, nstart[2])
    return F.array(of(1), of(2), of(3))


def voxel_centre(i: Column, voxel: Column, origin: Column) -> Column:
    """The centre of voxel i on an axis, computed in double and stored as float."""
    return (i * voxel + origin + 0.5 * voxel).cast("float")


def within(dx: Column, dy: Column, dz: Column, radius: Column) -> Column:
    """Whether a difference in double lies in the radius, with the tolerance of the voxel masks."""
    return dx * dx + dy * dy + dz * dz <= radius * radius + 1e-8


def linear_index(z: Column, y: Column, x: Column, ny: Column, nx: Column) -> Column:
    """The place of a voxel in row order."""
    return (z * ny + y) * nx + x


def from_linear(i: Column, ny: Column, nx: Column) -> Column:
    """(z, y, x) of a place."""
    return F.struct(F.floor(i / (ny * nx)).alias("z"), (F.floor(i / nx) % ny).alias("y"), (i % nx).alias("x"))


def canonical_level(level: Column, scale: Column) -> Column:
    """A contour level at canonical amplitude, multiplied in double and stored as float."""
    return (level.cast("double") * scale).cast("float")


def boxes_meet(lo: list[Column], hi: list[Column], origin: list[Column], shape_xyz: list[Column], voxel: list[Column], tolerance: float = 1e-5) -> Column:
    """Whether a box and a map's box (from its origin, shape times voxel long) overlap on every axis."""
    out = F.lit(True)
    for a, b, o, n, v in zip(lo, hi, origin, shape_xyz, voxel, strict=True):
        out = out & (b >= o - tolerance) & (a <= o + n * v + tolerance)
    return out
