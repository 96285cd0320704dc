"""Density maps in the MRC/CCP4 format, plain or gzipped."""

from __future__ import annotations

import gzip
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Numpy types by the format's mode.
MODES = {0: np.int8, 1: np.int16, 2: np.float32, 6: np.uint16}


@dataclass(frozen=True)
class Header:
    """The parts of a header that place a map in space."""

    nx: int
    ny: int
    nz: int
    mode: int
    nstart: tuple[int, int, int]
    intervals: tuple[int, int, int]
    cell: tuple[float, float, float]
    axes: tuple[int, int, int]
    origin: tuple[float, float, float]
    n_symmetry: int

    @classmethod
    def of(cls, b: bytes) -> Header:
        """From the first 1024 bytes."""
        if len(b) < 1024:
            raise ValueError("a header has 1024 bytes")
        i = lambda at, n: struct.unpack(f"<{n}i", b[at : at + 4 * n])
        f = lambda at, n: struct.unpack(f"<{n}f", b[at : at + 4 * n])
        out = cls(*i(0, 4), i(16, 3), i(28, 3), f(40, 3), i(64, 3), f(196, 3), i(92, 1)[0])
        if sorted(out.axes) != [1, 2, 3] or min(out.nx, out.ny, out.nz, *out.intervals) <= 0:
            raise ValueError("not a map's header")
        return out

    @property
    def voxel(self) -> tuple[float, ...]:
        """Voxel size XYZ."""
        return tuple(c / n for c, n in zip(self.cell, self.intervals, strict=True))


def plain(b: bytes, most: int | None = None) -> bytes:
    """A file's bytes, unzipped; `most` stops after so many."""
    if b[:2] != b"\x1f\x8b":
        return b[:most]
    return gzip.decompress(b) if most is None else zlib.decompressobj(31).decompress(b, most)


def load(b: bytes, global_origin_in_voxels: bool = True) -> tuple[np.ndarray, tuple[float, ...], tuple[float, ...]]:
    """(grid ZYX as float32, voxel XYZ, origin XYZ): any order of axes is put straight.

    The origin is the header's plus the starts along each axis, times the voxel size where it counts voxels.
    """
    raw = plain(b)
    h = Header.of(raw)
    stored = np.frombuffer(raw, MODES[h.mode], h.nx * h.ny * h.nz, 1024 + h.n_symmetry).reshape(h.nz, h.ny, h.nx)
    place = {axis: i for i, axis in enumerate(h.axes)}  # which of column, row, section an axis is
    grid = stored.transpose([2 - place[a] for a in (3, 2, 1)]).astype(np.float32)
    starts = [h.nstart[place[a]] for a in (1, 2, 3)]
    origin = [o + s for o, s in zip(h.origin, starts, strict=True)]
    return np.ascontiguousarray(grid), h.voxel, tuple(o * v for o, v in zip(origin, h.voxel, strict=True)) if global_origin_in_voxels else tuple(origin)


def dump(grid: np.ndarray, voxel: tuple[float, ...], origin: tuple[float, ...]) -> bytes:
    """A file's bytes: axes 1, 2, 3, starts 0, origin in angstrom."""
    nz, ny, nx = grid.shape
    head = bytearray(1024)
    struct.pack_into("<10i", head, 0, nx, ny, nz, 2, 0, 0, 0, nx, ny, nz)
    struct.pack_into("<6f", head, 40, nx * voxel[0], ny * voxel[1], nz * voxel[2], 90, 90, 90)
    struct.pack_into("<3i", head, 64, 1, 2, 3)
    struct.pack_into("<3f", head, 76, float(grid.min()), float(grid.max()), float(grid.mean()))
    struct.pack_into("<3f", head, 196, *origin)
    head[208:216] = b"MAP \x44\x44\x00\x00"
    struct.pack_into("<f", head, 216, float(grid.std()))
    return bytes(head) + np.ascontiguousarray(grid, "<f4").tobytes()


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file with its header, or with the error that it gave."""
    names = ["nx", "ny", "nz", "mapc", "mapr", "maps", "nxstart", "nystart", "nzstart", "origin_x", "origin_y", "origin_z", "voxel_x", "voxel_y", "voxel_z"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for file, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    h = Header.of(plain(content, 1024))
                    out.append((file, "ok", None, h.nx, h.ny, h.nz, *h.axes, *h.nstart, *h.origin, *h.voxel))
                except Exception as x:  # noqa: BLE001  it becomes the row's status
                    out.append((file, "header_failed", f"{type(x).__name__}: {x}", *[None] * 15))
            yield pd.DataFrame(out, columns=["path", "status", "error", *names])

    kinds = ", ".join(f"{n} {'double' if n[:5] in ('origi', 'voxel') else 'int'}" for n in names)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, f"path string, status string, error string, {kinds}")


def pad_even(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grid with odd axes padded by one zero plane at the low end, and the shift ZYX."""
    shift = np.array(grid.shape) % 2
    return np.pad(grid, [(int(s), 0) for s in shift]), shift


def fourier_resample(grid: np.ndarray, out: tuple[int, int, int], only_if_all: bool = True) -> np.ndarray:
    """The grid at another even shape by cropping or padding its spectrum, amplitudes as the inverse transform gives them.

    With only_if_all a grid of which some axes keep their length stays as it is.
    """
    n = np.array(grid.shape)
    m = np.array(out)
    if (n % 2).any() or (m % 2).any():
        raise ValueError("shapes must be even")
    if (n == m).all() or only_if_all and (n == m).any():
        return grid
    half, to = np.array([n[0], n[1], n[2] // 2 + 1]), np.array([m[0], m[1], m[2] // 2 + 1])
    f = np.fft.fftshift(np.fft.rfftn(grid), axes=(0, 1))
    c = np.minimum(half, to)
    lo = half[:2] // 2 - c[:2] // 2
    f = f[lo[0] : lo[0] + 2 * (c[0] // 2), lo[1] : lo[1] + 2 * (c[1] // 2), : c[2]]
    pad = [((to[i] - f.shape[i]) // 2,) * 2 for i in range(2)] + [(0, to[2] - f.shape[2])]
    return np.fft.irfftn(np.fft.ifftshift(np.pad(f, pad), axes=(0, 1)), s=out, axes=(0, 1, 2))


def resampled(maps: DataFrame, target: float) -> DataFrame:
    """(map_id, nz, ny, nx, voxel_x.., origin_x.., mode, scale, data): each map (map_id, content) at the target voxel, one file in a task at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for map_id, content in zip(frame["map_id"], frame["content"], strict=True):
                yield pd.DataFrame([_resampled_one(map_id, content, target)], columns=_NAMES)

    kinds = "map_id string, nz int, ny int, nx int, voxel_x double, voxel_y double, voxel_z double, origin_x double, origin_y double, origin_z double, mode string, scale double, data binary"
    return maps.select("map_id", "content").mapInPandas(run, kinds)


_NAMES = ["map_id", "nz", "ny", "nx", "voxel_x", "voxel_y", "voxel_z", "origin_x", "origin_y", "origin_z", "mode", "scale", "data"]


def target_shape(shape_zyx: tuple[int, ...], voxel: np.ndarray, target: float) -> np.ndarray:
    """Lengths ZYX at the target voxel."""
    n = np.array(shape_zyx)[::-1]
    h = np.ceil(n * voxel / target).astype(int)
    up, down = np.abs(n * voxel / (h + 1) - target), np.abs(n * voxel / np.maximum(h - 1, 1) - target)
    return np.where(h % 2 == 0, h, np.where(up < down, h + 1, h - 1))[::-1]


def canonical_grid(grid: np.ndarray, voxel: np.ndarray, origin: np.ndarray, target: float) -> dict:
    """A grid at the target voxel with where it lies; the origin moves by the ZYX shift times the XYZ voxel."""
    even, shift = pad_even(grid)
    out = target_shape(even.shape, voxel, target)
    same = np.array(even.shape) == out
    mode = "all_equal" if same.all() else "all_diff" if not same.any() else "mixed"
    length = np.array(even.shape)[::-1] * voxel
    actual = length / out[::-1]
    closes = np.allclose(np.array(even.shape)[::-1] * actual, length, atol=1e-5)
    made = fourier_resample(even, tuple(int(v) for v in out), only_if_all=not (mode == "mixed" and not closes))
    scale = float(np.prod(even.shape, dtype=float) / np.prod(out, dtype=float))
    return {"grid": made.astype(np.float32), "voxel": actual, "origin": origin - shift * voxel, "mode": mode, "scale": scale}


def _resampled_one(map_id: str, content: bytes, target: float) -> tuple:
    grid, voxel, origin = load(content)
    got = canonical_grid(grid, np.array(voxel), np.array(origin), target)
    return (map_id, *got["grid"].shape, *got["voxel"], *got["origin"], got["mode"], got["scale"], got["grid"].tobytes())
