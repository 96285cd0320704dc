import gzip
import json

import numpy as np
import pytest

from voxelforge.operators import tools
from voxelforge.sources import files, mmcif, mrc

CIF = """data_1ABC
_entry.id 1ABC
loop_
_entity.id
_entity.type
1 polymer
2 'non-polymer' # trailing
loop_
_atom_site.id
_atom_site.label_atom_id
_atom_site.note
1 "C1'" .
2 O1 'it's'
3 N
;long
text
;
data_second
_entry.id other
"""


def test_categories():
    got = mmcif.categories(CIF)
    assert got["_entry"] == [{"id": "1ABC"}]
    assert [r["type"] for r in got["_entity"]] == ["polymer", "non-polymer"]
    assert [(r["label_atom_id"], r["note"]) for r in got["_atom_site"]] == [("C1'", "."), ("O1", "it's"), ("N", "long\ntext")]


def test_read_category(spark, tmp_path):
    (tmp_path / "a.cif").write_text(CIF)
    got = mmcif.read_category(spark, str(tmp_path), "_atom_site", ["id", "absent"]).orderBy("file_pos").collect()
    assert [(r["file_pos"], r["id"], r["absent"]) for r in got] == [(0, "1", None), (1, "2", None), (2, "3", None)]
    assert mmcif.read_category(spark, str(tmp_path), "_nothing", ["id"]).count() == 0


def test_model_text_round_trip(spark):
    rows = spark.createDataFrame([("1abc", 1, "ATOM", "C1'"), ("1abc", 0, "HETATM", "")], "pdb_id string, file_pos long, group_PDB string, label_atom_id string")
    text = mmcif.model_text(rows, ["group_PDB", "label_atom_id"]).first()["value"]
    assert mmcif.categories(text)["_atom_site"] == [{"group_PDB": "HETATM", "label_atom_id": "."}, {"group_PDB": "ATOM", "label_atom_id": "C1'"}]
    assert len(mmcif.categories(mmcif.model_text(rows, ["group_PDB"], True).first()["value"])["_atom_site"]) == 1


def test_jsonl(spark, tmp_path):
    path = str(tmp_path / "x")
    files.write_jsonl(spark.createDataFrame([(2, None), (1, "a")], "b int, a string"), path, ["b"])
    assert (next((tmp_path / "x").glob("part*")).read_text().splitlines()[0]) == '{"a":"a","b":1}'
    assert files.read_jsonl(spark, path, "a string, b int").count() == 2
    assert files.exact_fields(spark, path, ["a", "b"]).count() == 0 and files.exact_fields(spark, path, ["a", "c"]).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"a":\n')
    with pytest.raises(Exception):  # noqa: B017  a parse error of Spark's
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "a string").collect()


def test_ids(spark, tmp_path):
    (tmp_path / "ids").write_text("# c\n1AAA\n\n2bbb\n1aaa\n")
    assert sorted(r[0] for r in files.read_ids(spark, str(tmp_path / "ids")).collect()) == ["1aaa", "2bbb"]
    with pytest.raises(Exception, match="repeated id"):
        files.read_ids(spark, str(tmp_path / "ids"), strict=True).collect()
    (tmp_path / "bad").write_text("12345\n")
    with pytest.raises(Exception, match="not an id"):
        files.read_ids(spark, str(tmp_path / "bad")).collect()


def test_write_once_and_validated(spark, tmp_path):
    rows = spark.range(3)
    assert files.write_once(rows, str(tmp_path / "o")) and not files.write_once(rows, str(tmp_path / "o"))
    with pytest.raises(ValueError):
        files.write_once(spark.range(4), str(tmp_path / "o"))
    files.write_validated(rows, str(tmp_path / "v"), str(tmp_path / "s"), lambda d: d.where("id > 5"))
    with pytest.raises(ValueError):
        files.write_validated(spark.range(9), str(tmp_path / "v"), str(tmp_path / "s"), lambda d: d.where("id > 5"))
    assert spark.read.parquet(str(tmp_path / "v")).count() == 3
    assert files.write_validated(spark.range(5), str(tmp_path / "v"), str(tmp_path / "s"), lambda d: d.where("id > 5")).count() == 5
    with pytest.raises(FileNotFoundError):
        files.replace_folder(spark, str(tmp_path / "absent"), str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).count() == 5 and not list(tmp_path.glob("*.before-*"))


def test_arrays(spark, tmp_path):
    (tmp_path / "a.npz").write_bytes(files.array_bytes({"m": np.arange(6).reshape(2, 3)}, compressed=True))
    got = files.read_arrays(spark, str(tmp_path)).orderBy("i").collect()
    assert [r["value"] for r in got] == [0, 1, 2, 3, 4, 5] and got[0]["shape"] == "2,3" and got[0]["dtype"] == "int64"


def test_statuses_and_reusable(spark, tmp_path):
    (tmp_path / "part_0001_of_0003.jsonl").write_text(json.dumps({"run_id": "r", "stage": "stage_d", "pdb_id": "1aaa", "status": "success"}) + "\n")
    got = files.read_statuses(spark, str(tmp_path)).first()
    assert (got["part_id"], got["total_parts"], got["status"]) == (1, 3, "success")
    maps = tmp_path / "maps"
    maps.mkdir()
    (maps / "a").write_bytes(gzip.compress(b"x" * 50))
    (maps / "b").write_bytes(b"x" * 50)
    assert {r["path"][-1]: r["ok"] for r in files.reusable(spark, str(maps), "map").collect()} == {"a": True, "b": False}
    assert files.status_path("/r", "run", "stage_d", 1, 3).endswith("run/stage_d/part_0001_of_0003.jsonl")


def test_fetch_tries_again(spark):
    rows = spark.createDataFrame([("good",), ("bad",)], "url string")

    def get(url):
        if url == "bad":
            raise OSError("no")
        return b"x"

    got = {r["url"]: (r["status"], r["error"]) for r in files.fetch(rows, get, tries=1).collect()}
    assert got == {"good": ("success", None), "bad": ("unknown_failed", "OSError: no")}


def test_tools(spark):
    rows = spark.createDataFrame([("0",), ("3",)], "key string")
    got = {r["key"]: (r["status"], r["code"]) for r in tools.run_tool(rows, lambda k: ["sh", "-c", f"exit {k}"], 20).collect()}
    assert got == {"0": ("success", None), "3": ("unknown_failed", "nonzero_exit")}
    assert tools.run_one(["sleep", "9"], 0.2)[0] == "timeout" and tools.run_one(["/no/such"], 1)[0] == "launch_failed"


def grid():
    return np.random.default_rng(1).normal(size=(4, 6, 8)).astype(np.float32)


@pytest.mark.parametrize("axes", [(1, 2, 3), (1, 3, 2), (2, 1, 3), (2, 3, 1), (3, 1, 2), (3, 2, 1)])
def test_maps_with_any_order_of_axes(axes):
    import struct

    g = grid()
    raw = bytearray(mrc.dump(g, (1.0, 2.0, 3.0), (5.0, 6.0, 7.0)))
    stored = g.transpose([3 - a for a in reversed(axes)])  # sections, rows, columns
    struct.pack_into("<3i", raw, 0, *stored.shape[::-1])
    struct.pack_into("<3i", raw, 64, *axes)
    raw[1024:] = np.ascontiguousarray(stored).tobytes()
    for b in (bytes(raw), gzip.compress(bytes(raw))):
        got, voxel, origin = mrc.load(b, global_origin_in_voxels=False)
        assert np.array_equal(got, g) and voxel == pytest.approx((1, 2, 3)) and origin == pytest.approx((5, 6, 7))


def test_map_headers(spark, tmp_path):
    (tmp_path / "a.map").write_bytes(mrc.dump(grid(), (1.0, 1.0, 1.0), (0.0, 0.0, 0.0)))
    (tmp_path / "b.map").write_bytes(b"short")
    got = {r["path"][-5:]: r for r in mrc.read_headers(spark, str(tmp_path)).collect()}
    assert got["a.map"]["nx"] == 8 and got["b.map"]["status"] == "header_failed"


def test_fourier_resample_keeps_low_frequencies():
    z, y, x = np.meshgrid(*[np.arange(n) / n for n in (8, 8, 8)], indexing="ij")
    wave = lambda z, y, x: np.cos(2 * np.pi * x) + np.sin(2 * np.pi * (y + z))
    out = mrc.fourier_resample(wave(z, y, x), (16, 12, 10))
    z, y, x = np.meshgrid(*[np.arange(n) / n for n in (16, 12, 10)], indexing="ij")
    assert np.allclose(out * (16 * 12 * 10) / 512, wave(z, y, x), atol=1e-6)
    assert mrc.fourier_resample(np.ones((8, 8, 8)), (8, 10, 10)).shape == (8, 8, 8)


def test_canonical_grid(spark):
    got = mrc.canonical_grid(np.ones((3, 4, 5), np.float32), np.array([1.2, 1.5, 2.0]), np.array([3.0, 4.0, 5.0]), 1.0)
    assert got["grid"].shape == (8, 6, 8) and got["voxel"] == pytest.approx([0.9, 1, 1]) and got["origin"] == pytest.approx([1.8, 4, 3]) and got["scale"] == 0.25
    rows = spark.createDataFrame([("m", bytearray(mrc.dump(grid(), (2.0, 2.0, 2.0), (0.0, 0.0, 0.0))))], "map_id string, content binary")
    row = mrc.resampled(rows, 1.0).first()
    assert (row["nz"], row["ny"], row["nx"], row["mode"]) == (8, 12, 16, "all_diff") and len(row["data"]) == 8 * 12 * 16 * 4
