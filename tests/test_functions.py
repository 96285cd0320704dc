import hashlib

import pytest
from pyspark.sql import functions as F

from voxelforge.functions import chemistry, geometry, metadata, text


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def s(x):
    return F.lit(x).cast("string")


@pytest.mark.parametrize("raw,want", [(None, ""), ("?", ""), (".", ""), ("\"C1'\"", "C1'"), ("'x'", "x"), ("'x", "'x"), ("''", ""), ("'", "'")])
def test_clean_value(spark, raw, want):
    assert one(spark, text.clean_value(s(raw))) == want


def test_file_name_and_keys(spark):
    assert one(spark, text.safe_file_name(s("BRANCHED:NAG-NAG:abcdef"))) == "BRANCHED_NAG-NAG_abcdef"
    assert one(spark, text.is_object_key(s("CCD:ATP"))) and not one(spark, text.is_object_key(s("CCD:atp")))
    bonds = F.array(F.struct(F.lit(1).alias("res_i"), F.lit("O4").alias("atom_i"), F.lit(2).alias("res_j"), F.lit("C1").alias("atom_j")))
    want = "BRANCHED:NAG-BMA:" + hashlib.md5(b'[[1, "O4", 2, "C1"]]').hexdigest()[:6]
    assert one(spark, text.object_key(F.array(F.lit("NAG"), F.lit("BMA")), bonds)) == want
    assert one(spark, text.object_key(F.array(F.lit("ATP")), bonds)) == "CCD:ATP"


def test_atom_name_codes(spark):
    assert one(spark, text.atom_name_codes(s("CA"))) == [35, 33, 0, 0]
    assert one(spark, text.atom_name_codes(s("ABCDE"))) is None


@pytest.mark.parametrize("said,want", [("1-02:03:04", 93784), ("10:00:59", 36059), ("1:60:00", None), ("x", None)])
def test_elapsed(spark, said, want):
    assert one(spark, text.elapsed_seconds(s(said))) == want


def test_aware_time_needs_an_offset(spark):
    assert one(spark, text.aware_time(s("2026-07-18T21:53:48"))) is None
    assert one(spark, text.aware_time(s("2026-07-18T21:53:48+00:00"))) is not None


def test_logs(spark):
    log = "B\ncorrelation = 8.1e-1, correlation about mean = -1.2e-1\nE\n"
    got = one(spark, text.correlations(s(log), "B\n", "E\n"))
    assert (got["plain"], got["about_mean"]) == (0.81, -0.12)
    assert one(spark, text.correlations(s(log + log), "B\n", "E\n")) is None
    benign = "Error processing trigger \"monitor changes\":\n  KeyError: '?'\n"
    assert one(spark, text.fatal_matches(s(benign))) == []
    assert one(spark, text.fatal_matches(s(benign + "Error: bad"))) == [4]


def test_residues(spark):
    assert one(spark, chemistry.residue_class(s("mse"))) == 12
    assert one(spark, chemistry.residue_class(s("XXX"))) == 28
    assert one(spark, chemistry.feature_residue(s("DT"))) == "U" and one(spark, chemistry.token_residue(s("DT"))) == "DT"
    assert one(spark, chemistry.is_backbone(s("DA"), s("P"))) and not one(spark, chemistry.is_backbone(s("ALA"), s("P")))


def test_features(spark):
    shells = F.array(*[F.lit(0)] * 9)
    f = one(spark, chemistry.features(s("C"), s("ALA"), shells))
    assert len(f) == 49 and [i for i, v in enumerate(f[:31]) if v] == [0, 6]
    assert f[31:39] == [0, 1, 0, 0, 1, 0, 0, 1] and f[39] == pytest.approx(12.011 / 32) and f[40:] == [0.0] * 9
    g = one(spark, chemistry.features(s("P"), s("DA"), shells))
    assert [i for i, v in enumerate(g[:31]) if v] == [4, 26]


@pytest.mark.parametrize("element,types,want", [("NA", ["NON-POLYMER"], "ion"), ("CL", ["non-polymer"], "small_molecule"), ("C", ["L-PEPTIDE LINKING", "x"], "peptide_like"), ("C", [], "other"), ("C", ["D-saccharide"], "sugar")])
def test_type_tag(spark, element, types, want):
    arr = F.array(*map(F.lit, types)) if types else F.array().cast("array<string>")
    assert one(spark, chemistry.type_tag(F.lit(False), F.lit(1), F.lit(element), arr)) == want
    assert one(spark, chemistry.type_tag(F.lit(True), F.lit(1), F.lit(element), arr)) == "sugar"


def test_one_hot(spark):
    assert one(spark, chemistry.one_hot(F.lit(1), 3)) == [False, True, False]
    assert one(spark, chemistry.one_hot(F.lit(9), 3)) == [False, False, True]


def arr(*v):
    return F.array(*map(F.lit, v))


def test_canonical_geometry(spark):
    g = one(spark, geometry.canonical(arr(3, 4, 5), arr(1.2, 1.5, 2.0), arr(3.0, 4.0, 5.0), 1.0))
    assert g["out"] == [8, 6, 8] and g["scale"] == 0.25 and g["mode"] == "all_diff"
    assert g["voxel"] == pytest.approx([0.9, 1.0, 1.0]) and g["origin"] == pytest.approx([1.8, 4.0, 3.0]) and not g["moved"]
    assert one(spark, geometry.canonical(arr(10, 12, 14), arr(1.0, 1.0, 1.0), arr(0.0, 0.0, 0.0), 1.0))["mode"] == "all_equal"
    mixed = one(spark, geometry.canonical(arr(10, 12, 14), arr(1.0, 2.0, 1.0), arr(0.0, 0.0, 0.0), 1.0))
    assert mixed["mode"] == "mixed" and mixed["scale"] == 0.5


@pytest.mark.parametrize("axes,stored", [((1, 2, 3), (33, 22, 11)), ((1, 3, 2), (22, 33, 11)), ((2, 1, 3), (33, 11, 22)), ((2, 3, 1), (11, 33, 22)), ((3, 1, 2), (22, 11, 33)), ((3, 2, 1), (11, 22, 33))])
def test_axes(spark, axes, stored):
    assert one(spark, geometry.to_zyx(arr(*stored), *map(F.lit, axes))) == [33, 22, 11]


def test_boxes(spark):
    meets = lambda p: one(spark, geometry.boxes_meet([F.lit(v) for v in p], [F.lit(v) for v in p], [F.lit(10.0), F.lit(20.0), F.lit(30.0)], [F.lit(7), F.lit(6), F.lit(5)], [F.lit(2.0), F.lit(3.0), F.lit(4.0)]))
    assert meets((23.9, 37.9, 49.9))
    assert not meets((24.1, 37.9, 49.9)) and not meets((23.9, 38.1, 49.9)) and not meets((23.9, 37.9, 50.1))


def test_contour_statuses(spark):
    of = lambda j: one(spark, metadata.recommended_contour(F.lit(j)))
    ok = of('{"map":{"contour_list":{"contour":[{"level":0.02,"primary":true,"source":"AUTHOR"}]}}}')
    assert (ok["status"], ok["level"], ok["source"]) == ("ok", 0.02, "AUTHOR")
    assert of('{"map":{"contour_list":{"contour":{"level":"0.5","primary":"YES"}}}}')["level"] == 0.5
    assert of("{}")["status"] == "missing_map_section"
    assert of('{"map":{"contour_list":{"contour":[]}}}')["status"] == "missing_primary_contour"


@pytest.mark.parametrize(
    "emdb,rcsb,want",
    [
        ([2.4], [2.4], (2.4, "multi_candidate_consistent", 2, 1)), ([2.7, 3.1], [2.4], (2.7, "ambiguous_emdb", 3, 3)),
        ([], [3.3], (3.3, "fallback_rcsb", 1, 1)), ([2.5], [], (2.5, "single_unique", 1, 1)), ([2.5], [2.6], (2.5, "rcsb_disagree", 2, 2)), ([], [], (None, "missing", 0, 0)),
    ],
)
def test_resolution(spark, emdb, rcsb, want):
    a = lambda v: F.array(*map(F.lit, v)).cast("array<double>") if v else F.array().cast("array<double>")
    got = one(spark, metadata.resolution(a(emdb), a(rcsb)))
    assert (got["selected"], got["status"], got["n_candidates"], got["n_unique"]) == want


def test_chosen_map(spark):
    refs = F.create_map(F.lit("EMD-2"), F.array(F.lit("1abc")), F.lit("EMD-1"), F.array(F.lit("9zzz")))
    assert one(spark, metadata.chosen_map(F.array(F.lit("EMD-1"), F.lit("EMD-2")), F.lit("1abc"), refs)) == "EMD-2"
    assert one(spark, metadata.chosen_map(F.array(F.lit("EMD-1"), F.lit("EMD-2")), F.lit("2bbb"), refs)) == "EMD-1"
