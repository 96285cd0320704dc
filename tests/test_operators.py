import math
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from voxelforge.operators import gates, graph, joins, quality, repair, spatial
from voxelforge.operators import select as S
from voxelforge.operators.components import connected_components
from voxelforge.session import shared_folder
from voxelforge.streaming import journal

RAW = ["id", "group_PDB", "type_symbol", "label_atom_id", "label_alt_id", "label_comp_id", "label_asym_id", "label_entity_id", "label_seq_id", "auth_seq_id", "pdbx_PDB_ins_code", "occupancy", "Cartn_x", "Cartn_y", "Cartn_z", "pdbx_PDB_model_num"]


def atoms(spark, rows):
    base = {"group_PDB": "HETATM", "type_symbol": "C", "label_atom_id": "C1", "label_alt_id": "", "label_comp_id": "LIG", "label_asym_id": "B", "label_entity_id": "2", "label_seq_id": "", "auth_seq_id": "9", "pdbx_PDB_ins_code": "", "occupancy": "1.0", "Cartn_x": "1", "Cartn_y": "2", "Cartn_z": "3", "pdbx_PDB_model_num": "1"}
    full = [{**base, **r} for r in rows]
    return spark.createDataFrame([("1abc", i, *[r[c] for c in RAW]) for i, r in enumerate(full)], "pdb_id string, file_pos long, " + ", ".join(f"{c} string" for c in RAW))


def test_altloc_prefers_a_blank_location_then_occupancy_then_id(spark):
    rows = [{"id": "2", "label_alt_id": "A"}, {"id": "1", "occupancy": "0.2"}]
    assert [r["id"] for r in S.selected_atoms(atoms(spark, rows)).collect()] == [1]
    rows = [{"id": "5", "label_alt_id": "B"}, {"id": "4", "label_alt_id": "A", "occupancy": "0.1"}, {"id": "7", "label_comp_id": "XXX"}]
    assert sorted(r["id"] for r in S.selected_atoms(atoms(spark, rows)).collect()) == [4, 7]


def test_first_model_and_hydrogens(spark):
    rows = [{"id": "3", "pdbx_PDB_model_num": "2"}, {"id": "1"}, {"id": "4", "type_symbol": "D", "label_atom_id": "D1", "pdbx_PDB_model_num": "2"}]
    assert [r["id"] for r in S.selected_atoms(atoms(spark, rows)).collect()] == [3]


def test_split(spark):
    rows = [{"id": "1"}, {"id": "2", "label_entity_id": "1", "group_PDB": "HETATM"}, {"id": "3", "label_comp_id": "HOH"}, {"id": "4", "label_entity_id": "7", "group_PDB": "ATOM"}]
    entities = spark.createDataFrame([("1abc", "1", "polymer"), ("1abc", "2", "non-polymer")], "pdb_id string, id string, type string")
    receptor, ligand = S.split_atoms(atoms(spark, rows), entities)
    assert [r["id"] for r in receptor.collect()] == ["2"] and [r["id"] for r in ligand.collect()] == ["1"]


def test_shards(spark):
    got = S.shard(spark.range(10, 17), [F.col("id")], 3).orderBy("id").collect()
    assert [r["shard"] for r in got] == [0, 1, 2, 0, 1, 2, 0]
    assert S.shard(spark.range(0), [F.col("id")], 3).count() == 0


def test_only_ids_raises_for_an_absent_one(spark):
    with pytest.raises(Exception, match="absent id"):
        S.only_ids(spark.range(3), spark.range(2, 5), "id").collect()
    assert S.only_ids(spark.range(3), spark.range(2), "id").count() == 2
    twice = spark.range(3).union(spark.range(1))
    for rows, ids in ((twice, spark.range(2)), (spark.range(3), twice)):
        with pytest.raises(Exception, match="repeated"):
            S.only_ids(rows, ids, "id").collect()


def test_components_against_a_plain_union(spark):
    import random

    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {n: find(n) for n in list(parent)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_template_align(spark):
    template = spark.createDataFrame([("1abc", c, 1, n) for c in (0, 1) for n in ("C1", "O1")], "pdb_id string, cid int, res int, atom string")
    there = spark.createDataFrame([("1abc", 0, 1, "C1", 4.0), ("1abc", 1, 1, "C1", 1.0), ("1abc", 1, 1, "ZZ", 2.0)], "pdb_id string, cid int, res int, atom string, x double")
    aligned, failed = joins.align(template, there, ["pdb_id", "cid"], ["res", "atom"], ["x"])
    assert sorted((r["cid"], r["atom"], r["x"], r["present"]) for r in aligned.collect()) == [(0, "C1", 4.0, True), (0, "O1", None, False)]
    assert [r["cid"] for r in failed.collect()] == [1]


def test_first_match_takes_keys_in_order_and_zero_is_a_hit(spark):
    probe = spark.createDataFrame([(1, 1), (2, 1), (3, 9)], "a int, b int")
    one = spark.createDataFrame([(1, 0)], "a int, idx int")
    two = spark.createDataFrame([(1, 7)], "b int, idx int")
    assert [r["idx"] for r in joins.first_match(probe, [(["a"], one), (["b"], two)], "idx").orderBy("a").collect()] == [0, 7, None]


def test_scores_project_by_component_and_name(spark):
    slots = spark.createDataFrame([(0, "A", None, "C1"), (1, "B", "5", "C1"), (2, "B", "5", "O9")], "row int, asym string, seq string, atom string")
    scored = spark.createDataFrame([("B", "5", "C1", 0.8), ("A", "1", "C1", 0.2)], "asym string, seq string, atom string, q double")
    got = joins.project_scores(slots, scored, ["asym", "atom"], ["seq"]).orderBy("row").collect()
    assert [(r["matches"], r["q"]) for r in got] == [(1, 0.2), (1, 0.8), (0, None)]


def test_nearest(spark):
    receptor = spark.createDataFrame([("p", i, float(x), 0.0, 0.0) for i, x in enumerate((0, 5, 20))], "pdb_id string, row_idx long, x double, y double, z double")
    ligand = spark.createDataFrame([("p", 3, 0, 1.0, 0.0, 0.0, True), ("p", 8, 0, 9.0, 0.0, 0.0, True), ("p", 1, 0, 0.0, 0.0, 0.0, False)], "pdb_id string, candidate_id long, row_idx long, x double, y double, z double, present boolean")
    got = spatial.nearest(receptor, ligand, 4.0).orderBy("row_idx").collect()
    assert [(r["dist"], r["binding"], r["instance"]) for r in got] == [(1.0, True, 3), (4.0, True, 3), (11.0, False, -1)]


def test_nearest_tie_takes_the_smaller_candidate(spark):
    receptor = spark.createDataFrame([("p", 0, 0.0, 0.0, 0.0)], "pdb_id string, row_idx long, x double, y double, z double")
    ligand = spark.createDataFrame([("p", 9, 0, 1.0, 0.0, 0.0, True), ("p", 2, 0, -1.0, 0.0, 0.0, True)], "pdb_id string, candidate_id long, row_idx long, x double, y double, z double, present boolean")
    assert spatial.nearest(receptor, ligand, 4.0).first()["instance"] == 2


def test_shells(spark):
    rows = spark.createDataFrame([("p", i, float(x), 0.0, 0.0) for i, x in enumerate((0, 1, 3))], "pdb_id string, row_idx long, x double, y double, z double")
    got = [r["shells"][:2] for r in spatial.shell_counts(rows).orderBy("row_idx").collect()]
    assert got == [[1, 1], [2, 0], [1, 1]]


def test_voxels_against_the_whole_grid(spark):
    grid = spark.createDataFrame([("p", 10, 9, 8, 1.0, 1.0, 1.0, 10.0, 20.0, 30.0)], "pdb_id string, nx int, ny int, nz int, vx double, vy double, vz double, ox double, oy double, oz double")
    points = [(0, 13.0, 24.0, 35.0, 1.70), (0, 14.0, 24.0, 35.0, 1.52), (1, 10.1, 20.2, 30.3, 1.8)]
    rows = spark.createDataFrame([("p", *p) for p in points], "pdb_id string, candidate_id int, x double, y double, z double, radius double")
    want = {(c, z, y, x) for c, px, py, pz, r in points for z in range(8) for y in range(9) for x in range(10) if (10.5 + x - px) ** 2 + (20.5 + y - py) ** 2 + (30.5 + z - pz) ** 2 <= r * r + 1e-8}
    mask = spatial.voxels(rows, grid)
    assert {(r["candidate_id"], r["z"], r["y"], r["x"]) for r in mask.collect()} == want
    assert spatial.mask_union(mask, grid).count() == len({w[1:] for w in want})


CONFIG = {"schema_version": 2, "cc_field": "cc_all_about_mean", "cc_min": 0.6, "resolution_max": 5.0, "resolution_comparison": "inclusive", "ligand_q_min": 0.7, "pocket_q_min": 0.65, "qualified_pair_fraction_min": 1 / 3, "empty_pocket": "fail_and_count_denominator", "keep_only_maps_that_pass": True, "keep_all_occurrences_in_passing_map": True}


def scores(spark, rows):
    return spark.createDataFrame(rows, "pdb_id string, candidate_id int, q_score double, pocket_q_score double, map_resolution double, cc_all_about_mean double")


def test_map_filter(spark):
    rows = scores(spark, [("1aaa", 0, 0.71, 0.66, 5.0, 0.6), ("1aaa", 1, 0.70, 0.90, 5.0, 0.6), ("1aaa", 2, 0.90, None, 5.0, 0.6), ("2bbb", 0, 0.9, 0.9, 3.0, 0.59)])
    config = quality.FilterConfig.of(CONFIG)
    assert sorted(tuple(r) for r in quality.keep_list(rows, config).collect()) == [("1aaa", 0), ("1aaa", 1), ("1aaa", 2)]
    told = {r["pdb_id"]: r for r in quality.map_diagnostics(rows, config).collect()}
    assert (told["1aaa"]["n_pass"], told["1aaa"]["n_empty"], told["1aaa"]["fraction"]) == (1, 1, pytest.approx(1 / 3))
    assert told["2bbb"]["reasons"] == ["selected_cc_below_min"]


def test_map_filter_strictness_and_nulls(spark):
    config = quality.FilterConfig.of(CONFIG | {"qualified_pair_fraction_min": 0.75})
    rows = scores(spark, [("1aaa", 0, 0.8, 0.65, 5.0, 0.7), ("1aaa", 1, 0.8, 0.9, 5.0, 0.7), ("3ccc", 0, 0.9, 0.9, 2.0, None)])
    told = {r["pdb_id"]: r for r in quality.map_diagnostics(rows, config).collect()}
    assert told["1aaa"]["fraction"] == 0.5 and told["1aaa"]["reasons"] == ["qualified_pair_fraction_below_min"]
    assert told["3ccc"]["reasons"] == ["selected_cc_unavailable"]


@pytest.mark.parametrize("cc", [(0.70, 0.71), (0.7, None)])
def test_map_filter_wants_one_value(spark, cc):
    rows = scores(spark, [("1aaa", i, 0.8, 0.7, 5.0, c) for i, c in enumerate(cc)])
    with pytest.raises(Exception, match="not one finite value"):
        quality.keep_list(rows, quality.FilterConfig.of(CONFIG)).collect()


@pytest.mark.parametrize("change", [{"cc_min": 2.0}, {"cc_field": "x"}, {"extra": 1}, {"resolution_max": 0.0}, {"keep_only_maps_that_pass": 1}, {"schema_version": 1}, {"ligand_q_min": "a"}])
def test_filter_config_is_checked(change):
    with pytest.raises(ValueError):
        quality.FilterConfig.of(CONFIG | change)


def test_distributions(spark):
    rows = spark.createDataFrame([(v,) for v in (0.25, 0.5, 1.0, 2.0)], "v double")
    got = quality.against_one(rows, "v").first()
    assert (got["n_less"], got["n_equal"], got["n_greater"], got["median"]) == (2, 1, 1, 0.75)
    with pytest.raises(Exception, match="not finite"):
        quality.distribution(spark.createDataFrame([(float("nan"),)], "v double"), "v").collect()
    assert quality.summary(rows.where("v > 9"), "v").first()["sum"] == 0


def test_correlation_codes(spark):
    row = spark.createDataFrame([(None, None, 0.4, -0.1)], "cc_contour double, cc_contour_about_mean double, cc_all double, cc_all_about_mean double")
    assert row.select(gates.correlation_codes(F.lit(False)).alias("c")).first()["c"] == []
    assert row.select(gates.correlation_codes(F.lit(True)).alias("c")).first()["c"] == ["cc_unexpected_null:cc_contour", "cc_unexpected_null:cc_contour_about_mean"]
    bad = row.withColumn("cc_all", F.lit(1.2))
    assert bad.select(gates.correlation_codes(F.lit(False)).alias("c")).first()["c"] == ["cc_out_of_range:cc_all"]


def test_path_graph(spark):
    edges = spark.createDataFrame([("k", i, i + 1) for i in range(3)], "key string, src int, dst int")
    paths = graph.shortest_paths(edges, ["key"], 9)
    assert graph.path_scalars(paths, ["key"]).first()["wiener"] == 10
    local = {r["src"]: r for r in graph.local_scalars(paths, ["key"]).collect()}
    assert (local[0]["eccentricity"], local[0]["n1"], local[0]["n2"], local[0]["n3"]) == (3, 1, 1, 1) and (local[1]["eccentricity"], local[1]["n1"], local[1]["n2"]) == (2, 2, 1)
    assert graph.graph_energy(edges, "key").first()["energy"] == pytest.approx(4.47213595)
    assert graph.ring_count(edges, ["key"]).first()["rings"] == 0
    line = spark.createDataFrame([("k", float(i), 0.0, 0.0) for i in range(4)], "key string, x double, y double, z double")
    assert graph.gyration_radius(line, ["key"]).first()["rg"] == pytest.approx(math.sqrt(1.25))
    ring = edges.union(spark.createDataFrame([("k", 3, 0)], "key string, src int, dst int"))
    assert graph.ring_count(ring, ["key"]).first()["rings"] == 1


def rings_of(edges):
    """By union and find: {key: edges that close a ring}."""
    root, rings = {}, {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for k, u, v in {(k, min(u, v), max(u, v)) for k, u, v in edges}:
        a, b = find((k, u)), find((k, v))
        rings[k] = rings.get(k, 0) + (a == b)
        root[a] = b
    return rings


@pytest.mark.parametrize("whole", [1 << 18, 40, 0])
def test_rings_in_tasks_and_by_parts(spark, monkeypatch, whole):
    monkeypatch.setattr(graph, "WHOLE", whole)
    draw = random.Random(5)
    sizes = [1, 2, 3, 5, 30, 60, 200]
    edges = [(None if i == 9 else i, draw.randrange(n), draw.randrange(n)) for i in range(40) for n in [draw.choice(sizes)] for _ in range(n)]
    edges += [(40, i, i + 1) for i in range(3000)] + [(41, 3000 - i, 9000) for i in range(3000)] + [(42, i, (7 * i + 1) % 500) for i in range(500)]
    draw.shuffle(edges)
    told = spark.createDataFrame(edges, "key int, src int, dst int").repartition(5)
    got = graph.ring_count(told, ["key"]).collect()
    assert len(got) == 43 and {r["key"]: r["rings"] for r in got} == rings_of(edges)
    named = told.selectExpr("key AS a", "string(key) AS b", "string(src) AS src", "string(dst) AS dst").where("key < 9")
    assert {r["a"]: r["rings"] for r in graph.ring_count(named, ["a", "b"]).collect()} == {k: n for k, n in rings_of(edges).items() if k is not None and k < 9}
    assert graph.ring_count(told.limit(0), ["key"]).count() == 0


def test_rings_of_large_graphs_by_blocks(spark, monkeypatch):
    """Long chains, of which every edge is there three times: blocks leave so few parts that no components are sought."""
    monkeypatch.setattr(graph, "WHOLE", 50)
    monkeypatch.setattr(graph, "connected_components", None)
    edges = [(k, i, (i + 1) % 400 if k else i + 1) for k in (0, 1, None) for i in range(400)] * 3
    got = graph.ring_count(spark.createDataFrame(edges, "key int, src int, dst int").repartition(4), ["key"]).collect()
    assert sorted((str(r["key"]), r["rings"]) for r in got) == [("0", 0), ("1", 1), ("None", 0)]


def test_graph_over_several_batches(spark):
    edges = [(i % 3, j, (j + 1) % (50 + i)) for i in range(7) for j in range(50 + i)]
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = graph.ring_count(spark.createDataFrame(edges, "key int, src int, dst int"), ["key"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    assert {r["key"]: r["rings"] for r in got} == rings_of(edges)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_rings_of_small_graphs_take_little_disk(spark):
    """What the query shuffles and leaves in the shared folder, against its input."""
    import __spark_entry__ as entry

    folder = Path(shared_folder(spark).removeprefix("file:"))
    used = lambda: sum(p.stat().st_size for p in folder.rglob("*") if p.is_file()) + spark._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = used()
    assert entry.queries()["ring_counts"](spark, "/root/testdata/sf0.01").count() == 13902
    assert used() - before < 4 * os.path.getsize("/root/testdata/sf0.01/lineitem.parquet")


def test_bonds_override(spark):
    of = lambda *r: spark.createDataFrame(list(r), "p string, src int, dst int, type string")
    got = graph.receptor_bonds(of(("a", 1, 0, "single"), ("a", 2, 2, "single")), of(("a", 0, 1, "")), of(("a", 0, 1, "hydrog"), ("a", 3, 4, "disulf")), ["p"])
    assert sorted((r["src"], r["dst"], r["bond_type"]) for r in got.collect()) == [(0, 1, 3), (3, 4, 4)]
    with pytest.raises(Exception, match="no code"):
        graph.receptor_bonds(of(("a", 1, 0, "quadruple")), of().limit(0), of().limit(0), ["p"]).collect()


def test_consecutive(spark):
    rows = spark.createDataFrame([("c", 1, "x"), ("c", 2, "y"), ("d", 1, "x"), ("d", 3, "y")], "chain string, seq int, comp string")
    assert [(r["chain"], r["comp"], r["next_comp"]) for r in joins.consecutive_links(rows, ["chain"], "seq", ["comp"]).collect()] == [("c", "x", "y")]


def test_ledger(spark):
    universe = spark.createDataFrame([("1aaa",), ("2bbb",), ("3ccc",)], "pdb_id string")
    rows = spark.createDataFrame([("1aaa", "stage_d", "success"), ("1aaa", "stage_d", "success"), ("9zzz", "stage_d", "weird"), ("2bbb", "stage_d", "unknown_failed")], "pdb_id string, stage string, status string")
    got = sorted((r["pdb_id"], r["code"]) for r in gates.release(rows, universe, "stage_d").collect())
    assert got == [("1aaa", "duplicate"), ("2bbb", "unknown_failed"), ("3ccc", "missing"), ("9zzz", "extra"), ("9zzz", "state")]
    with pytest.raises(ValueError):
        gates.require(gates.release(rows, universe, "stage_d"))


def test_migration_and_overlay(spark):
    of = lambda *r: spark.createDataFrame(list(r), "p string, what string, rank int")
    got = joins.migrated_keys(of(("a", "x", 0), ("a", "y", 1), ("a", "z", 2)), of(("a", "x", 0), ("a", "z", 1), ("a", "n", 2)), "p", ["what"], "rank")
    assert sorted((r["old_rank"], r["new_rank"], r["change"]) for r in got.where("old_rank IS NOT NULL AND new_rank IS NOT NULL").collect()) == [(0, 0, "unchanged"), (2, 1, "reassigned")]
    assert {r["change"] for r in got.collect()} == {"unchanged", "reassigned", "added", "removed"}
    assert sorted(r["rank"] for r in joins.overlay(of(("a", "x", 0), ("b", "x", 0)), of(("b", "q", 9)), ["p"]).collect()) == [0, 9]


def test_journal(spark):
    rows = spark.createDataFrame([("f", 1, "intent"), ("f", 2, "deleted"), ("g", 1, "deleted"), ("h", 1, "intent")], "path string, seq int, event string")
    legal = {(r["path"], r["seq"]): r["legal"] for r in journal.transitions(rows, ["path"], "event", "seq").collect()}
    assert legal == {("f", 1): True, ("f", 2): True, ("g", 1): False, ("h", 1): True}
    live = spark.createDataFrame([("f",)], "path string")
    assert {r["path"]: r["action"] for r in journal.replay(journal.last_state(rows, ["path"], "event", "seq"), live, ["path"]).collect()} == {"f": "error", "g": "none", "h": "recovered_deleted"}


def test_transactions(spark):
    rows = [("a", "1", "n"), ("b", "1", "n"), ("b", "2", "o"), ("c", "1", "o"), ("d", "1", "?"), ("e", "1", "n")]
    files = spark.createDataFrame([(k, p, n, "o", "n") for k, p, n in rows], "k string, path string, now string, before string, after string")
    notes = spark.createDataFrame([("a", "committed"), ("b", "committing"), ("e", "committing")], "k string, state string")
    assert {r["k"]: r["action"] for r in repair.transaction(files, notes, "k").collect()} == {"a": "already_committed", "b": "restore_then_commit", "c": "commit", "d": "refuse", "e": "finish_receipt"}


def test_tail_plan_wants_a_gap(spark):
    with pytest.raises(ValueError):
        repair.tail_plan(spark.range(100), [F.col("id")], 10, 85, 10, 2, spark.range(0), spark.range(100), "id")
    got = repair.tail_plan(spark.range(100), [F.col("id")], 10, 50, 10, 2, spark.range(95, 97), spark.range(100), "id")
    assert got.count() == 8 and {r["stop_at"] for r in got.collect()} == {88}


def test_q_output_against_the_model(spark):
    of = lambda *r: spark.createDataFrame(list(r), "id long, atom string, Cartn_x double, Cartn_y double, Cartn_z double")
    got = joins.q_against_model(of((1, "C", 1.0, 1.0, 1.0), (2, "C", 1.0, 1.0, 1.0), (3, "C", 1.0, 1.0, 1.0)), of((1, "C", 1.0001, 1.0, 1.0), (2, "N", 1.0, 1.0, 1.0), (4, "C", 1.0, 1.0, 1.0)), ["atom"])
    assert sorted((r["id"], r["code"]) for r in got.collect()) == [(2, "identity"), (3, "missing"), (4, "extra")]


def test_density(spark):
    rows = [("flat", z, y, x, 1.0) for z in range(2) for y in range(2) for x in range(2)] + [("ok", z, y, x, float(z + y + x + 1)) for z in range(2) for y in range(2) for x in range(2)] + [("zero", 0, 0, 0, 0.0), ("nan", 0, 0, 0, float("nan")), ("thin", 0, 0, 0, 1.0), ("thin", 0, 0, 1, 2.0)]
    got = {r["map_id"]: r["code"] for r in gates.density_faults(spark.createDataFrame(rows, "map_id string, z int, y int, x int, value double")).collect()}
    assert got == {"flat": "zero_variance", "zero": "all_zero", "nan": "nonfinite", "thin": "inactive_axis"}


def test_process_rows(spark):
    rows = spark.createDataFrame([(1, 0, 5, ["python3", "/x/score.py"]), (2, 1, 6, ["bash", "-"]), (3, 1, 7, ["ls"])], "pid long, ppid long, start_ticks long, args array<string>")
    import hashlib

    got = {r["pid"]: (r["category"], r["blocked"]) for r in gates.process_rows(rows, "score.py", "recover.py").collect()}
    assert got == {1: ("stage", True), 2: ("opaque", True), 3: (None, False)}
    excepted = gates.process_rows(rows, "score.py", "recover.py", (2, 1, 6, hashlib.sha256(b"bash\x00-").hexdigest()))
    assert {r["pid"]: r["blocked"] for r in excepted.collect()} == {1: True, 2: False, 3: False}


def test_exact_quantiles_against_numpy(spark):
    import numpy as np

    rnd = np.random.default_rng(1)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 257)) for v in np.round(rnd.normal(size=n), 1)] + [("c", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r["quantiles"] for r in quality.exact_quantiles(df, "v", ["g"], [0.0, 0.01, 0.5, 0.95, 1.0]).collect()}
    for g in "abc":
        assert got[g] == pytest.approx(np.quantile([v for k, v in rows if k == g and v is not None], [0.0, 0.01, 0.5, 0.95, 1.0]).tolist())
    told = {r["g"]: r for r in quality.distribution(df, "v", ["g"]).collect()}
    assert (told["c"]["n_finite"], told["c"]["n_null"], told["d"]["quantiles"]) == (257, 1, [])
    assert quality.distribution(spark.createDataFrame([], "v double"), "v").count() == 0


@pytest.mark.parametrize("number,ok", [(6, True), (16, True), (12, True), (99, False), (None, False)])
def test_vdw_radius_raises_for_an_unknown_element(spark, number, ok):
    from voxelforge.functions.chemistry import vdw_radius

    df = spark.createDataFrame([(number,)], "n int").select(vdw_radius(F.col("n"), {12: 1.73}).alias("r"))
    if ok:
        assert df.first()["r"] > 1.5
    else:
        with pytest.raises(Exception, match="no radius"):
            df.collect()


def test_small_join_deals_hot_keys(spark, monkeypatch):
    """Beyond the size that is broadcast, with a key of half of the rows: the rows are those of a plain join."""
    monkeypatch.setattr(joins, "FEW", 3)
    monkeypatch.setattr(joins, "PARTS", 16)
    rows = spark.range(400).selectExpr("id", "IF(id % 2 = 0, 0, id) AS k")
    small = spark.range(0, 300).selectExpr("id AS k", "id * 2 AS v")
    for how in ("inner", "left"):
        got, want = joins.small_join(rows, small, "k", ["id"], how), rows.join(small, "k", how)
        assert sorted(map(str, got.select("k", "id", "v").collect())) == sorted(map(str, want.select("k", "id", "v").collect()))


def test_watch_log(spark, tmp_path):
    """The last line of the newest file counts, though its number is smaller and its name comes first."""
    import os

    from voxelforge.streaming import journal

    logs = tmp_path / "logs"
    logs.mkdir()
    for name, lines, at in (("b.log", ["Done 3 tasks", "Done 90 tasks", "nothing"], 1000), ("a.log", ["Done 40 tasks", "Done 12 tasks", "x"], 2000)):
        (logs / name).write_text("\n".join(lines) + "\n")
        os.utime(logs / name, (at, at))
    got = []
    stream = journal.watch_log(spark, str(logs), lambda batch, done: got.append(done)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    stream.awaitTermination(60)
    assert got[-1] == 12


def test_summary_of_nothing(spark):
    from voxelforge.operators import quality

    rows = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, None)], "k int, v double")
    assert quality.summary(rows, "v").collect() == [(2, 6.0, 3.0, 4.0)]
    assert quality.summary(rows.limit(0), "v").collect() == [(0, 0.0, 0.0, 0.0)]
    assert sorted(quality.summary(rows, "v", ["k"]).collect()) == [(1, 2, 6.0, 3.0, 4.0), (2, 0, 0.0, 0.0, 0.0)]
