"""Projections, lookups, scalar contracts and map checks over the driver's tables; every carrier holds rows of each outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.functions import chemistry, geometry, metadata, text
from voxelforge.operators import gates, graph, joins, quality
from voxelforge.operators import select as S
from voxelforge.plans import scalars  # noqa: F401  header_risk_codes reads its SQL
from voxelforge.plans.carriers import LINES, lines
from voxelforge.plans.registry import ORACLES, query
from voxelforge.session import table
from voxelforge.sources import files
from voxelforge.streaming import journal


@query(f"""
SELECT pdb_id, comp, id, x FROM (
  SELECT l_orderkey AS pdb_id, l_linestatus AS comp, candidate_id AS id, CAST(l_quantity AS DOUBLE) AS x,
    row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY candidate_id % 3, CAST(l_discount AS DOUBLE) DESC, candidate_id) AS nth
  FROM {LINES} WHERE candidate_id % 2 = 0 AND l_returnflag <> 'N') WHERE nth = 1""")
def typed_model_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw strings through first model, heavy atoms, alternates and types."""
    raw = lines(spark, sf_dir).selectExpr(
        "l_orderkey AS pdb_id", "candidate_id AS file_pos", "string(candidate_id % 2 + 1) AS pdbx_PDB_model_num", "IF(l_returnflag = 'N', 'h', 'C') AS type_symbol",
        "'A' AS label_asym_id", "l_linestatus AS label_comp_id", "'1' AS label_seq_id", "'1' AS auth_seq_id", "'' AS pdbx_PDB_ins_code", "'CA' AS label_atom_id",
        "element_at(array('', 'A', 'B'), int(candidate_id % 3) + 1) AS label_alt_id", "string(double(l_discount)) AS occupancy", "string(candidate_id) AS id",
        "string(double(l_quantity)) AS Cartn_x", "'0' AS Cartn_y", "'0' AS Cartn_z",
    )
    return S.selected_atoms(raw).selectExpr("pdb_id", "label_comp_id AS comp", "id", "Cartn_x AS x")


@query("""
SELECT p_partkey AS id, CASE WHEN p_size % 5 = 0 THEN 'receptor' ELSE 'ligand' END AS side FROM part
WHERE p_partkey % 7 <> 0 AND (p_size % 5 IN (0, 1, 2) OR p_partkey % 2 = 0)""")
def atom_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receptor and ligand candidates by entity, of which one is unknown and one is of another kind; junk goes."""
    atoms = table(spark, sf_dir, "part").selectExpr(
        "'1abc' AS pdb_id", "p_partkey AS id", "string(p_size % 5) AS label_entity_id", "IF(p_partkey % 7 = 0, 'hoh', 'ALA') AS label_comp_id", "IF(p_partkey % 2 = 0, 'HETATM', 'ATOM') AS group_PDB"
    )
    entities = spark.sql("SELECT * FROM VALUES ('1abc', '0', 'polymer'), ('1abc', '1', 'non-polymer'), ('1abc', '2', 'branched'), ('1abc', '3', 'water') AS t(pdb_id, id, type)")
    receptor, ligand = S.split_atoms(atoms, entities)
    return receptor.select("id", F.lit("receptor").alias("side")).union(ligand.select("id", F.lit("ligand").alias("side")))


_NAMES = "['N', 'CA', 'CB', 'P', 'O5''', 'C3''', 'O', 'C2''']"


@query(f"""
SELECT key, CASE WHEN comp IN ('U', 'DG') THEN atom IN ('P', 'O5''', 'C3''') ELSE atom IN ('N', 'CA', 'O') END AS backbone FROM (
  SELECT p_partkey AS key, (['ALA', 'GLY', 'U', 'DG', 'XYZ'])[p_partkey % 5 + 1] AS comp, ({_NAMES})[p_size % 8 + 1] AS atom FROM part)""")
def backbone_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("key"), F.element_at(F.array(*[F.lit(c) for c in ("ALA", "GLY", "U", "DG", "XYZ")]), (F.col("p_partkey") % 5 + 1).cast("int")).alias("comp"),
        F.element_at(F.array(*[F.lit(c) for c in ("N", "CA", "CB", "P", "O5'", "C3'", "O", "C2'")]), (F.col("p_size") % 8 + 1).cast("int")).alias("atom"),
    )
    return rows.select("key", chemistry.is_backbone(F.col("comp"), F.col("atom")).alias("backbone"))


@query(f"""
SELECT l_orderkey, candidate_id, l_returnflag AS asym, l_linestatus AS comp, CASE WHEN candidate_id % 3 = 0 THEN CASE WHEN candidate_id = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END ELSE CAST(l_partkey AS VARCHAR) END AS seq,
  CASE WHEN candidate_id % 2 = 0 THEN '' ELSE 'A' END AS icode FROM {LINES}""")
def residue_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir).selectExpr(
        "*", "CASE candidate_id % 6 WHEN 0 THEN '' WHEN 3 THEN NULL ELSE string(l_partkey) END AS label_seq", "IF(candidate_id = 0, NULL, string(l_suppkey)) AS auth_seq", "IF(candidate_id % 2 = 0, NULL, 'A') AS ins"
    )
    key = text.residue_key(*[F.col(c) for c in ("l_returnflag", "l_linestatus", "label_seq", "auth_seq", "ins")])
    return rows.select("l_orderkey", "candidate_id", key.alias("k")).select("l_orderkey", "candidate_id", "k.*")


@query("SELECT DISTINCT least(l_partkey, l_suppkey) AS src, greatest(l_partkey, l_suppkey) AS dst FROM lineitem")
def undirected_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(text.undirected(F.col("l_partkey"), F.col("l_suppkey")).alias("e")).select("e.*").distinct()


@query("""
SELECT key, repeat('0', CAST(place AS BIGINT)) || '1' || repeat('0', CAST(5 - place AS BIGINT)) AS bits FROM (SELECT p_partkey AS key, CASE WHEN p_size % 9 BETWEEN 1 AND 6 THEN p_size % 9 - 1 ELSE 5 END AS place FROM part)""")
def one_hot_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = chemistry.one_hot(F.col("p_size") % 9 - 1, 6)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.array_join(F.transform(bits, lambda b: b.cast("int").cast("string")), "").alias("bits"))


@query("SELECT p_partkey AS key, CAST(([1.2, 1.70, 1.55, 1.52, 1.80, 1.80, 1.75])[p_size % 7 + 1] AS DOUBLE) AS radius FROM part")
def element_radii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Radii of the fixed elements, and of two that the caller brings; what the caller says of a fixed one doesn't count."""
    number = F.element_at(F.array(*[F.lit(n) for n in (1, 6, 7, 8, 15, 16, 17)]), (F.col("p_size") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), chemistry.vdw_radius(number, {1: 1.2, 17: 1.75, 6: 9.0}).alias("radius"))


@query("SELECT p_partkey AS key, p_partkey % 5 IN (3, 4) AS finite, p_partkey % 5 = 4 AS positive, p_partkey % 2 = 0 AS same FROM part")
def finite_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = "CASE p_partkey % 5 WHEN 0 THEN double('nan') WHEN 1 THEN double('-inf') WHEN 3 THEN -1D WHEN 4 THEN double(p_partkey) END"
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey AS key", f"{x} AS x", f"IF(p_partkey % 2 = 0, {x}, 0D) AS y")
    a, b = F.col("x"), F.col("y")
    return rows.select("key", chemistry.is_finite(a).alias("finite"), chemistry.is_positive(a).alias("positive"), chemistry.nan_equal(a, b).alias("same"))


@query("""
SELECT p_partkey AS key, CAST(CAST(CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) * (CAST(p_size AS DOUBLE) / 7) AS FLOAT) AS DOUBLE) AS level FROM part""")
def contour_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = geometry.canonical_level(F.col("p_retailprice").cast("float"), F.col("p_size").cast("double") / 7)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), level.cast("double").alias("level"))


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_tax AS DOUBLE) - CAST(l_discount AS DOUBLE) >= CAST(0.02 AS DOUBLE) AS enough FROM lineitem""")
def shift_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    enough = quality.drop_is_enough(F.col("l_tax").cast("double"), F.col("l_discount").cast("double"), 0.02)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", enough.alias("enough"))


@query(f"""
SELECT l_orderkey, candidate_id, l_partkey, previous FROM (SELECT *, lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY candidate_id) AS previous FROM {LINES}) WHERE l_partkey < previous""")
def progress_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir).select("l_orderkey", "candidate_id", "l_partkey")
    return journal.not_monotonic(rows, ["l_orderkey"], "candidate_id", "l_partkey")


@query("SELECT o_orderkey AS key, 950 - o_orderkey % 1100 BETWEEN -60 AND 900 AS fresh FROM orders")
def fresh_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.timestamp_seconds(F.lit(1_700_000_950))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), journal.fresh(F.timestamp_seconds(1_700_000_000 + F.col("o_orderkey") % 1100), now).alias("fresh"))


@query("""
SELECT l_orderkey, CASE WHEN count(*) >= 3 AND l_orderkey % 2 = 1 THEN 1 ELSE 0 END AS rings FROM lineitem GROUP BY l_orderkey HAVING count(*) >= 2 OR l_orderkey % 4 = 0""")
def ring_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of an order's lines; odd orders close theirs, some have edges twice, some a part of their own.

    Lines that share a number may stand in any order: places only name the nodes. All edges come from one pass over the places.
    """
    rows = S.ranked(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"], [F.col("l_linenumber")], "at")
    edge = "named_struct('src', {}, 'dst', {})".format
    chain, back = f"IF(at > 0, {edge('at - 1', 'at')}, NULL)", f"IF(at > 0 AND l_orderkey % 3 = 0, {edge('at', 'at - 1')}, NULL)"
    closing = f"IF(at >= 2 AND at = n - 1 AND l_orderkey % 2 = 1, {edge('at', '0L')}, NULL)"
    apart = f"IF(at = 0 AND l_orderkey % 4 = 0, {edge('100L', '101L')}, NULL)"
    told = rows.selectExpr("l_orderkey", "at", "count(*) OVER (PARTITION BY l_orderkey) AS n")
    edges = told.selectExpr("l_orderkey", f"inline(array({chain}, {closing}, {apart}, {back}))").where("src IS NOT NULL")
    return graph.ring_count(edges, ["l_orderkey"])


_VOXELS = """(SELECT l_suppkey AS map_id, l_linenumber AS z, l_partkey % 5 AS y, l_orderkey % 5 AS x, CASE l_suppkey % 5 WHEN 0 THEN 0.0 WHEN 1 THEN 2.0
  WHEN 2 THEN CASE WHEN l_linenumber = 2 THEN CAST('nan' AS DOUBLE) ELSE 1.0 END WHEN 3 THEN CASE WHEN l_linenumber = 1 THEN 1.0 ELSE 1e-7 END ELSE CAST(l_partkey AS DOUBLE) END AS value FROM lineitem)"""


@query(f"""
WITH v AS {_VOXELS}, t AS (SELECT map_id, count(*) FILTER (NOT isfinite(value)) AS bad, max(abs(value)) AS most, min(value) AS lo, max(value) AS hi FROM v GROUP BY 1),
  p AS (SELECT map_id, count(DISTINCT z) AS nz, count(DISTINCT y) AS ny, count(DISTINCT x) AS nx FROM v JOIN t USING (map_id) WHERE abs(value) > 1e-6 * most GROUP BY 1)
SELECT map_id, code FROM (SELECT map_id, CASE WHEN bad > 0 THEN 'nonfinite' WHEN most = 0 THEN 'all_zero' WHEN lo = hi THEN 'zero_variance'
  WHEN coalesce(least(nz, ny, nx), 0) < 2 THEN 'inactive_axis' END AS code FROM t LEFT JOIN p USING (map_id)) WHERE code IS NOT NULL""")
def density_content_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = """CASE l_suppkey % 5 WHEN 0 THEN 0D WHEN 1 THEN 2D WHEN 2 THEN IF(l_linenumber = 2, double('nan'), 1D) WHEN 3 THEN IF(l_linenumber = 1, 1D, 1e-7D) ELSE double(l_partkey) END AS value"""
    return gates.density_faults(table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS map_id", "l_linenumber AS z", "l_partkey % 5 AS y", "l_orderkey % 5 AS x", value))


@query("""
SELECT o_orderkey AS entry, 'C' || (o_custkey % 3) AS name, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'A' END AS icode, count(l_quantity) AS matches, CAST(min(l_quantity) AS DOUBLE) AS q
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber % 3 = o_custkey % 3 AND (o_orderkey % 2 = 0 OR l_linenumber % 2 = 0) GROUP BY ALL""")
def score_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots with and without an insertion code; some find no atom, some several."""
    slots = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS entry", "concat('C', o_custkey % 3) AS name", "IF(o_orderkey % 2 = 0, '', 'A') AS icode")
    atoms = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS entry", "concat('C', l_linenumber % 3) AS name", "IF(l_linenumber % 2 = 0, 'A', 'B') AS icode", "double(l_quantity) AS q")
    return joins.project_scores(slots, atoms, ["entry", "name"], ["icode"])


_PAIRS = "(SELECT 'p' || s_suppkey AS pdb_id, CAST(s_suppkey AS VARCHAR) AS n FROM supplier)"


@query(f"""
SELECT pdb_id, 'mmcif' AS resource, '/d/raw/mmcif/' || pdb_id || '.cif' AS path FROM {_PAIRS} UNION ALL SELECT pdb_id, 'map', '/d/raw/map/emd_' || n || '.map.gz' FROM {_PAIRS}
UNION ALL SELECT pdb_id, 'meta', '/d/raw/meta/emd_' || n || '.json' FROM {_PAIRS}""")
def resource_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "supplier").selectExpr("concat('p', s_suppkey) AS pdb_id", "concat(element_at(array('EMD-', 'emd-', ''), int(s_suppkey % 3) + 1), s_suppkey) AS emdb_id")
    return files.resource_targets(pairs, "/d")


_FOUND = "SELECT DISTINCT 'a' || o_custkey AS pdb_id FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 4 <> 0 AND (o_custkey % 2 = 1 OR o_orderkey % 5 = 0)"


@query(_FOUND)
def entry_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.enumerate_entries(_snapshot(spark, sf_dir))


@query(f"{_FOUND} ORDER BY pdb_id LIMIT 25")
def entry_search_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the operator's own."""
    return files.enumerate_entries(_snapshot(spark, sf_dir), 25)


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries by method, maps and ligands; counts of ligands may be missing."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('A', o_custkey) AS pdb_id", "IF(o_orderkey % 3 = 0, array('X-RAY DIFFRACTION'), array('NMR', 'EM')) AS methods",
        "IF(o_orderkey % 4 = 0, CAST(array() AS ARRAY<STRING>), array('EMD-1')) AS emdb_ids", "IF(o_custkey % 2 = 1, 2, NULL) AS n_nonpolymer", "IF(o_orderkey % 5 = 0, 1, 0) AS n_branched",
    )


@query("""
SELECT key, CASE p WHEN 0 THEN CASE WHEN c[1] = 'm3' THEN c[2] ELSE c[1] END WHEN 1 THEN 'm2' WHEN 2 THEN 'm3' ELSE c[1] END AS chosen
FROM (SELECT o_orderkey AS key, o_custkey % 4 AS p, CASE o_orderkey % 3 WHEN 0 THEN ['m1', 'm2', 'm3'] WHEN 1 THEN ['m2', 'm3', 'm1'] ELSE ['m3', 'm1', 'm2'] END AS c FROM orders)""")
def chosen_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS key", "concat('p', o_custkey % 4) AS pdb_id", "CASE o_orderkey % 3 WHEN 0 THEN array('m1', 'm2', 'm3') WHEN 1 THEN array('m2', 'm3', 'm1') ELSE array('m3', 'm1', 'm2') END AS candidates",
        "map('m1', array('p0'), 'm2', array('p1', 'p0'), 'm3', array('p2')) AS listed",
    )
    return rows.select("key", metadata.chosen_map(F.col("candidates"), F.col("pdb_id"), F.col("listed")).alias("chosen"))


@query("SELECT l_orderkey, l_returnflag, 'duplicate_key' AS code FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def atom_name_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"])


_SHAPES = {"CCD:A1B": True, "CCD:abc": False, "BRANCHED:NAG-BMA:0a1b2c": True, "BRANCHED:NAG:0a1b2c": False, "CCD:ABCDEFGHI": False, "BRANCHED:NAG-BMA:0A1B2C": False, " CCD:A": False}


@query(f"SELECT p_partkey AS key, coalesce(([{', '.join(str(ok).lower() for ok in _SHAPES.values())}])[p_size % 8 + 1], false) AS ok FROM part")
def object_key_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of both kinds, others that miss by a part, and a null."""
    keys = F.get(F.array(*[F.lit(k) for k in _SHAPES]), (F.col("p_size") % 8).cast("int"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), text.is_object_key(keys).alias("ok"))


@query(f"""
SELECT p_partkey AS key, concat_ws(',', CASE WHEN p_partkey % 9 = 0 THEN 'header_read' END, CASE WHEN mode = 'mixed' THEN 'mixed_axes' END, CASE WHEN moved THEN 'origin_shift_axis_order' END) AS codes
FROM ({ORACLES["resample_geometry"]})""")
def header_risk_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers stored with another order of axes, over the lengths of resample_geometry."""
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS key", "IF(p_partkey % 9 = 0, 'header_failed', 'ok') AS status", "p_size + 2 AS nz", "p_size + 3 AS ny", "p_partkey % 50 + 2 AS nx", "3 AS mapc", "2 AS mapr", "1 AS maps",
        "2D AS voxel_x", "1.5D AS voxel_y", "1.2D AS voxel_z", "0D AS origin_x", "0D AS origin_y", "0D AS origin_z",
    )
    return gates.header_risks(rows, 1.0).select("key", F.array_join("risk_codes", ",").alias("codes"))
