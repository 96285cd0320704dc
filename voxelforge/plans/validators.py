"""Integrity constraints, lookups and graph assembly over the driver's tables; every carrier holds rows that pass and rows that fail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.operators import gates, graph, joins, repair
from voxelforge.operators import select as S
from voxelforge.plans.carriers import LINES, lines
from voxelforge.plans.registry import query
from voxelforge.session import table

_CODES = "SELECT {key}, code FROM (SELECT {key}, unnest([{cases}]) AS code FROM {rows}) WHERE code IS NOT NULL"


def _broken(key: str, rows: str, **cases: str) -> str:
    """SQL of violations(): a code for each condition that doesn't hold."""
    return _CODES.format(key=key, rows=rows, cases=", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{code}' END" for code, c in cases.items()))


def _part(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*columns)


_KEYS = "(SELECT CASE WHEN l_orderkey % 7 = 0 THEN 'bad' ELSE 'a' || lpad(CAST(l_orderkey % 1000 AS VARCHAR), 3, '0') END AS pdb_id, l_linenumber - 2 AS candidate_id FROM lineitem)"


@query(_broken("pdb_id, candidate_id", _KEYS, missing_entry="regexp_full_match(pdb_id, '[a-z0-9]{4}')", invalid_candidate="candidate_id >= 0")
       + f" UNION ALL SELECT pdb_id, candidate_id, 'duplicate_key' FROM {_KEYS} GROUP BY 1, 2 HAVING count(*) > 1")
def occurrence_key_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr("CASE WHEN l_orderkey % 7 = 0 THEN 'bad' ELSE concat('a', lpad(l_orderkey % 1000, 3, '0')) END AS pdb_id", "l_linenumber - 2 AS candidate_id")
    return gates.occurrence_keys(rows)


_COORDS = "(SELECT p_size AS candidate_id, p_partkey AS row_idx, p_partkey % 3 <> 0 AS present, CASE WHEN p_partkey % 5 <> 0 THEN 1.5 END AS x FROM part)"


@query(f"""
SELECT candidate_id, row_idx, 'present' AS code FROM {_COORDS} WHERE present = (x IS NULL)
UNION ALL SELECT candidate_id, row_idx, 'template_rows' FROM {_COORDS} WHERE row_idx % 11 = 0""")
def coordinate_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = [f"CASE WHEN p_partkey % 5 <> 0 THEN double(1.5) END AS {a}" for a in "xyz"]
    coords = _part(spark, sf_dir, "'1abc' AS pdb_id", "p_size AS candidate_id", "p_partkey AS row_idx", "p_partkey % 3 <> 0 AS present", *at)
    return gates.coordinate_faults(coords, coords.where("row_idx % 11 <> 0")).drop("pdb_id")


@query("SELECT c_custkey AS key, 'centroid' AS code FROM customer WHERE c_custkey % 6 = 0 OR c_custkey % 10 = 0")
def centroid_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_acctbal AS x", "c_acctbal / 2 AS y", "double(1) AS z")
    made = stored.where("key % 10 <> 0").selectExpr("key", "IF(key % 6 = 0, x + 0.001D, x + 1e-7D) AS x", "y", "z")
    return gates.centroid_faults(stored, made, ["key"])


_LABELS = """(SELECT p_partkey AS row_idx, CAST(p_partkey % 80 AS FLOAT) / 10 - 1 AS dist,
  (CAST(p_partkey % 80 AS FLOAT) / 10 - 1 <= 4) <> (p_partkey % 9 = 0) AS binding, CASE WHEN p_partkey % 4 = 0 THEN -1 ELSE p_partkey % 50 END AS instance FROM part)"""


@query(_broken("row_idx", _LABELS, distance="dist >= 0", binding="binding = (dist <= 4)", background="binding OR instance = -1", instance="NOT binding OR (instance BETWEEN 0 AND 39)"))
def label_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    dist = "(float(p_partkey % 80) / float(10) - float(1))"
    rows = _part(spark, sf_dir, "'1abc' AS pdb_id", "p_partkey AS row_idx", f"float{dist} AS dist", f"({dist} <= 4) <> (p_partkey % 9 = 0) AS binding", "IF(p_partkey % 4 = 0, -1L, p_partkey % 50) AS instance")
    return gates.label_faults(rows, spark.range(40).selectExpr("'1abc' AS pdb_id", "id AS candidate_id"), 4.0).drop("pdb_id")


_ATOMS = "(SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS key, p_size, substr(p_brand, 7) AS brand FROM part)"


@query(_broken("key", _ATOMS, coordinates="k % 13 <> 0", res_type="p_size BETWEEN 0 AND 28", feature_length="k % 17 <> 0", feature_finite="k % 19 <> 0") + """
UNION ALL """ + _broken("key", "(SELECT ps AS src, dst, ps || '-' || dst AS key, t, (SELECT count(*) FROM part) AS n FROM (SELECT l_suppkey AS ps, l_partkey AS dst, l_linenumber AS t FROM lineitem))",
                        bond_order="src < dst", bond_range="src >= 0 AND dst < n", bond_type="t BETWEEN 0 AND 6"))
def receptor_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    feat = "transform(sequence(1, IF(p_partkey % 17 = 0, 48, 49)), i -> IF(p_partkey % 19 = 0 AND i = 3, double('nan'), double(i)))"
    atoms = _part(spark, sf_dir, "'1abc' AS pdb_id", "p_partkey AS row_idx", "IF(p_partkey % 13 = 0, double('inf'), 1D) AS x", "1D AS y", "1D AS z", "p_size AS res_type", "'CA' AS atom_name", f"{feat} AS feat")
    bonds = table(spark, sf_dir, "lineitem").selectExpr("'1abc' AS pdb_id", "l_suppkey AS src", "l_partkey AS dst", "l_linenumber AS bond_type")
    return gates.receptor_faults(atoms, bonds).drop("pdb_id")


@query("""
SELECT s_suppkey AS key, code FROM (SELECT s_suppkey, unnest([CASE WHEN s_suppkey % 4 = 0 OR s_suppkey % 9 = 0 THEN 'shape' END, CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 9 = 0 THEN 'voxel' END,
  CASE WHEN s_suppkey % 9 = 0 THEN 'origin' END]) AS code FROM supplier) WHERE code IS NOT NULL""")
def map_pair_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = ["10 AS ny", "12 AS nz", "1.5D AS vx", "1.5D AS vy", "0D AS ox", "0D AS oy", "0D AS oz"]
    left = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "8 AS nx", "1.5D AS vz", *one)
    right = table(spark, sf_dir, "supplier").where("s_suppkey % 9 <> 0").selectExpr("s_suppkey AS key", "IF(s_suppkey % 4 = 0, 9, 8) AS nx", "IF(s_suppkey % 5 = 0, 1.51D, 1.500001D) AS vz", *one)
    return gates.pair_faults(left, right, "key")


_HEADERS = "(SELECT c_custkey AS key FROM customer)"


@query(_broken("key", _HEADERS, geometry="key % 4 <> 0", scale="key % 5 <> 0", contour="key % 6 <> 0", contour_status="key % 7 <> 0", source_digest="key % 8 <> 0 AND key % 9 <> 0"))
def header_contract_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS key", "IF(c_custkey % 4 = 0, 0, 8) AS nx", "8 AS ny", "8 AS nz", "1D AS vx", "1D AS vy", "1D AS vz", "IF(c_custkey % 5 = 0, -1D, 0.5D) AS scale", "float(0.25) AS contour_native",
        "float(IF(c_custkey % 6 = 0, 7D, IF(c_custkey % 5 = 0, -1D, 0.5D) * 0.25D)) AS contour_canonical", "IF(c_custkey % 7 = 0, 'absent', 'ok') AS contour_status",
        "IF(c_custkey % 8 = 0, 'x', sha2(string(c_custkey), 256)) AS source_sha256",
    )
    now = table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "sha2(string(IF(c_custkey % 9 = 0, 0, c_custkey)), 256) AS sha256")
    return gates.header_faults(rows, now, "key")


@query("""
WITH v AS (SELECT p_size AS z, p_partkey % 40 AS y, p_partkey % 7 AS x, p_partkey AS k FROM part), d AS (SELECT DISTINCT z, y, x FROM v), r AS (SELECT DISTINCT z, y, x FROM v WHERE k % 10 <> 0)
SELECT z, y, x, 'range' AS code FROM v WHERE z > 39 UNION ALL SELECT z, y, x, 'duplicate_key' FROM v GROUP BY 1, 2, 3 HAVING count(*) > 1
UNION ALL SELECT z, y, x, 'rebuild' FROM (SELECT * FROM d EXCEPT SELECT * FROM r)""")
def mask_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _part(spark, sf_dir, "'1abc' AS pdb_id", "0L AS candidate_id", "p_size AS z", "p_partkey % 40 AS y", "p_partkey % 7 AS x", "p_partkey AS k")
    key = ["pdb_id", "candidate_id", "z", "y", "x"]
    grids = spark.range(1).selectExpr("'1abc' AS pdb_id", "40 AS nz", "40 AS ny", "7 AS nx")
    return gates.mask_faults(stored.select(*key), stored.where("k % 10 <> 0").select(*key).distinct(), grids).drop("pdb_id", "candidate_id")


@query("""
SELECT o_orderkey AS pdb_id, code FROM (SELECT o_orderkey, unnest([CASE WHEN o_orderkey % 6 = 0 THEN 'q_score' END, CASE WHEN o_orderkey % 10 = 3 THEN 'pocket_q_score' END,
  CASE WHEN o_orderkey % 7 = 0 THEN 'counts' END, CASE WHEN o_orderkey % 10 = 3 OR (o_orderkey % 7 = 0 AND o_orderkey % 5 = 0) THEN 'empty_pocket' END, CASE WHEN o_orderkey % 11 = 0 THEN 'pocket_status' END]) AS code FROM orders) WHERE code IS NOT NULL""")
def quality_row_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "o_orderkey"
    empty = f"{k} % 5 = 0"
    n = f"IF({k} % 7 = 0, 4, IF({empty}, 0, 3))"
    status = f"IF({n} > 0, 'ok', 'no_receptor_atoms_within_radius')"
    pocket = [f"IF({empty}, NULL, 0.5D) AS pocket_q_score{s}" for s in ("_median", "_min")]
    own = ["0.4D AS q_score_median", "0.3D AS q_score_min"]
    orders = table(spark, sf_dir, "orders")
    rows = orders.selectExpr(f"{k} AS pdb_id", "0L AS candidate_id", f"IF({k} % 6 = 0, 0.41D, 0.4D) AS q_score", *own, f"IF({empty} OR {k} % 10 = 3, NULL, 0.5D) AS pocket_q_score", *pocket, f"{n} AS pocket_n_atoms", f"IF({k} % 11 = 0, 'other', {status}) AS pocket_status")
    made = orders.selectExpr(f"{k} AS pdb_id", "0L AS candidate_id", "0.4D AS q_score", *own, f"IF({empty}, NULL, 0.5D) AS pocket_q_score", *pocket, f"IF({empty}, 0, 3) AS pocket_n_atoms")
    return gates.quality_faults(rows, made).drop("candidate_id")


@query("""
SELECT s_suppkey AS pdb_id, code FROM (SELECT s_suppkey, unnest([CASE WHEN s_suppkey % 3 = 0 THEN 'version' END, CASE WHEN s_suppkey % 5 = 0 THEN 'sigma' END]) AS code FROM supplier) WHERE code IS NOT NULL""")
def provenance_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS pdb_id", "IF(s_suppkey % 3 = 0, '1.0', '2.0') AS version", "IF(s_suppkey % 5 = 0, NULL, '0.4') AS sigma")
    return gates.provenance_faults(rows, {"version": "2.0", "sigma": "0.4"})


_EXCLUDED = "(SELECT s_suppkey AS k, 'a' || lpad(CAST(s_suppkey % 90 AS VARCHAR), 3, '0') AS pdb_id FROM supplier)"


@query(_broken("pdb_id", _EXCLUDED, schema_version="k % 8 <> 0", run_id="k % 7 <> 0", stages="k % 5 <> 0 AND k % 6 <> 0", reason="k % 9 <> 0", evidence="k % 11 <> 0")
       + f" UNION ALL SELECT pdb_id, 'duplicate_key' FROM {_EXCLUDED} GROUP BY 1 HAVING count(*) > 1")
def exclusion_record_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "s_suppkey"
    rows = table(spark, sf_dir, "supplier").selectExpr(
        f"IF({k} % 8 = 0, 2, 1) AS schema_version", f"concat('a', lpad({k} % 90, 3, '0')) AS pdb_id", f"IF({k} % 7 = 0, 'r2', 'r1') AS run_id",
        f"CASE WHEN {k} % 5 = 0 THEN CAST(array() AS ARRAY<STRING>) WHEN {k} % 6 = 0 THEN array('stage_d') ELSE array('stage_e') END AS stages", f"IF({k} % 9 = 0, ' ', 'slow') AS reason",
        "'d' AS detail", "'a' AS authorization", "'current_run_only' AS decision_scope", "'exclude_from_training_and_inference' AS downstream_policy", f"IF({k} % 11 = 0, map(), map('a', 'b')) AS evidence",
    )
    return gates.exclusion_faults(rows, "r1")


@query("""
SELECT s_suppkey AS pdb_id, CASE WHEN s_suppkey % 7 = 0 THEN 'base_row_missing' WHEN s_suppkey % 3 = 0 THEN 'addition_beyond_stage' ELSE 'base_row_changed' END AS code
FROM supplier WHERE (s_suppkey % 2 = 0 AND s_suppkey % 7 = 0) OR (s_suppkey % 2 = 0 AND s_suppkey % 5 = 0 AND s_suppkey % 7 <> 0 AND s_suppkey % 3 <> 0) OR (s_suppkey % 2 = 1 AND s_suppkey % 3 = 0 AND s_suppkey % 7 <> 0)""")
def additive_view_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS pdb_id", "array('stage_f') AS stages", "'r' AS reason")
    view = rows.where("pdb_id % 7 <> 0").selectExpr(
        "pdb_id", "IF(pdb_id % 2 = 1 AND pdb_id % 3 = 0, array('stage_e', 'stage_f'), stages) AS stages", "IF(pdb_id % 2 = 0 AND pdb_id % 5 = 0 AND pdb_id % 3 <> 0, 'other', reason) AS reason"
    )
    return gates.additive_faults(rows.where("pdb_id % 2 = 0"), view, "stage_f")


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS pdb_id, CASE WHEN s_suppkey % 4 = 0 THEN 'not_waived' WHEN s_suppkey % 5 = 0 THEN 'not_unknown' ELSE 'digest' END AS code FROM supplier
WHERE (s_suppkey % 4 = 0) <> (s_suppkey % 5 = 0) OR (s_suppkey % 4 <> 0 AND s_suppkey % 5 <> 0 AND s_suppkey % 7 = 0)
UNION ALL SELECT NULL, 'cap'""")
def waiver_manifest_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").selectExpr("string(s_suppkey) AS pdb_id", "s_suppkey AS k", "sha2(string(s_suppkey), 256) AS status_sha256")
    waived = rows.where("k % 4 <> 0").withColumn("status_sha256", F.expr("IF(k % 7 = 0, 'x', status_sha256)"))
    return gates.waiver_faults(spark.range(1).selectExpr("3L AS cap"), waived.select("pdb_id", "status_sha256"), rows.where("k % 5 <> 0"), 2)


@query("""
SELECT c_custkey AS pdb_id, CASE WHEN c_custkey % 4 = 0 THEN 'REBUILD' WHEN c_custkey % 3 = 0 THEN 'UPGRADE' ELSE 'COMPLETE' END AS state FROM customer""")
def artifact_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes = [f"true AS {c}" for c in ("has_occurrences", "has_receptor_base", "has_features", "has_centroids")]
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey AS pdb_id", "c_custkey % 4 <> 0 AS has_coords", "c_custkey % 3 <> 0 AS has_descriptors", *yes)
    return gates.artifact_state(rows).select("pdb_id", "state")


@query("""
SELECT c_custkey AS pid, CASE c_custkey % 4 WHEN 0 THEN 'stage' WHEN 1 THEN 'recovery' WHEN 2 THEN 'opaque' END AS category, c_custkey % 4 <> 3 AND c_custkey <> 8 AS blocked FROM customer""")
def process_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import hashlib

    args = "CASE c_custkey % 4 WHEN 0 THEN array('python', '/x/run_stage.py') WHEN 1 THEN array('/y/recover.py') WHEN 2 THEN array('python3', '-') ELSE array('ls', 'run_stage.pyc') END"
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey AS pid", "1 AS ppid", "5 AS start_ticks", f"{args} AS args")
    digest = hashlib.sha256(b"python\x00/x/run_stage.py").hexdigest()
    return gates.process_rows(rows, "run_stage.py", "recover.py", (8, 1, 5, digest)).select("pid", "category", "blocked")


@query(f"""
SELECT a.l_orderkey, a.l_partkey AS src, b.l_partkey AS dst, a.l_returnflag || b.l_returnflag AS type FROM {LINES} a JOIN {LINES} b
ON a.l_orderkey = b.l_orderkey AND a.l_linestatus = b.l_linestatus AND (a.l_returnflag, b.l_returnflag) IN (('A', 'R'), ('N', 'A'))""")
def template_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    atoms = lines(spark, sf_dir).selectExpr("l_orderkey", "l_linestatus AS comp", "l_returnflag AS atom", "l_partkey AS idx")
    template = spark.sql("SELECT * FROM VALUES ('F','A','R','AR'),('O','A','R','AR'),('F','N','A','NA'),('O','N','A','NA'),('F','X','A','XA') AS t(comp, atom_1, atom_2, type)")
    return joins.template_edges(atoms, template, ["l_orderkey"])


@query("""
SELECT a.o_custkey AS asym_id, a.o_orderkey AS src, b.o_orderkey AS dst FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey
WHERE a.o_orderstatus = 'O' AND b.o_orderstatus = 'F' AND a.o_custkey % 2 = 0""")
def branch_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    atoms = orders.selectExpr("o_custkey AS asym_id", "'NAG' AS mon_id", "IF(o_orderstatus = 'O', 1, IF(o_orderstatus = 'F', 2, 3)) AS num", "'C1' AS atom", "o_orderkey AS idx")
    scheme = orders.where("o_custkey % 2 = 0").select(F.lit(1).alias("entity_id"), F.col("o_custkey").alias("asym_id")).distinct().selectExpr("entity_id", "asym_id", "explode(array(1, 2)) AS num", "'NAG' AS mon_id")
    links = spark.sql("SELECT * FROM VALUES (1, 1, 2, 'C1', 'C1'), (1, 1, 9, 'C1', 'C1') AS t(entity_id, num_1, num_2, atom_1, atom_2)")
    return joins.branch_edges(links, scheme, atoms)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 10)")
def polymer_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    atoms = _part(spark, sf_dir, "p_partkey AS l_partkey", "IF(p_size < 10, 'polymer', 'branched') AS entity_type")
    return joins.partner_is_polymer(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), atoms, ["l_partkey"]).drop("l_partkey")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5)")
def covalent_residues(spark: SparkSession, sf_dir: str) -> DataFrame:
    polymer = table(spark, sf_dir, "supplier").where("s_nationkey < 5").selectExpr("s_suppkey AS l_suppkey")
    return graph.covalent(table(spark, sf_dir, "lineitem"), polymer, ["l_orderkey", "l_linenumber"], "l_suppkey")


@query("""
SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN 'missing' WHEN p_partkey % 5 = 0 THEN 'identity' ELSE 'coordinates' END AS code FROM part WHERE p_partkey % 7 = 0 OR p_partkey % 5 = 0 OR p_partkey % 3 = 0
UNION ALL SELECT -p_partkey - 1, 'extra' FROM part WHERE p_partkey % 11 = 0""")
def score_output_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _part(spark, sf_dir, "p_partkey AS id", "p_brand AS comp", "p_retailprice AS Cartn_x", "1D AS Cartn_y", "2D AS Cartn_z")
    output = model.where("id % 7 <> 0").selectExpr("id", "IF(id % 5 = 0, 'x', comp) AS comp", "IF(id % 3 = 0, Cartn_x + 0.01D, Cartn_x) AS Cartn_x", "Cartn_y", "Cartn_z")
    extra = model.where("id % 11 = 0").withColumn("id", -F.col("id") - 1)
    return joins.q_against_model(model, output.unionByName(extra), ["comp"])


@query("SELECT 'EMD-' || o_custkey AS emdb_id, CAST(o_orderkey AS VARCHAR) AS pdb_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders WHERE o_custkey % 3 = 0")
def audited_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("concat('EMD-', o_custkey) AS emdb_id", "string(o_orderkey) AS pdb_id", "o_orderstatus AS status", "o_custkey % 3 = 0 AS audited")
    return joins.audited_entries(orders.where("audited").select("emdb_id").distinct(), joins.pair_index(orders), orders.where("status <> 'P'"))


@query(f"""
WITH a AS (SELECT l_orderkey, candidate_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY candidate_id, i) - 1 AS row_idx, i FROM {LINES}, (SELECT unnest([0, 1, 2]) AS i))
SELECT a.l_orderkey, CAST(a.row_idx AS INTEGER) AS atom_1, CAST(b.row_idx AS INTEGER) AS atom_2, 'double' AS type FROM a JOIN a b USING (l_orderkey, candidate_id) WHERE a.i = 0 AND b.i = 2
UNION ALL SELECT a.l_orderkey, CAST(a.row_idx AS INTEGER), CAST(b.row_idx AS INTEGER), 'single' FROM a JOIN a b ON a.l_orderkey = b.l_orderkey AND b.candidate_id = a.candidate_id + 1 WHERE a.i = 1 AND b.i = 0""")
def assembled_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = lines(spark, sf_dir).select("l_orderkey", F.col("candidate_id").alias("residue_id"))
    atoms = each.selectExpr("l_orderkey", "residue_id", "explode(array(0, 1, 2)) AS comp_row").withColumn("atom_name", F.concat(F.lit("C"), "comp_row"))
    bonds = each.selectExpr("l_orderkey", "residue_id", "0 AS atom_1", "2 AS atom_2", "'double' AS type")
    links = each.where("residue_id > 0").selectExpr("l_orderkey", "residue_id - 1 AS res_i", "'C1' AS atom_i", "residue_id AS res_j", "'C0' AS atom_j")
    return graph.assemble(atoms, bonds, links, "l_orderkey")[1]


@query("SELECT p_partkey AS key, CASE WHEN p_partkey % 3 = 0 THEN 'there' ELSE 'made' END AS value FROM part")
def filled_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _part(spark, sf_dir, "p_partkey AS key")
    there = keys.where("key % 3 = 0").withColumn("value", F.lit("there"))
    return graph.fill_missing(keys.union(keys), there, lambda todo: todo.withColumn("value", F.lit("made")), "key")


@query("""
WITH t AS (SELECT p_brand AS comp, p_type AS atom, count(*) AS n, min(CASE WHEN p_size > 3 THEN p_size ELSE 0 END) AS element FROM part WHERE p_size < 20 GROUP BY 1, 2)
SELECT comp, atom, CASE WHEN n > 1 THEN 'duplicate_name' ELSE 'invalid_element' END AS code FROM t WHERE n > 1 OR element <= 0
UNION ALL SELECT DISTINCT p_brand, p_type, 'not_in_template' FROM part WHERE (p_brand, p_type) NOT IN (SELECT (comp, atom) FROM t)""")
def component_map_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _part(spark, sf_dir, "p_brand AS comp", "p_type AS atom", "IF(p_size > 3, p_size, 0) AS element", "p_size")
    return graph.component_faults(rows, rows.where("p_size < 20"))


@query("""
SELECT s_suppkey AS worker, CASE WHEN s_suppkey % 4 = 0 THEN 'not_authorized' WHEN s_suppkey % 5 = 0 THEN 'several' ELSE 'other_manifest' END AS code FROM supplier WHERE s_suppkey % 4 = 0 OR s_suppkey % 5 = 0 OR s_suppkey % 3 = 0""")
def launch_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS worker")
    given = workers.where("worker % 4 <> 0").selectExpr("worker", "IF(worker % 3 = 0, 'm2', 'm1') AS manifest_sha256", "explode(IF(worker % 5 = 0, array('a', 'b'), array('a'))) AS kind")
    return repair.launch_faults(spark.range(1).selectExpr("'m1' AS sha256"), given, workers)


@query("""
WITH t AS (SELECT o_orderkey AS pdb_id, (row_number() OVER (ORDER BY o_orderkey) - 1) % 8 AS part FROM orders WHERE o_orderstatus <> 'P'),
  r AS (SELECT pdb_id, CASE WHEN pdb_id % 9 = 0 THEN (part + 1) % 8 ELSE part END AS part FROM t WHERE pdb_id % 7 <> 0)
SELECT part, pdb_id, CAST(count(*) FILTER (s = 'r') AS BIGINT) AS n_left, CAST(count(*) FILTER (s = 't') AS BIGINT) AS n_right
FROM (SELECT part, pdb_id, 'r' AS s FROM r UNION ALL SELECT part, pdb_id, 't' FROM t) GROUP BY 1, 2 HAVING n_left <> 1 OR n_right <> 1""")
def migration_part_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS pdb_id", "IF(o_orderstatus <> 'P', 'success', 'known_failed') AS status")
    targets = repair.frozen_targets(rows, [F.col("pdb_id")], 8)
    done = targets.where("pdb_id % 7 <> 0").selectExpr("pdb_id", "int(IF(pdb_id % 9 = 0, (part + 1) % 8, part)) AS part")
    return repair.part_faults(targets, done)


@query("""
SELECT c_custkey AS key, CASE WHEN c_custkey % 6 = 0 THEN -1.0 ELSE c_acctbal END AS value, 'right' AS side FROM customer WHERE c_custkey % 6 = 0
UNION ALL SELECT c_custkey, c_acctbal, 'left' FROM customer WHERE c_custkey % 6 = 0 OR c_custkey % 10 = 1""")
def base_array_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "double(c_acctbal) AS value")
    after = before.where("key % 10 <> 1").selectExpr("key", "IF(key % 6 = 0, -1D, value) AS value")
    return repair.unchanged(before, after)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL")
def covered_pockets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'")
    by = lambda c: rows.groupBy("l_orderkey", "l_linenumber").agg(c)
    return joins.covered_join(by(F.count("*").alias("n")), by(F.sum("l_quantity").alias("q")), ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F'")
def heavy_atom_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "IF(l_linestatus = 'F', 'atom', 'HETATM') AS group_PDB", "CASE l_returnflag WHEN 'N' THEN 'd' WHEN 'A' THEN 'C' ELSE 'O' END AS element")
    return S.heavy(S.atom_only(rows), "element").select("l_orderkey", "l_linenumber")


@query("""
SELECT has_transient, has_outputs, count(*) AS n, CAST(sum(blocks) * 512 AS BIGINT) AS allocated FROM (
  SELECT l_orderkey % 10 AS run, l_suppkey AS pdb_id, l_linenumber AS attempt, bool_or(l_returnflag = 'R') AS has_transient, sum(CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE 0 END) AS blocks, l_suppkey % 3 = 0 AS has_outputs
  FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def scratch_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey % 10 AS run", "l_suppkey AS pdb_id", "l_linenumber AS attempt", "l_returnflag = 'R' AS transient", "l_partkey AS blocks")
    return repair.attempts(files, table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").selectExpr("s_suppkey AS pdb_id"))
