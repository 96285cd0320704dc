"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.functions import chemistry, geometry, metadata, text
from voxelforge.functions import fixed as X
from voxelforge.plans.carriers import EVENTS, events
from voxelforge.plans.registry import query
from voxelforge.session import table


@query("SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g') AS name FROM pages")
def safe_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.safe_file_name(F.col("url")).alias("name"))


@query("""
WITH c AS (SELECT conv_id, string_agg(upper(role), '-' ORDER BY turn) AS names, count(*) AS n, min(upper(role)) AS one FROM conversations GROUP BY conv_id),
  b AS (SELECT a.conv_id, '[' || coalesce(string_agg('[' || a.turn || ', "O4", ' || b.turn || ', "C1"]', ', ' ORDER BY a.turn), '') || ']' AS bonds
        FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 GROUP BY a.conv_id)
SELECT conv_id, CASE WHEN n = 1 THEN 'CCD:' || one ELSE 'BRANCHED:' || names || ':' || substr(md5(coalesce(bonds, '[]')), 1, 6) END AS key FROM c LEFT JOIN b USING (conv_id)""")
def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.upper("role").alias("role"))
    after = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("turn").alias("next"))
    bond = F.struct(F.col("turn").alias("res_i"), F.lit("O4").alias("atom_i"), F.col("next").alias("res_j"), F.lit("C1").alias("atom_j"))
    bonds = rows.join(after, ["conv_id", "turn"]).groupBy("conv_id").agg(F.collect_list(bond).alias("bonds"))
    names = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda r: r["role"])
    none = F.array().cast("array<struct<res_i:bigint,atom_i:string,res_j:bigint,atom_j:string>>")
    told = rows.groupBy("conv_id").agg(names.alias("names")).join(bonds, "conv_id", "left").withColumn("bonds", F.coalesce("bonds", none))
    return told.select("conv_id", text.object_key(F.col("names"), F.col("bonds")).alias("key"))


@query("SELECT item_id, sha256(text) AS sha256, regexp_matches(sha256(text), '^[0-9a-f]{64}$') AS ok FROM benchmark")
def text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "benchmark").select("item_id", text.sha256(F.col("text")).alias("sha256"))
    return told.withColumn("ok", text.is_sha256(F.col("sha256")))


@query("""
SELECT n_regionkey, sha256('{' || string_agg('"' || n_name || '":"' || md5(n_name) || '"', ',' ORDER BY n_name) || '}') AS sha256 FROM nation GROUP BY n_regionkey""")
def manifest_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_name")).alias("n"))
    return by.select("n_regionkey", text.manifest_sha256(F.col("n"), F.transform("n", F.md5)).alias("sha256"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 4 = 1 THEN p_brand WHEN p_partkey % 4 = 2 THEN 'C1''' ELSE '' END AS value FROM part""")
def clean_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    raw = F.when(k == 0, "?").when(k == 1, F.concat(F.lit("'"), "p_brand", F.lit("'"))).when(k == 2, "\"C1'\"")
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_value(raw).alias("value"))


@query("SELECT p_partkey, list_aggregate(list_transform(range(1, 5), lambda i: CASE WHEN i <= length(n) THEN ascii(substr(n, i, 1)) - 32 ELSE 0 END), 'string_agg', ',') AS codes FROM (SELECT p_partkey, substr(p_brand, 1, 4) AS n FROM part)")
def atom_name_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = text.atom_name_codes(F.substring("p_brand", 1, 4))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(codes, lambda c: c.cast("string")), ",").alias("codes"))




@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 5) * 86400 ELSE 0 END + (o_orderkey % 24) * 3600 + (o_orderkey % 60) * 60 + o_custkey % 60 END AS seconds FROM orders""")
def elapsed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = lambda c, n: F.lpad((F.col(c) % n).cast("string"), 2, "0")
    day = F.when(F.col("o_orderkey") % 2 == 0, F.concat((F.col("o_orderkey") % 5).cast("string"), F.lit("-"))).otherwise("")
    said = F.when(F.col("o_orderkey") % 9 == 0, "1:75:00").otherwise(F.concat(day, F.concat_ws(":", two("o_orderkey", 24), two("o_orderkey", 60), two("o_custkey", 60))))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.elapsed_seconds(said).alias("seconds"))


_RESIDUES = ["ALA", "MSE", "DA", "XYZ", "HIP", "DG", "U", "TPO", "val", " gly ", "PSU", "CYX"]
_CLASSES = [0, 12, 24, 28, 8, 26, 23, 16, 19, 7, 28, 4]
_FEATURES = ["ALA", "MET", "A", "XYZ", "HIS", "G", "U", "THR", "VAL", "GLY", "U", "CYS"]


@query(f"""
SELECT p_partkey, ([{", ".join(map(str, _CLASSES))}])[CAST(p_partkey % 12 AS INTEGER) + 1] AS class, ([{", ".join(f"'{f}'" for f in _FEATURES)}])[CAST(p_partkey % 12 AS INTEGER) + 1] AS feature,
  CASE WHEN p_partkey % 12 IN (2, 5, 6) THEN p_size % 2 = 0 ELSE p_size % 2 = 1 END AS backbone FROM part""")
def residue_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    comp = F.get(F.array(*[F.lit(r) for r in _RESIDUES]), (F.col("p_partkey") % 12).cast("int"))
    atom = F.when(F.col("p_size") % 2 == 0, "P").otherwise("CA")
    return table(spark, sf_dir, "part").select(
        "p_partkey", chemistry.residue_class(comp).alias("class"), chemistry.feature_residue(comp).alias("feature"), chemistry.is_backbone(comp, atom).alias("backbone")
    )


@query("""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'sugar' WHEN p_size % 6 = 0 THEN 'sugar' WHEN p_size % 6 = 1 THEN 'peptide_like' WHEN p_size % 6 = 2 THEN 'nucleotide_like'
  WHEN p_partkey % 2 = 0 THEN 'ion' WHEN p_size % 6 IN (3, 4) THEN 'small_molecule' ELSE 'other' END AS tag FROM part""")
def type_tag_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size") % 6
    types = (
        F.when(k == 0, F.array(F.lit("D-saccharide"), F.lit("L-SACCHARIDE"))).when(k == 1, F.array(F.lit("NON-POLYMER"), F.lit("L-peptide linking")))
        .when(k == 2, F.array(F.lit("RNA linking"), F.lit("NON-POLYMER"))).when(k == 5, F.array().cast("array<string>")).otherwise(F.array(F.lit("non-polymer")))
    )
    tag = chemistry.type_tag(F.col("p_size") % 7 == 0, F.lit(1), F.when(F.col("p_partkey") % 2 == 0, "ZN").otherwise("C"), types)
    return table(spark, sf_dir, "part").select("p_partkey", tag.alias("tag"))


_ELEMENTS = ["C", "N", "O", "S", "P", "FE"]


@query(f"""
SELECT p_partkey, 49 AS n, p_partkey % 6 AS element, 6 + CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 21 ELSE 24 END AS residue,
  round(([{", ".join(str(X.MASSES.get(e, X.OTHER_MASS)) for e in _ELEMENTS)}])[CAST(p_partkey % 6 AS INTEGER) + 1] / 32, 5) AS mass, round(ln(1 + p_size), 4) AS shell FROM part""")
def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = F.get(F.array(*[F.lit(e) for e in _ELEMENTS]), (F.col("p_partkey") % 6).cast("int"))
    comp = F.get(F.array(F.lit("ALA"), F.lit("DT"), F.lit("LIG")), (F.col("p_partkey") % 3).cast("int"))
    told = table(spark, sf_dir, "part").select("p_partkey", "p_size", chemistry.features(element, comp, F.array(*[F.col("p_size")] * 9)).alias("f"))
    first = lambda lo, n: F.array_position(F.slice("f", lo + 1, n), 1.0) + lo - 1
    return told.select("p_partkey", F.size("f").alias("n"), first(0, 6).alias("element"), first(6, 25).alias("residue"), F.round(F.get("f", F.lit(39)).cast("double"), 5).alias("mass"), F.round(F.get("f", F.lit(48)).cast("double"), 4).alias("shell"))


_H = "(CASE WHEN h % 2 = 0 THEN h WHEN abs(n * v / (h + 1) - 1) < abs(n * v / (h - 1) - 1) THEN h + 1 ELSE h - 1 END)"


@query(f"""
WITH a AS (SELECT p_partkey, unnest([1, 2, 3]) AS axis, p_size FROM part),
b AS (SELECT *, CASE axis WHEN 1 THEN p_size + 2 WHEN 2 THEN p_size + 3 ELSE p_partkey % 50 + 2 END AS len, CASE axis WHEN 1 THEN CAST(2.0 AS DOUBLE) WHEN 2 THEN CAST(1.5 AS DOUBLE) ELSE CAST(1.2 AS DOUBLE) END AS v FROM a),
c AS (SELECT *, len + len % 2 AS n FROM b), d AS (SELECT *, CAST(ceil(n * v / 1) AS BIGINT) AS h FROM c), e AS (SELECT *, {_H} AS m FROM d)
SELECT p_partkey, string_agg(CAST(m AS VARCHAR), 'x' ORDER BY axis) AS out, CASE WHEN bool_and(n = m) THEN 'all_equal' WHEN bool_and(n <> m) THEN 'all_diff' ELSE 'mixed' END AS mode,
  round(CAST(product(n) AS DOUBLE) / product(m), 6) AS scale, max(len % 2) FILTER (axis = 1) <> max(len % 2) FILTER (axis = 3) AS moved FROM e GROUP BY p_partkey""")
def resample_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = F.array(F.col("p_size").cast("long") + 2, F.col("p_size").cast("long") + 3, F.col("p_partkey") % 50 + 2)
    voxel = F.array(F.lit(1.2), F.lit(1.5), F.lit(2.0))
    got = table(spark, sf_dir, "part").select("p_partkey", geometry.canonical(shape, voxel, F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)), 1.0).alias("g"))
    return got.select("p_partkey", F.array_join(F.transform("g.out", lambda n: n.cast("string")), "x").alias("out"), "g.mode", F.round("g.scale", 6).alias("scale"), "g.moved")


@query("""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '30,20,10' WHEN 1 THEN '20,30,10' WHEN 2 THEN '30,10,20' WHEN 3 THEN '20,10,30' WHEN 4 THEN '10,30,20' ELSE '10,20,30' END AS shape FROM part""")
def axis_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [(1, 2, 3), (1, 3, 2), (2, 1, 3), (2, 3, 1), (3, 1, 2), (3, 2, 1)]
    k = F.col("p_partkey") % 6
    axis = [F.get(F.array(*[F.lit(o[i]) for o in order]), k.cast("int")) for i in range(3)]
    stored = F.array(F.lit(30), F.lit(20), F.lit(10))  # sections, rows, columns
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(geometry.to_zyx(stored, *axis), lambda n: n.cast("string")), ",").alias("shape"))


_CONTOUR_STATUS = ["missing_map_section", "missing_contour_list", "invalid_contour_container", "missing_primary_contour", "ambiguous_primary_contour", "invalid_primary_level", "nonfinite_primary_level", "ok"]
_CONTOUR_JSON = [
    "{}", '{"map":{}}', '{"map":{"contour_list":{"contour":5}}}', '{"map":{"contour_list":{"contour":[{"level":1,"primary":false}]}}}',
    '{"map":{"contour_list":{"contour":[{"level":1,"primary":true},{"level":2,"primary":"Yes"}]}}}', '{"map":{"contour_list":{"contour":{"level":"high","primary":1}}}}',
    '{"map":{"contour_list":{"contour":{"level":"NaN","primary":"true"}}}}', '{"map":{"contour_list":{"contour":[{"level":"0.02","primary":true,"source":"AUTHOR"}]}}}',
]


@query(f"""
SELECT event_id, ([{", ".join(f"'{s}'" for s in _CONTOUR_STATUS)}])[CAST(event_id % 8 AS INTEGER) + 1] AS status, CASE WHEN event_id % 8 = 7 THEN CAST(0.02 AS DOUBLE) END AS level,
  CASE WHEN event_id % 8 = 7 THEN 'AUTHOR' END AS source FROM events""")
def json_contour(spark: SparkSession, sf_dir: str) -> DataFrame:
    json = F.get(F.array(*[F.lit(j) for j in _CONTOUR_JSON]), (F.col("event_id") % 8).cast("int"))
    return events(spark, sf_dir).select("event_id", metadata.recommended_contour(json).alias("c")).select("event_id", "c.status", "c.level", "c.source")


_EMDB = ['{"r":[2.4]}', '{"r":[2.7,3.1]}', "{}", '{"r":"2.5"}', '{"r":2.6}', "{}"]
_RCSB = ['{"r":2.4}', '{"r":[2.4]}', '{"r":[3.3]}', "{}", '{"r":["3.0","x"]}', '{"r":null}']
_CHOICE = [("2.4", "multi_candidate_consistent", 2, 1), ("2.7", "ambiguous_emdb", 3, 3), ("3.3", "fallback_rcsb", 1, 1), ("2.5", "single_unique", 1, 1), ("2.6", "rcsb_disagree", 2, 2), ("NULL", "missing", 0, 0)]


def _resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda js: F.get(F.array(*[F.lit(j) for j in js]), (F.col("event_id") % 6).cast("int"))
    choice = metadata.resolution(metadata.numbers_at(pick(_EMDB), "$.r"), metadata.numbers_at(pick(_RCSB), "$.r"))
    return events(spark, sf_dir).select("event_id", choice.alias("c")).select("event_id", "c.*")


@query(f"""
SELECT event_id, CASE event_id % 6 {" ".join(f"WHEN {i} THEN CAST({c[0]} AS DOUBLE)" for i, c in enumerate(_CHOICE))} END AS selected,
  CASE event_id % 6 {" ".join(f"WHEN {i} THEN '{c[1]}'" for i, c in enumerate(_CHOICE))} END AS status,
  CASE event_id % 6 {" ".join(f"WHEN {i} THEN {c[2]}" for i, c in enumerate(_CHOICE))} END AS n_candidates,
  CASE event_id % 6 {" ".join(f"WHEN {i} THEN {c[3]}" for i, c in enumerate(_CHOICE))} END AS n_unique FROM events""")
def resolution_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolutions(spark, sf_dir).select("event_id", "selected", "status", "n_candidates", "n_unique")


@query("""
WITH e AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'multi_candidate_consistent' WHEN 1 THEN 'ambiguous_emdb' WHEN 2 THEN 'fallback_rcsb' WHEN 3 THEN 'single_unique' WHEN 4 THEN 'rcsb_disagree' ELSE 'missing' END AS status FROM events),
f AS (SELECT * FROM e UNION ALL SELECT event_id, 'rcsb_disagree' FROM e WHERE status = 'ambiguous_emdb'),
g AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY event_id) AS i FROM f)
SELECT status, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) FILTER (i <= 10) AS examples FROM g GROUP BY status""")
def resolution_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = metadata.resolution_summary(_resolutions(spark, sf_dir), "event_id")
    return got.select("status", "n", F.array_join(F.transform("examples", lambda e: e.cast("string")), ",").alias("examples"))


@query(f"""
SELECT event_id, CASE WHEN k % 4 = 0 THEN '0' WHEN k % 4 = 1 THEN '1,4' ELSE '' END AS codes, CASE WHEN k % 4 = 3 THEN round(k / 100, 6) END AS plain, CASE WHEN k % 4 = 3 THEN round(-k / 200, 6) END AS about_mean FROM {EVENTS}""")
def tool_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k") % 4
    cc = F.concat(F.lit("BEGIN\ncorrelation = "), F.col("k") / 100, F.lit(", correlation about mean = "), -F.col("k") / 200, F.lit("\nEND\n"))
    benign = "Error processing trigger \"monitor changes\":\nKeyError: '?'\n"
    log = F.when(k == 0, "Traceback (most recent call last):").when(k == 1, "x\nERROR: no such file").when(k == 2, benign).otherwise(cc)
    told = events(spark, sf_dir).select("event_id", log.alias("log")).withColumn("cc", text.correlations(F.col("log"), "BEGIN", "END"))
    return told.select("event_id", F.array_join(F.transform(text.fatal_matches(F.col("log")), lambda c: c.cast("string")), ",").alias("codes"), F.round("cc.plain", 6).alias("plain"), F.round("cc.about_mean", 6).alias("about_mean"))


@query("""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'map' WHEN 1 THEN 'cif_tmp' WHEN 2 THEN NULL ELSE 'mrc' END AS kind, page_id % 3 > 0 AS in_scope FROM pages""")
def file_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    name = F.when(k == 0, "a/X.MAP").when(k == 1, "x.cif.tmp.12").when(k == 2, "x.map.gz").otherwise("y.mrc")
    path = F.when(F.col("page_id") % 3 == 0, F.when(F.col("page_id") % 2 == 0, "/abs/x").otherwise("a/../b")).otherwise("a/b..c/d")
    return table(spark, sf_dir, "pages").select("page_id", text.transient_type(name).alias("kind"), text.path_in_scope(path).alias("in_scope"))
