"""The map filter, distributions, statuses and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.operators import gates, joins, quality
from voxelforge.operators import select as S
from voxelforge.plans.carriers import EVENTS, LINES, OCCURRENCES, events, lines, occurrences
from voxelforge.plans.registry import query
from voxelforge.session import table

CONFIG = quality.FilterConfig.of(
    {
        "schema_version": 2, "cc_field": "cc_all_about_mean", "cc_min": -0.5, "resolution_max": 250000.0, "resolution_comparison": "inclusive",
        "ligand_q_min": 0.3, "pocket_q_min": 0.3, "qualified_pair_fraction_min": 0.25, "empty_pocket": "fail_and_count_denominator",
        "keep_only_maps_that_pass": True, "keep_all_occurrences_in_passing_map": True,
    }
)
_MAPS = f"""SELECT pdb_id, count(*) AS n_pairs, count(*) FILTER (q_score > CAST(0.3 AS DOUBLE) AND coalesce(pocket_q_score > CAST(0.3 AS DOUBLE), false)) AS n_pass,
  count(*) FILTER (pocket_q_score IS NULL) AS n_empty, max(cc_all_about_mean) AS cc, max(map_resolution) AS resolution FROM {OCCURRENCES} GROUP BY pdb_id"""


@query(f"""
WITH o AS {OCCURRENCES}, g AS ({_MAPS})
SELECT o.pdb_id, o.candidate_id FROM o JOIN g USING (pdb_id)
WHERE cc >= CAST(-0.5 AS DOUBLE) AND resolution <= 250000 AND n_pass / n_pairs >= CAST(0.25 AS DOUBLE)""")
def map_filter_keep_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keep_list(occurrences(spark, sf_dir), CONFIG)


@query(f"""
SELECT pdb_id, n_pairs, n_pass, n_empty, round(n_pass / n_pairs, 6) AS fraction,
  concat_ws(',', CASE WHEN cc < CAST(-0.5 AS DOUBLE) THEN 'selected_cc_below_min' END, CASE WHEN resolution > 250000 THEN 'resolution_above_max' END,
    CASE WHEN n_pass / n_pairs < CAST(0.25 AS DOUBLE) THEN 'qualified_pair_fraction_below_min' END) AS reasons
FROM ({_MAPS})""")
def map_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.map_diagnostics(occurrences(spark, sf_dir), CONFIG).select(
        "pdb_id", "n_pairs", "n_pass", "n_empty", F.round("fraction", 6).alias("fraction"), F.array_join("reasons", ",").alias("reasons")
    )


@query(f"""
SELECT pdb_id, candidate_id, concat_ws(',', CASE WHEN NOT q_score > CAST(0.3 AS DOUBLE) THEN 'ligand_q_not_strictly_above_min' END,
  CASE WHEN pocket_q_score IS NULL THEN 'empty_pocket' WHEN NOT pocket_q_score > CAST(0.3 AS DOUBLE) THEN 'pocket_q_not_strictly_above_min' END) AS reasons
FROM {OCCURRENCES}""")
def pair_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reasons = quality.pair_reasons(F.col("q_score"), F.col("pocket_q_score"), 0.3, 0.3)
    return occurrences(spark, sf_dir).select("pdb_id", "candidate_id", F.array_join(reasons, ",").alias("reasons"))


_Q = [0.0, 0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]


@query(f"""
SELECT l_returnflag, count(l_extendedprice) AS n_finite, count(*) - count(l_extendedprice) AS n_null,
  {", ".join(f"round(quantile_cont(l_extendedprice, {q}), 4) AS q{i}" for i, q in enumerate(_Q))} FROM lineitem GROUP BY l_returnflag""")
def quality_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.distribution(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return got.select("l_returnflag", "n_finite", "n_null", *[F.round(F.get("quantiles", F.lit(i)), 4).alias(f"q{i}") for i in range(len(_Q))])


@query("""
SELECT l_linestatus, count(*) AS n, count(*) FILTER (v < 1) AS n_less, count(*) FILTER (v = 1) AS n_equal, count(*) FILTER (v > 1) AS n_greater,
  round(min(v), 6) AS min, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.95), 6) AS p95, round(avg(v), 6) AS mean, round(max(v), 6) AS max
FROM (SELECT l_linestatus, l_tax * CAST(25 AS DOUBLE) AS v FROM lineitem) GROUP BY l_linestatus""")
def distribution_against_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_linestatus", (F.col("l_tax") * F.lit(25.0)).alias("v"))
    got = quality.against_one(rows, "v", ["l_linestatus"])
    return got.select("l_linestatus", "n", "n_less", "n_equal", "n_greater", *[F.round(c, 6).alias(c) for c in ("min", "median", "p95", "mean", "max")])


@query("""
SELECT s.c_custkey AS key, coalesce(n, 0) AS n, coalesce(total, 0) AS sum, round(coalesce(median, 0), 4) AS median, coalesce(most, 0) AS max
FROM customer s LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_orderkey) AS total, quantile_cont(o_orderkey, 0.5) AS median, max(o_orderkey) AS most FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def value_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    got = quality.summary(orders, "o_orderkey", ["c_custkey"])
    return got.select(F.col("c_custkey").alias("key"), "n", "sum", F.round("median", 4).alias("median"), "max")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def categorical_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.counts(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(f"""
SELECT o_orderkey, round(avg(l_extendedprice), 6) AS q, round(CAST(CAST(median(l_extendedprice) AS FLOAT) AS DOUBLE), 4) AS q_median, min(l_extendedprice) AS q_min, count(l_extendedprice) AS q_n,
  CASE WHEN count(l_extendedprice) > 0 THEN 'ok' ELSE 'no_receptor_atoms_within_radius' END AS status
FROM orders LEFT JOIN (SELECT l_orderkey, l_extendedprice FROM {LINES} WHERE l_linestatus = 'F') ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def q_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lines(spark, sf_dir).where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("q"))
    told = quality.score_rows(table(spark, sf_dir, "orders").select("o_orderkey"), scores, ["o_orderkey"], "q")
    return told.select(
        "o_orderkey", F.round("q", 6).alias("q"), F.round(F.col("q_median").cast("double"), 4).alias("q_median"), "q_min", "q_n", quality.pocket_status(F.col("q_n")).alias("status")
    )


@query(f"""
WITH e AS (SELECT user_id, value AS a, lead(value) OVER (PARTITION BY user_id ORDER BY event_id) AS b, user_id % 40 + 20.0 AS level FROM {EVENTS}),
  m AS (SELECT * FROM e WHERE b IS NOT NULL AND a <> 0), k AS (SELECT user_id FROM m GROUP BY 1 HAVING count(*) > 2 AND count(*) FILTER (a >= level) > 2)
SELECT user_id, round(sum(a * b) / sqrt(sum(a * a) * sum(b * b)), 6) AS cc_all, round(corr(a, b), 6) AS cc_all_about_mean,
  round(sum(a * b) FILTER (a >= level) / sqrt(sum(a * a) FILTER (a >= level) * sum(b * b) FILTER (a >= level)), 6) AS cc_contour, round(corr(a, b) FILTER (a >= level), 6) AS cc_contour_about_mean
FROM m WHERE user_id IN (SELECT user_id FROM k) GROUP BY user_id""")
def cc_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.next_in_chain(events(spark, sf_dir), ["user_id"], [F.col("event_id")], ["value"]).where("next_value IS NOT NULL AND value <> 0")
    rows = rows.withColumn("level", (F.col("user_id") % 40).cast("double") + 20.0)
    n = rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("value") >= F.col("level")).alias("k")).where("n > 2 AND k > 2").select("user_id")
    got = quality.map_correlations(rows.join(n, "user_id", "left_semi"), ["user_id"], "value", "next_value", "level")
    return got.select("user_id", *[F.round(c, 6).alias(c) for c in ("cc_all", "cc_all_about_mean", "cc_contour", "cc_contour_about_mean")])


@query("""
SELECT coalesce(user_id, c_custkey) AS key, coalesce(l, 0) AS n_left, coalesce(r, 0) AS n_right
FROM (SELECT user_id, count(*) AS l FROM events GROUP BY 1) FULL OUTER JOIN (SELECT c_custkey, count(*) AS r FROM customer GROUP BY 1) ON user_id = c_custkey
WHERE coalesce(l, 0) <> 1 OR coalesce(r, 0) <> 1""")
def status_gate_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.coverage(events(spark, sf_dir).select(F.col("user_id").alias("key")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), ["key"])


_STATUS = "CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'skipped' ELSE 'unknown_failed' END"


@query(f"""
WITH s AS (SELECT o_orderkey AS pdb_id, {_STATUS} AS status FROM orders), u AS (SELECT DISTINCT l_orderkey AS pdb_id FROM lineitem)
SELECT pdb_id, 'missing' AS code FROM u WHERE pdb_id NOT IN (SELECT pdb_id FROM s)
UNION ALL SELECT pdb_id, 'extra' FROM s WHERE pdb_id NOT IN (SELECT pdb_id FROM u)
UNION ALL SELECT pdb_id, 'unknown_failed' FROM s WHERE status = 'unknown_failed'""")
def release_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "success").when(F.col("o_orderstatus") == "F", "skipped").otherwise("unknown_failed")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pdb_id"), F.lit("stage_d").alias("stage"), status.alias("status"))
    universe = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pdb_id")).distinct()
    return gates.release(rows, universe, "stage_d")


@query(f"""
SELECT o_orderkey AS pdb_id FROM orders WHERE {_STATUS} <> 'unknown_failed' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def eligible_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    ledger = orders.select(F.col("o_orderkey").alias("pdb_id"), F.when(F.col("o_orderstatus").isin("O", "F"), "success").otherwise("known_failed").alias("status"))
    waived = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("pdb_id"))
    return S.eligible(ledger, [ledger], waived)


@query("""
SELECT s_suppkey AS pdb_id, CASE WHEN s_suppkey % 3 = 0 THEN 'added' ELSE 'base' END AS reason, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey + 100 ELSE s_nationkey END AS detail FROM supplier""")
def exclusion_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pdb_id"), F.lit("base").alias("reason"), F.col("s_nationkey").alias("detail"))
    added = base.where("pdb_id % 3 = 0").select("pdb_id", F.lit("added").alias("reason"), (F.col("detail") + 100).alias("detail"))
    return joins.overlay(base, added, ["pdb_id"])


@query("""
SELECT o_orderkey AS key, concat_ws(',', CASE WHEN o_orderkey % 5 = 0 THEN 'cc_unexpected_null:cc_all' WHEN a > 1.000001 THEN 'cc_out_of_range:cc_all' END,
  CASE WHEN a > 1.000001 THEN 'cc_out_of_range:cc_all_about_mean' END) AS codes FROM (SELECT *, o_totalprice / 200000 AS a FROM orders)""")
def cc_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("o_totalprice") / 200000
    none = F.lit(None).cast("double")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), none.alias("cc_contour"), none.alias("cc_contour_about_mean"), F.when(F.col("o_orderkey") % 5 != 0, a).alias("cc_all"), a.alias("cc_all_about_mean")
    )
    return rows.select("key", F.array_join(gates.correlation_codes(F.lit(False)), ",").alias("codes"))


@query("""
WITH a AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_quantity < 5), b AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_quantity > 46)
SELECT key, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT key, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda which: table(spark, sf_dir, "lineitem").where(which).select(F.col("l_partkey").alias("key")).distinct()
    return joins.equal_sets(of("l_quantity < 5"), of("l_quantity > 46"))


@query("""
WITH a AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS src, greatest(l_partkey, l_suppkey) AS dst FROM lineitem WHERE l_returnflag = 'A'),
  b AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS src, greatest(l_partkey, l_suppkey) AS dst FROM lineitem WHERE l_returnflag = 'R')
SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def edge_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    of = lambda flag: rows.where(F.col("l_returnflag") == flag).select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))
    return joins.symmetric_difference(of("A"), of("R"), ["src", "dst"])


@query("""
SELECT n_name AS pdb_id, code FROM (SELECT n_name, unnest([CASE WHEN length(n_name) <> 4 THEN 'pdb_id' END, CASE WHEN n_nationkey % 4 = 0 THEN 'emdb_id' END]) AS code
  FROM (SELECT lower(n_name) AS n_name, n_nationkey FROM nation)) WHERE code IS NOT NULL""")
def universe_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("pdb_id"), F.when(F.col("n_nationkey") % 4 != 0, F.concat(F.lit("EMD-"), "n_nationkey")).otherwise("x").alias("emdb_id"))
    return gates.universe_faults(pairs)


@query("SELECT 'EMD-' || o_custkey AS emdb_id, count(*) AS n, string_agg('k' || o_orderkey, ',' ORDER BY 'k' || o_orderkey) AS pdb_ids FROM orders GROUP BY o_custkey")
def pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "orders").select(F.concat(F.lit("emd-"), "o_custkey").alias("emdb_id"), F.concat(F.lit("K"), "o_orderkey").alias("pdb_id"))
    return joins.pair_index(pairs).select("emdb_id", "n", F.array_join("pdb_ids", ",").alias("pdb_ids"))


@query("""
SELECT code, CASE WHEN code IN ('missing_map', 'missing_meta', 'no_occurrences') THEN 'known' WHEN code IN ('timeout', 'fatal_log') THEN 'tool' ELSE 'other' END AS kind, count(*) AS n
FROM (SELECT (['missing_map', 'timeout', 'ValueError', 'missing_meta', 'fatal_log', 'Timeout', 'no_occurrences'])[1 + event_id % 7] AS code FROM events) GROUP BY 1, 2""")
def failure_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxelforge.functions.chemistry import failure_kind

    code = "element_at(array('missing_map', 'timeout', 'ValueError', 'missing_meta', 'fatal_log', 'Timeout', 'no_occurrences'), int(1 + event_id % 7)) AS code"
    return quality.counts(events(spark, sf_dir).selectExpr(code).withColumn("kind", failure_kind(F.col("code"))), ["code", "kind"])
