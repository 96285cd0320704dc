"""Ordered logs, journals, inventories, plans and repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.operators import repair
from voxelforge.operators import select as S
from voxelforge.plans.carriers import EVENTS, events
from voxelforge.plans.registry import query
from voxelforge.session import table
from voxelforge.streaming import journal as J


@query("SELECT user_id, arg_max(event_type, event_id) AS state, count(*) AS n FROM events GROUP BY user_id")
def journal_last_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.last_state(events(spark, sf_dir), ["user_id"], "event_type", "event_id")


_EVENT = "CASE k % 3 WHEN 0 THEN 'intent' WHEN 1 THEN 'deleted' ELSE 'recovered_deleted' END"


@query(f"""
SELECT event_id, previous, coalesce((previous IS NULL AND e = 'intent') OR (previous = 'intent' AND e IN ('deleted', 'recovered_deleted')), false) AS legal
FROM (SELECT event_id, {_EVENT} AS e, lag({_EVENT}) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM {EVENTS})""")
def journal_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k") % 3
    rows = events(spark, sf_dir).withColumn("event", F.when(k == 0, "intent").when(k == 1, "deleted").otherwise("recovered_deleted"))
    return J.transitions(rows, ["user_id"], "event", "event_id").select("event_id", "previous", "legal")


@query(f"""
WITH s AS (SELECT user_id, arg_max({_EVENT}, event_id) AS state FROM {EVENTS} GROUP BY user_id)
SELECT user_id, state, CASE WHEN state = 'intent' AND user_id % 2 = 1 THEN 'recovered_deleted' WHEN state <> 'intent' AND user_id % 2 = 0 THEN 'error' ELSE 'none' END AS action FROM s""")
def journal_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k") % 3
    rows = events(spark, sf_dir).withColumn("event", F.when(k == 0, "intent").when(k == 1, "deleted").otherwise("recovered_deleted"))
    live = rows.where("user_id % 2 = 0").select("user_id").distinct()
    return J.replay(J.last_state(rows, ["user_id"], "event", "event_id"), live, ["user_id"]).select("user_id", "state", "action")


@query(f"SELECT arg_max(k, event_id) AS done FROM {EVENTS} WHERE event_type = 'click'")
def last_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.when(F.col("event_type") == "click", F.concat(F.lit("[Parallel]: Done  "), "k", F.lit(" tasks | elapsed"))).otherwise("other")
    return J.last_progress(events(spark, sf_dir).select("event_id", line.alias("line")), "event_id")


@query("SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-02 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'")
def time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    return S.changed_after(events(spark, sf_dir), "ts", at("2024-01-02 00:00:00"), at("2024-01-20 12:00:00")).select("event_id")


@query("""
SELECT p_partkey AS key FROM part WHERE p_partkey % 10 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0""")
def stale_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.md5("p_name").alias("digest"))
    version = F.when(F.col("key") % 7 == 0, 1).otherwise(2)
    digest = F.when(F.col("key") % 11 == 0, "old").otherwise(F.col("digest"))
    made = source.where("key % 10 <> 0").select("key", digest.alias("digest"), version.alias("schema_version"))
    return J.stale(made, source, ["key"], "digest", 2).select("key")


@query("""
SELECT p_partkey AS key, CASE WHEN p_partkey % 4 = 0 THEN 'new' ELSE p_brand END AS value FROM part""")
def idempotent_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("value"))
    return J.upsert(there, there.where("key % 4 = 0").select("key", F.lit("new").alias("value")), ["key"])


@query("SELECT source AS kind, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS logical, CAST(sum(n_chars // 512 + 1) * 512 AS BIGINT) AS allocated FROM documents GROUP BY source")
def inventory_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("source", F.col("n_chars").alias("size"), (F.floor(F.col("n_chars") / 512) + 1).alias("blocks"))
    return repair.inventory(rows, F.col("source"))


@query("SELECT o_orderkey AS key FROM orders ORDER BY o_totalprice DESC, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') LIMIT 20")
def inventory_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("blocks"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("path"))
    return repair.largest(rows, 20).select("key")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS i FROM orders) WHERE i <= 12")
def newest_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderdate": "mtime"}).withColumn("path", F.col("o_orderkey"))
    return repair.newest(rows, "o_custkey").select("o_custkey", "o_orderkey")


@query("""
WITH p AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, row_number() OVER (ORDER BY o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, place, n - n // 10 - 5 AS stop_at FROM p WHERE place >= n - n // 10 AND o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'""")
def tail_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    skip, ready = orders.where("o_orderstatus = 'P'"), orders.where("o_orderpriority <> '1-URGENT'")
    return repair.tail_plan(orders, [F.col("o_orderkey")], orders.count() // 10, 0, 10, 5, skip, ready, "o_orderkey")


@query("""
SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_there, CASE count(DISTINCT l_returnflag) WHEN 3 THEN 'complete' ELSE 'partial' END AS state FROM lineitem GROUP BY l_orderkey""")
def trio_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("artifact"))
    return repair.completeness(rows, "l_orderkey", ["A", "N", "R"])


@query("""
SELECT c_nationkey AS entry, CASE WHEN max(CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END) = 1 THEN 'blocked' WHEN max(CASE WHEN c_custkey % 20 = 0 THEN 1 ELSE 0 END) = 1 THEN 'atom_name_only' ELSE 'exact' END AS class,
  count(*) FILTER (c_custkey % 20 = 0) AS n_changed FROM customer GROUP BY c_nationkey""")
def source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("entry"), F.col("c_custkey").alias("row"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("rest"))
    new = old.withColumns({"name": F.when(F.col("row") % 20 == 0, "x").otherwise(F.col("name")), "rest": F.when(F.col("row") % 50 == 0, 1e9).otherwise(F.col("rest"))})
    return repair.source_class(old, new, ["entry", "row"], "name", "rest")


@query("""
WITH f AS (SELECT c_nationkey AS k, bool_or(c_custkey % 3 = 0 AND c_nationkey % 2 = 0) AS after, bool_or(NOT (c_custkey % 3 = 0 AND c_nationkey % 2 = 0)) AS before FROM customer GROUP BY 1)
SELECT k, CASE WHEN after AND before THEN 'mixed' WHEN after THEN 'after' ELSE 'before' END AS files, CASE WHEN k % 4 = 0 THEN 'committing' ELSE 'staged' END AS state,
  CASE WHEN after AND before THEN CASE WHEN k % 4 = 0 THEN 'restore_then_commit' ELSE 'refuse' END WHEN after THEN CASE WHEN k % 4 = 0 THEN 'finish_receipt' ELSE 'refuse' END ELSE 'commit' END AS action FROM f""")
def transaction_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = (F.col("c_custkey") % 3 == 0) & (F.col("c_nationkey") % 2 == 0)
    files = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("path"), F.when(new, "b").otherwise("a").alias("now"), F.lit("a").alias("before"), F.lit("b").alias("after"))
    notes = files.select("k").distinct().withColumn("state", F.when(F.col("k") % 4 == 0, "committing").otherwise("staged"))
    return repair.transaction(files, notes, "k")


@query("""
WITH t AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders WHERE o_orderstatus IN ('O', 'F'))
SELECT i % 48 AS part, count(*) AS n, sha256(string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY CAST(o_orderkey AS VARCHAR))) AS sha256 FROM t GROUP BY 1""")
def migration_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "success").when(F.col("o_orderstatus") == "F", "skipped").otherwise("known_failed")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pdb_id"), status.alias("status"))
    got = repair.frozen_targets(rows, [F.col("pdb_id")], 48).withColumn("pdb_id", F.col("pdb_id").cast("string"))
    return repair.part_manifest(got).select("part", "n", "sha256")


@query("""
WITH l AS (SELECT s_suppkey AS key FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT s_suppkey FROM supplier WHERE s_suppkey % 5 = 0 UNION ALL SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 = 1)
SELECT s_suppkey AS key, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) = 0 THEN 'in_none' ELSE 'in_several' END AS code
FROM supplier LEFT JOIN (SELECT key, count(*) AS n FROM l GROUP BY key) ON key = s_suppkey WHERE coalesce(n, 0) <> 1""")
def cutoff_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"))
    return repair.cutoff_partition(rows, rows.where("key % 3 = 0"), rows.where("key % 5 = 0"), rows.where("key % 7 = 1"), "key")


@query("SELECT CAST(sum(l_linenumber) AS BIGINT) AS total, CAST(sum(l_partkey) AS BIGINT) AS parts, count(DISTINCT l_suppkey) AS n_shards FROM lineitem")
def shard_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum("l_linenumber").alias("total"), F.sum("l_partkey").alias("parts"))
    return repair.merged_counters(shards, ["total", "parts"])
