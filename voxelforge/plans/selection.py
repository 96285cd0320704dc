"""Selection, ranks, lookups, alignment and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.operators import graph, joins
from voxelforge.operators import select as S
from voxelforge.operators.components import connected_components
from voxelforge.plans.carriers import EVENTS, LINES, events, lines
from voxelforge.plans.registry import query
from voxelforge.session import table


@query(f"""
SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY CASE WHEN k % 3 = 0 THEN 0 WHEN k % 3 = 1 THEN 1 ELSE 2 END, value DESC, event_id) AS n FROM {EVENTS}) WHERE n = 1""")
def altloc_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    alt = F.when(F.col("k") % 3 == 0, "").when(F.col("k") % 3 == 1, "A").otherwise("B")
    return S.pick_altloc(events(spark, sf_dir), ["user_id", "event_type"], alt, F.col("value"), F.col("event_id")).select("user_id", "event_type", "event_id")


@query("SELECT e.user_id, e.event_id, e.event_type FROM events e JOIN (SELECT user_id, arg_min(event_type, event_id) AS m FROM events GROUP BY 1) f ON e.user_id = f.user_id AND event_type = m")
def first_model_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.first_model(events(spark, sf_dir), "user_id", "event_type", "event_id").select("user_id", "event_id", "event_type")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, candidate_id FROM {LINES}")
def candidate_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "candidate_id")


@query(f"""
WITH s AS (SELECT l_orderkey, l_suppkey, min(candidate_id) AS seen FROM {LINES} GROUP BY 1, 2)
SELECT l.l_orderkey, l.candidate_id, code FROM {LINES} l JOIN (SELECT l_orderkey, l_suppkey, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY seen) - 1 AS code FROM s) c USING (l_orderkey, l_suppkey)""")
def dense_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.first_seen_codes(lines(spark, sf_dir), "l_orderkey", ["l_suppkey"], "candidate_id", "code").select("l_orderkey", "candidate_id", "code")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) % 48 AS shard FROM orders")
def modulo_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shard(table(spark, sf_dir, "orders").select("o_orderkey"), [F.col("o_orderkey")], 48)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def explicit_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return S.only_ids(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ids, "c_custkey")


_EDGES = """(SELECT 1000 + n_nationkey AS src, n_regionkey AS dst FROM nation UNION ALL SELECT 10000000 + s_suppkey, 1000 + s_nationkey FROM supplier
  UNION ALL SELECT 1000000000 + c_custkey, 1000 + c_nationkey FROM customer)"""


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda name, key, nation, base: table(spark, sf_dir, name).select((F.lit(base) + F.col(key)).cast("long").alias("src"), (F.lit(1000) + F.col(nation)).cast("long").alias("dst"))
    nations = table(spark, sf_dir, "nation").select((F.lit(1000) + F.col("n_nationkey")).cast("long").alias("src"), F.col("n_regionkey").cast("long").alias("dst"))
    return nations.union(of("supplier", "s_suppkey", "s_nationkey", 10_000_000)).union(of("customer", "c_custkey", "c_nationkey", 1_000_000_000))


@query("""
SELECT r_regionkey AS node, r_regionkey AS component FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
UNION ALL SELECT 1000 + n_nationkey, n_regionkey FROM nation
UNION ALL SELECT 10000000 + s_suppkey, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT 1000000000 + c_custkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def components_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected_components(_edges(spark, sf_dir))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT l_partkey AS p, l_orderkey % 7 AS o FROM lineitem), x AS (SELECT o, min(p) AS m FROM e GROUP BY o)
SELECT p AS node, (SELECT min(m) FROM x) AS component FROM (SELECT DISTINCT p FROM e)""")
def components_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), (-1 - F.col("l_orderkey") % 7).alias("dst")).distinct()
    got = connected_components(edges)
    least = got.where("node >= 0").groupBy("component").agg(F.min("node").alias("least"))
    return got.where("node >= 0").join(least, "component").select("node", F.col("least").alias("component"))


@query("""
SELECT s_suppkey, coalesce(n.n_nationkey, c.c_nationkey, r.r_regionkey) AS value FROM supplier
LEFT JOIN nation n ON n.n_nationkey = s_suppkey % 40 LEFT JOIN (SELECT c_custkey, c_nationkey FROM customer) c ON c.c_custkey = s_suppkey % 70 AND s_suppkey % 2 = 0
LEFT JOIN region r ON r.r_regionkey = s_suppkey % 5""")
def three_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 40).alias("a"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey") % 70).alias("b"), (F.col("s_suppkey") % 5).alias("c"))
    value = lambda c: F.col(c).cast("long").alias("value")
    first = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("a"), value("n_nationkey"))
    second = joins.last_by_key(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("b"), value("c_nationkey"), "c_custkey"), ["b"], "value", "c_custkey")
    third = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("c"), value("r_regionkey"))
    return joins.first_match(probe, [(["a"], first), (["b"], second), (["c"], third)], "value").select("s_suppkey", "value")


_DEPOSITED = "(SELECT l_orderkey AS occ, CAST(l_linenumber AS BIGINT) AS slot, min(l_extendedprice) AS x FROM lineitem GROUP BY 1, 2)"


@query(f"""
WITH t AS (SELECT o_orderkey AS occ, unnest(range(1, 6)) AS slot FROM orders), d AS {_DEPOSITED}, f AS (SELECT DISTINCT occ FROM d WHERE slot > 5)
SELECT t.occ, t.slot, d.x, d.x IS NOT NULL AS present FROM t LEFT JOIN d USING (occ, slot) WHERE t.occ NOT IN (SELECT occ FROM f)""")
def template_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("occ"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(5).cast("long"))).alias("slot"))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("occ"), F.col("l_linenumber").cast("long").alias("slot")).agg(F.min("l_extendedprice").alias("x"))
    return joins.align(template, rows, ["occ"], ["slot"], ["x"])[0]


@query("""
SELECT o_custkey, o_orderkey, next FROM (SELECT o_custkey, o_orderkey, seq, lead(o_orderkey) OVER w AS next, lead(seq) OVER w AS next_seq
  FROM (SELECT *, o_orderkey % 3 AS seq FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) WHERE next_seq = seq + 1""")
def adjacent_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("seq", F.col("o_orderkey") % 3)
    told = S.next_in_chain(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderkey", "seq"])
    return told.where("next_seq = seq + 1").select("o_custkey", "o_orderkey", F.col("next_o_orderkey").alias("next"))


@query(f"""
WITH o AS (SELECT l_orderkey, candidate_id, l_partkey, l_suppkey FROM {LINES}), n AS (SELECT * FROM o WHERE l_suppkey % 10 <> 0),
  r AS (SELECT l_orderkey, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey) AS c, candidate_id,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY candidate_id) - 1 AS new_id FROM n)
SELECT o.l_orderkey, o.candidate_id AS old_id, r.new_id,
  CASE WHEN r.new_id IS NULL THEN 'removed' WHEN r.new_id = o.candidate_id THEN 'unchanged' ELSE 'reassigned' END AS change
FROM o LEFT JOIN r ON o.l_orderkey = r.l_orderkey AND o.candidate_id = r.candidate_id""")
def key_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = lines(spark, sf_dir).withColumn("place", F.col("candidate_id"))
    new = S.ranked(old.where("l_suppkey % 10 <> 0"), ["l_orderkey"], [F.col("place")], "new_id").withColumn("candidate_id", F.col("new_id"))
    got = joins.migrated_keys(old, new, "l_orderkey", ["l_partkey", "l_suppkey", "place"], "candidate_id")
    return got.select("l_orderkey", F.col("old_candidate_id").alias("old_id"), F.col("new_candidate_id").alias("new_id"), "change")


@query("""
WITH e AS (SELECT n_regionkey AS region, 1000 + n_nationkey AS node, 1 AS depth, n_nationkey AS nation FROM nation
  UNION ALL SELECT n_regionkey, 10000000 + s_suppkey, 2, s_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT DISTINCT n_regionkey, CAST(n_regionkey AS BIGINT), 0, -1 FROM nation),
d AS (SELECT a.region, a.node AS src, b.node AS dst, CASE WHEN a.node = b.node THEN 0 WHEN a.nation = b.nation AND a.depth > 0 AND b.depth > 0 THEN
    CASE WHEN a.depth = 2 AND b.depth = 2 THEN 2 ELSE 1 END ELSE a.depth + b.depth END AS hops FROM e a JOIN e b ON a.region = b.region)
SELECT region, count(*) FILTER (hops = 0) AS n_nodes, CAST(sum(hops) FILTER (src < dst) AS BIGINT) AS wiener FROM d GROUP BY region""")
def wiener_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.col("n_regionkey").cast("long").alias("region"))
    up = nation.select("region", (F.lit(1000) + F.col("n_nationkey")).cast("long").alias("src"), F.col("region").alias("dst"))
    suppliers = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    low = suppliers.select("region", (F.lit(10_000_000) + F.col("s_suppkey")).cast("long").alias("src"), (F.lit(1000) + F.col("n_nationkey")).cast("long").alias("dst"))
    return graph.path_scalars(graph.shortest_paths(up.union(low), ["region"], 4), ["region"]).select("region", "n_nodes", "wiener")


@query("SELECT s_nationkey AS nation, round(2 * sqrt(count(*)), 6) AS energy FROM supplier GROUP BY s_nationkey")
def graph_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("src"), F.lit(-1).cast("long").alias("dst"))
    return graph.graph_energy(edges, "nation").select("nation", F.round("energy", 6).alias("energy"))


@query("""
WITH b AS (SELECT least(l_partkey, l_suppkey) AS src, greatest(l_partkey, l_suppkey) AS dst,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS rank, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 3 ELSE 4 END AS code FROM lineitem WHERE l_partkey <> l_suppkey)
SELECT src, dst, arg_max(code, rank) AS bond_type FROM b GROUP BY src, dst""")
def bond_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"), "l_returnflag", F.lit(1).alias("e"))
    of = lambda flag, kind: rows.where(F.col("l_returnflag") == flag).withColumn("type", F.lit(kind))
    got = graph.receptor_bonds(of("A", "double"), of("N", ""), of("R", "disulf"), ["e"])
    return got.select("src", "dst", F.col("bond_type").cast("int").alias("bond_type"))


@query("""
SELECT n_nationkey AS key, c_custkey AS candidate, n_residues, n_atoms, kind FROM (
  SELECT c_nationkey AS n_nationkey, c_custkey, count(DISTINCT o_orderpriority) AS n_residues, count(*) AS n_atoms,
    CASE WHEN count(DISTINCT o_orderpriority) > 1 THEN 'BRANCHED' ELSE 'CCD' END AS kind FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)""")
def occurrence_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    atoms = orders.select(
        F.col("c_nationkey").alias("pdb_id"), F.col("o_orderkey").alias("idx"), F.lit("A").alias("asym"), F.lit(1).alias("seq"),
        F.col("o_orderpriority").alias("comp"), F.col("o_orderkey").alias("atom_id"), "c_custkey",
    )
    edges = S.next_in_chain(atoms, ["c_custkey"], [F.col("idx")], ["idx"]).where("next_idx IS NOT NULL").select(F.col("idx").alias("src"), F.col("next_idx").alias("dst"))
    told = graph.occurrences(atoms, edges)
    who = told.groupBy("pdb_id", "candidate_id").agg(F.min("c_custkey").alias("candidate"))
    return graph.residues(told).join(who, ["pdb_id", "candidate_id"]).select(F.col("pdb_id").alias("key"), "candidate", "n_residues", "n_atoms", "kind")


@query("SELECT DISTINCT p_partkey AS key FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity < 5)")
def dependency_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = table(spark, sf_dir, "lineitem").where("l_quantity < 5").select(F.col("l_partkey").alias("key"))
    return joins.missing(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key")), there, ["key"])
