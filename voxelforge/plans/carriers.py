"""Views of the driver's tables as entries, occurrences and points, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelforge.operators.select import ranked
from voxelforge.session import table

#: A total order of the rows of an order.
LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_SQL = ", ".join(LINE)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their 0-based rank in the order."""
    return ranked(table(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.col(c) for c in LINE], "candidate_id")


LINES = f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) - 1 AS candidate_id FROM lineitem)"


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as maps, their lines as occurrences with scores; an N line has an empty pocket."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    told = lines(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return told.select(
        F.col("l_orderkey").alias("pdb_id"), "candidate_id", (F.col("l_discount") * F.lit(10.0)).alias("q_score"),
        F.when(F.col("l_returnflag") != "N", F.col("l_tax") * F.lit(12.0)).alias("pocket_q_score"),
        F.col("o_totalprice").alias("map_resolution"), ((F.col("o_custkey") % 200).cast("double") / F.lit(100.0) - F.lit(1.0)).alias("cc_all_about_mean"),
    )


OCCURRENCES = f"""(SELECT l_orderkey AS pdb_id, candidate_id, l_discount * CAST(10 AS DOUBLE) AS q_score,
  CASE WHEN l_returnflag <> 'N' THEN l_tax * CAST(12 AS DOUBLE) END AS pocket_q_score, o_totalprice AS map_resolution,
  CAST(o_custkey % 200 AS DOUBLE) / CAST(100 AS DOUBLE) - 1 AS cc_all_about_mean
  FROM {LINES} l JOIN orders o ON l_orderkey = o_orderkey)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as points of one entry: their first three numbers, times ten."""
    at = lambda i: (F.get("embedding", F.lit(i)).cast("double") * F.lit(10.0))
    return table(spark, sf_dir, "embeddings").select(
        F.lit("1abc").alias("pdb_id"), F.col("vec_id").alias("row_idx"), F.col("label").cast("long").alias("candidate_id"),
        at(0).alias("x"), at(1).alias("y"), at(2).alias("z"), F.lit(True).alias("present"),
    )


POINTS = """(SELECT vec_id AS row_idx, CAST(label AS BIGINT) AS candidate_id, CAST(embedding[1] AS DOUBLE) * CAST(10 AS DOUBLE) AS x,
  CAST(embedding[2] AS DOUBLE) * CAST(10 AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) * CAST(10 AS DOUBLE) AS z FROM embeddings)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number of their properties."""
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))


EVENTS = "(SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"
