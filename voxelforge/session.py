"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle: str = "8") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voxelforge")
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("VOXELFORGE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sound(spark: SparkSession) -> SparkSession:
    """The session with a union's output taken as not partitioned.

    Spark 4.1 takes it as partitioned by a key where all its children are. Adaptive execution may still coalesce the
    children's partitions unlike each other; a later aggregate or join by that key, planned without a shuffle, then finds
    a key in several partitions and gives it several rows. ring_counts was a case of this while its edges were a union.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only a local session, as in tests, may do without:
    it gets a folder of its own."""
    sc = sound(spark).sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="voxelforge-ckpt-"))
        held = sc._jsc.sc().getCheckpointDir()
    return held.get()


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    The files are replicated by the store, so the loss of an executor costs nothing.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like cut, but in Parquet: for wide rows of which later steps read a few columns at a time."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes what stored wrote; nothing may read it any more."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/stored-" in f}:
        at = hadoop(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables under sf_dir, read by Spark whatever the store."""
    return sound(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def batched_rows(spark: SparkSession) -> int:
    """Rows in an Arrow batch, as the session has it."""
    return int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
