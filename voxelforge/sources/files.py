"""Reading and writing row files: JSON lines, status shards, id lists, inventories, arrays."""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows of JSON lines, blank ones left out; a line that doesn't parse is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def exact_fields(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(line, missing, extra) of JSON lines whose fields aren't exactly these."""
    want = F.array(*[F.lit(n) for n in names])
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("line"), F.json_object_keys("value").alias("has"))
    out = rows.select("line", F.array_except(want, "has").alias("missing"), F.array_except("has", want).alias("extra"))
    return out.where((F.size("missing") > 0) | (F.size("extra") > 0))


def write_jsonl(df: DataFrame, path: str, key: list[str]) -> None:
    """JSON lines with fields in order of name, rows in order of the key; the folder appears when all is written."""
    df.select(*sorted(df.columns)).orderBy(*key).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """More JSON lines beside those that are there; the commit protocol makes locks unnecessary."""
    df.select(*sorted(df.columns)).write.mode("append").json(path)


def write_validated(df: DataFrame, path: str, staging: str, violations: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Writes to staging, asks the written rows for violations, and only then puts them in the place of what is at path.

    Folders are renamed, rows aren't written twice: the old folder is moved aside, staging takes its place, and only then
    the old one goes; if staging can't take its place the old one comes back. Both must be on one file system.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(staging)
    bad = violations(spark.read.parquet(staging)).limit(20).collect()
    if bad:
        raise ValueError(f"not promoted: {bad}")
    replace_folder(spark, staging, path)
    return spark.read.parquet(path)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Moves the folder `new` to path; what was there stays beside it until that is done, and comes back if it fails."""
    name = spark._jvm.org.apache.hadoop.fs.Path
    source, target, aside = name(new), name(path), name(f"{path.rstrip('/')}.before-{uuid.uuid4().hex}")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(source):
        raise FileNotFoundError(new)
    there = store.exists(target)
    if there and not store.rename(target, aside):
        raise OSError(f"{path} can't be moved aside")
    if not store.rename(source, target):
        if there:
            store.rename(aside, target)
        raise OSError(f"{new} can't be moved to {path}")
    if there:
        store.delete(aside, True)


def write_once(df: DataFrame, path: str) -> bool:
    """Writes what isn't there yet and returns True; where it is there it must be equal, and False is returned."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        df.write.mode("errorifexists").parquet(path)
        return True
    there = spark.read.schema(df.schema).parquet(path)
    if not (there.exceptAll(df).isEmpty() and df.exceptAll(there).isEmpty()):
        raise ValueError(f"{path} is there with other rows")
    return False


def read_arrays(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, dtype, shape, i, value): every number of the arrays in .npz files, one row each; objects aren't loaded."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                with np.load(io.BytesIO(content), allow_pickle=False) as held:
                    for name in held.files:
                        a = held[name]
                        yield pd.DataFrame({"path": file, "name": name, "dtype": str(a.dtype), "shape": ",".join(map(str, a.shape)), "i": np.arange(a.size), "value": a.ravel().astype(float)})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, name string, dtype string, shape string, i long, value double")


def array_bytes(columns: dict[str, np.ndarray], compressed: bool = False) -> bytes:
    """The bytes of a .npz file."""
    out = io.BytesIO()
    (np.savez_compressed if compressed else np.savez)(out, **columns)
    return out.getvalue()


def read_ids(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(pdb_id): lower-cased ids of text lines; blanks and comments left out, each id once. What isn't an id raises, as does, when strict, a repeated one."""
    rows = spark.read.text(path).select(F.lower(F.trim("value")).alias("pdb_id")).where((F.col("pdb_id") != "") & ~F.col("pdb_id").startswith("#"))
    ok = F.when(F.col("pdb_id").rlike("^[a-z0-9]{4}$"), True).otherwise(F.raise_error(F.concat(F.lit("not an id: "), F.col("pdb_id"))))
    by = rows.where(ok).groupBy("pdb_id").agg(F.count("*").alias("n"))
    once = F.when(F.col("n") == 1, True).otherwise(F.raise_error(F.concat(F.lit("repeated id: "), F.col("pdb_id"))))
    return (by.where(once) if strict else by).select("pdb_id")


def read_frozen_ids(spark: SparkSession, path: str, sha256: str, count: int) -> DataFrame:
    """Ids of a file whose bytes and number of ids are known."""
    file = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("sha"), "content")
    ok = F.when(F.col("sha") == sha256, True).otherwise(F.raise_error(F.lit("the list has changed")))
    rows = file.where(ok).select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("id")).select(F.trim("id").alias("id")).where("id <> ''")
    if rows.count() != count:
        raise ValueError("the list has another length")
    return rows


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a tab-separated inventory: run, path, size, blocks, mtime."""
    return spark.read.option("sep", "\t").schema("run string, path string, size long, blocks long, mtime double").csv(path)


def read_statuses(spark: SparkSession, path: str) -> DataFrame:
    """Status rows of all shards with file, file digest, part and number of parts (from part_iiii_of_nnnn)."""
    schema = "run_id string, stage string, pdb_id string, status string, reason string, error string, error_type string"
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path).withColumn("file", F.col("_metadata.file_path"))
    part = lambda i: F.regexp_extract("file", r"part_(\d+)_of_(\d+)", i).try_cast("int")
    return rows.withColumns({"part_id": part(1), "total_parts": part(2)})


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def changed_files(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """(path, modificationTime) of files changed after start and not after end; both need an offset."""
    from voxelforge.functions.text import aware_time
    from voxelforge.operators.select import changed_after

    files = spark.read.format("binaryFile").load(path).select("path", "modificationTime")
    return changed_after(files, "modificationTime", aware_time(F.lit(start)), aware_time(F.lit(end)))


def reusable(spark: SparkSession, path: str, resource: str) -> DataFrame:
    """(path, ok): whether a download can be used again, by its first bytes."""
    files = spark.read.format("binaryFile").load(path)
    head = F.decode(F.substring("content", 1, 1 << 20), "ISO-8859-1")
    ok = {
        "map": (F.col("length") >= 18) & (F.substring("content", 1, 2) == F.unhex(F.lit("1F8B"))),
        "meta": F.coalesce(F.try_parse_json(F.decode("content", "UTF-8")).isNotNull() & F.ltrim(F.decode("content", "UTF-8")).startswith("{"), F.lit(False)),
        "mmcif": F.ltrim(head).startswith("data_") & F.contains(head, F.lit("_entry.id")),
    }[resource]
    return files.select("path", ((F.col("length") > 0) & ok).alias("ok"))


def resource_targets(pairs: DataFrame, root: str) -> DataFrame:
    """(pdb_id, resource, path): the three files of each pair."""
    number = F.regexp_replace("emdb_id", "(?i)^EMD-", "")
    of = lambda name, *parts: F.struct(F.lit(name).alias("resource"), F.concat(F.lit(f"{root}/raw/"), *parts).alias("path"))
    each = F.array(
        of("mmcif", F.lit("mmcif/"), F.col("pdb_id"), F.lit(".cif")),
        of("map", F.lit("map/emd_"), number, F.lit(".map.gz")),
        of("meta", F.lit("meta/emd_"), number, F.lit(".json")),
    )
    return pairs.select("pdb_id", F.explode(each).alias("r")).select("pdb_id", "r.*")


def status_path(root: str, run_id: str, stage: str, part: int, parts: int) -> str:
    """Where a shard of a run's stage keeps its statuses."""
    if not 0 <= part < parts:
        raise ValueError("no such part")
    return f"{root}/reports/{run_id}/{stage}/part_{part:04d}_of_{parts:04d}.jsonl"


def enumerate_entries(snapshot: DataFrame, limit: int | None = None) -> DataFrame:
    """(pdb_id): lower-cased entries of a search snapshot by method EM that have a map and a ligand."""
    hit = F.array_contains("methods", "EM") & (F.size("emdb_ids") > 0) & ((F.coalesce("n_nonpolymer", F.lit(0)) > 0) | (F.coalesce("n_branched", F.lit(0)) > 0))
    rows = snapshot.where(hit).select(F.lower("pdb_id").alias("pdb_id")).distinct().orderBy("pdb_id")
    return rows.limit(limit) if limit is not None else rows


def fetch(requests: DataFrame, get: Callable[[str], bytes], tries: int = 3) -> DataFrame:
    """(url, status, error, content): each url asked for, again after a failure; `get` is the client and runs on the executors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for frame in frames:
            out = []
            for url in frame["url"]:
                error, content = None, None
                for i in range(tries):
                    try:
                        content, error = get(url), None
                        if content:
                            break
                        error = "empty"
                    except Exception as x:  # noqa: BLE001  it becomes the row's status
                        error = f"{type(x).__name__}: {x}"
                    if i + 1 < tries:
                        time.sleep(2**i)
                out.append((url, "unknown_failed" if error else "success", error, content))
            yield pd.DataFrame(out, columns=["url", "status", "error", "content"])

    return requests.select("url").mapInPandas(run, "url string, status string, error string, content binary")


def processes(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Process rows that were taken on the driver's machine."""
    return spark.createDataFrame(rows, "pid long, ppid long, start_ticks long, args array<string>")


def markdown(rows: list[dict], title: str) -> str:
    """A small report table."""
    if not rows:
        return f"# {title}\n\nnothing\n"
    names = list(rows[0])
    lines = ["| " + " | ".join(names) + " |", "|" + "---|" * len(names)] + ["| " + " | ".join(str(r[n]) for n in names) + " |" for r in rows]
    return f"# {title}\n\n" + "\n".join(lines) + "\n"
