"""Selecting one consistent model from raw atom rows, and rows by set, shard or policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelforge.functions import fixed as X


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; Spark cuts every key to one row before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def first_model(df: DataFrame, key: str, model: str, position: str) -> DataFrame:
    """Rows whose model is that of their entry's first row.

    The first model is found by a partial aggregate, and a row of an entry's
    other models never moves further than the join.
    """
    first = df.groupBy(key).agg(F.min_by(F.coalesce(model, F.lit("1")), position).alias("_model"))
    return df.join(first, key).where(F.coalesce(F.col(model), F.lit("1")) == F.col("_model")).drop("_model")


def heavy(df: DataFrame, element: str) -> DataFrame:
    """Rows that aren't hydrogen or deuterium."""
    return df.where(~F.upper(element).isin("H", "D"))


def pick_altloc(df: DataFrame, keys: list[str], alt: Column, occupancy: Column, atom_id: Column) -> DataFrame:
    """Of alternates the one that comes first by location, then the largest occupancy, then id."""
    return first_by(df, keys, [alternate_order(alt), occupancy.desc(), atom_id])


def alternate_order(alt: Column) -> Column:
    """No location before A or 1, these before any other."""
    return F.when(F.coalesce(alt, F.lit("")) == "", 0).when(alt.isin("A", "1"), 1).otherwise(2)


def typed_atoms(raw: DataFrame) -> DataFrame:
    """Raw rows (all strings) as typed columns; what isn't a number is an error, as it is in the source."""
    kinds = {"id": "long", "Cartn_x": "double", "Cartn_y": "double", "Cartn_z": "double"}
    return raw.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in raw.columns])


def selected_atoms(raw: DataFrame, key: str = "pdb_id") -> DataFrame:
    """From raw atom_site rows (with file_pos): first model, heavy atoms, one of alternates."""
    rows = heavy(first_model(raw, key, "pdbx_PDB_model_num", "file_pos"), "type_symbol")
    site = ["label_asym_id", "label_comp_id", "label_seq_id", "auth_seq_id", "pdbx_PDB_ins_code", "label_atom_id"]
    occupancy = F.coalesce(F.nullif("occupancy", F.lit("")), F.lit("0")).cast("double")
    return typed_atoms(pick_altloc(rows, [key, *site], F.col("label_alt_id"), occupancy, F.col("id").cast("long")))


def split_atoms(atoms: DataFrame, entities: DataFrame, key: str = "pdb_id") -> tuple[DataFrame, DataFrame]:
    """(receptor, ligand candidates): polymer entities, and HETATM or non-polymer rows that aren't junk."""
    told = atoms.join(entities.select(key, F.col("id").alias("label_entity_id"), F.col("type").alias("entity_type")), [key, "label_entity_id"], "left")
    told = told.withColumn("entity_type", F.coalesce("entity_type", F.lit(""))).where(~F.upper("label_comp_id").isin(X.JUNK_RESIDUES))
    polymer = F.col("entity_type") == "polymer"
    het = (F.col("group_PDB") == "HETATM") | F.col("entity_type").isin("non-polymer", "branched")
    return told.where(polymer), told.where(~polymer & het)


def atom_only(atoms: DataFrame) -> DataFrame:
    """ATOM rows."""
    return atoms.where(F.upper("group_PDB") == "ATOM")


def only_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ids; an absent id or a repeated key raises when read."""
    wanted = ids.groupBy(key).agg(F.count("*").alias("_wanted"))
    there = rows.groupBy(key).agg(F.count("*").alias("_there"))
    fault = lambda text: F.raise_error(F.concat(F.lit(text), F.col(key).cast("string")))
    ok = (
        F.when(F.col("_there").isNull(), fault("absent id: ")).when(F.col("_there") > 1, fault("repeated key: "))
        .when(F.col("_wanted") > 1, fault("repeated id: ")).otherwise(F.lit(True))
    )
    checked = wanted.join(there, key, "left").where(ok).select(key)
    return rows.join(checked, key)


def place_of(rows: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """Adds the 0-based place of every row in a total order, without gathering the rows.

    Rows are sorted by range over partitions; counts of these (one number a
    partition) give every partition the place at which it starts.
    """
    from voxelforge.session import cut

    dealt = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()))
    sizes = dealt.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = sizes.withColumn("_start", F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))).select("_p", F.coalesce("_start", F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return dealt.withColumn("_nth", nth).join(starts, "_p").withColumn(name, F.col("_start") + F.col("_nth")).drop("_p", "_nth", "_start")


def shard(rows: DataFrame, order: list[Column], parts: int) -> DataFrame:
    """Adds shard: the row's place in the order modulo the number of shards."""
    return place_of(rows, order).withColumn("shard", (F.col("place") % parts).cast("long")).drop("place")


def eligible(universe: DataFrame, ledgers: list[DataFrame], waived: DataFrame | None, key: str = "pdb_id") -> DataFrame:
    """Keys without a known failure in any ledger and without a waiver."""
    out = universe.select(key).distinct()
    for ledger in ledgers:
        out = out.join(ledger.where(F.col("status") == "known_failed").select(key), key, "left_anti")
    return out if waived is None else out.join(waived.select(key), key, "left_anti")


def ranked(rows: DataFrame, keys: list[str], order: list[Column], name: str, start: int = 0) -> DataFrame:
    """Adds the place of a row within its key, from `start` on."""
    return rows.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1 + start).cast("long"))


def first_seen_codes(rows: DataFrame, key: str, group: list[str], position: str, name: str) -> DataFrame:
    """Adds a dense code for each group within the key, in the order in which groups are first seen."""
    seen = F.min(position).over(Window.partitionBy(key, *group))
    code = F.dense_rank().over(Window.partitionBy(key).orderBy("_seen")) - 1
    return rows.withColumn("_seen", seen).withColumn(name, code.cast("long")).drop("_seen")


def next_in_chain(rows: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Adds next_<column>: the values of the row that follows within the key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})


def changed_after(rows: DataFrame, instant: str, start: Column, end: Column) -> DataFrame:
    """Rows whose instant is after start and not after end."""
    return rows.where((F.col(instant) > start) & (F.col(instant) <= end))
