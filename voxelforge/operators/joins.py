"""Joins with a fallback of keys, with templates, and with checks of coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a side that is broadcast at most; parts into which all rows of the other side would be dealt beyond that.
FEW, PARTS = 20_000, 1024


def small_join(rows: DataFrame, small: DataFrame, key: str, by: list[str], how: str = "inner") -> DataFrame:
    """rows joined with small, of which key is unique but for a few rows, so that a key of a third of all rows isn't one task's.

    small is counted first (it should be written already). With at most FEW rows it is broadcast. Beyond, a key that
    has more than one in PARTS of the rows is hot: there are fewer than PARTS of these, a bounded table; their rows
    are dealt by a hash of `by` over parts in proportion to their share, and their rows of small go to each part.
    """
    if len(small.take(FEW + 1)) <= FEW:
        return rows.join(F.broadcast(small), key, how)
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n"))
    total = rows.count()
    hot = F.broadcast(sizes.where(F.col("_n") * PARTS > total).select(key, F.ceil(F.col("_n") * PARTS / total).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(*by), parts).cast("int")).drop("_parts")
    copies = small.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copies, [key, "_part"], how).drop("_part")


def last_by_key(rows: DataFrame, key: list[str], value: str, position: str) -> DataFrame:
    """One value for each key, that of its last row."""
    return rows.groupBy(*key).agg(F.max_by(value, position).alias(value))


def first_match(probe: DataFrame, lookups: list[tuple[list[str], DataFrame]], value: str) -> DataFrame:
    """Adds the value of the first lookup that has the probe's key. A lookup is (its key columns, unique by these)."""
    out = probe
    for i, (key, table) in enumerate(lookups):
        out = out.join(table.select(*key, F.col(value).alias(f"_v{i}")), key, "left")
    return out.withColumn(value, F.coalesce(*[F.col(f"_v{i}") for i in range(len(lookups))])).drop(*[f"_v{i}" for i in range(len(lookups))])


def partner_is_polymer(partners: DataFrame, atoms: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose partner is an atom of a polymer entity."""
    return partners.join(atoms.where(F.col("entity_type") == "polymer").select(*key), key, "left_semi")


def branch_edges(links: DataFrame, scheme: DataFrame, atoms: DataFrame) -> DataFrame:
    """(asym_id, src, dst): atoms that a branch link joins, for each chain of the entity; both must exist.

    links: entity_id, num_1, num_2, atom_1, atom_2. scheme: entity_id, asym_id, num, mon_id. atoms: asym_id, mon_id, num, atom, idx.
    """
    end = lambda i: scheme.select("entity_id", "asym_id", F.col("num").alias(f"num_{i}"), F.col("mon_id").alias(f"mon_{i}"))
    at = lambda i, name: atoms.select("asym_id", F.col("mon_id").alias(f"mon_{i}"), F.col("num").alias(f"num_{i}"), F.col("atom").alias(f"atom_{i}"), F.col("idx").alias(name))
    both = links.join(end(1), ["entity_id", "num_1"]).join(end(2), ["entity_id", "asym_id", "num_2"])
    return both.join(at(1, "src"), ["asym_id", "mon_1", "num_1", "atom_1"]).join(at(2, "dst"), ["asym_id", "mon_2", "num_2", "atom_2"]).select("asym_id", "src", "dst")


def template_edges(atoms: DataFrame, template: DataFrame, residue: list[str]) -> DataFrame:
    """(residue..., src, dst, type): a component's bonds in each residue that has both atoms.

    atoms: residue..., comp, atom, idx. template: comp, atom_1, atom_2, type.
    """
    ends = lambda i, name: atoms.select(*residue, "comp", F.col("atom").alias(f"atom_{i}"), F.col("idx").alias(name))
    return ends(1, "src").join(template, ["comp", "atom_1"]).join(ends(2, "dst"), [*residue, "comp", "atom_2"]).select(*residue, "src", "dst", "type")


def align(template: DataFrame, deposited: DataFrame, occurrence: list[str], slot: list[str], values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(aligned, failed): every slot of the template with what was deposited and present; an occurrence with a
    deposited atom that has no slot fails as a whole."""
    failed = deposited.join(template.select(*occurrence, *slot), [*occurrence, *slot], "left_anti").select(*occurrence).distinct()
    got = deposited.select(*occurrence, *slot, *values, F.lit(True).alias("present"))
    out = template.join(got, [*occurrence, *slot], "left").join(failed, occurrence, "left_anti")
    return out.withColumn("present", F.coalesce("present", F.lit(False))), failed


def consecutive_links(rows: DataFrame, chain: list[str], seq: str, columns: list[str]) -> DataFrame:
    """Neighbours in a chain after sorting, where the number goes up by one."""
    from voxelforge.operators.select import next_in_chain

    return next_in_chain(rows, chain, [F.col(seq)], [seq, *columns]).where(F.col(f"next_{seq}") == F.col(seq) + 1)


def coverage(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys that one side lacks or has more than once: (key..., n_left, n_right), nothing when the sides agree one to one."""
    a, b = (d.groupBy(*key).agg(F.count("*").alias(n)) for d, n in ((left, "n_left"), (right, "n_right")))
    both = a.join(b, key, "full_outer").select(*key, *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_left", "n_right")])
    return both.where("n_left <> 1 OR n_right <> 1")


def covered_join(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """An inner join of sides that must have the same keys: a key without a partner raises when read."""
    both = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), key, "full_outer")
    gap = F.col("_l").isNull() | F.col("_r").isNull()
    ok = F.when(gap, F.raise_error(F.concat(F.lit("no partner: "), F.to_json(F.struct(*key))))).otherwise(F.lit(True))
    return both.where(ok).drop("_l", "_r")


def q_against_model(model: DataFrame, output: DataFrame, identity: list[str]) -> DataFrame:
    """Violations (id, code) between a model and a scored copy: missing, extra, identity, coordinates to three decimals."""
    coords = ["Cartn_x", "Cartn_y", "Cartn_z"]
    a = model.select("id", F.struct(*identity).alias("m_id"), F.concat_ws(" ", *[F.format_string("%.3f", c) for c in coords]).alias("m_xyz"))
    b = output.select("id", F.struct(*identity).alias("o_id"), F.concat_ws(" ", *[F.format_string("%.3f", c) for c in coords]).alias("o_xyz"))
    code = (
        F.when(F.col("o_id").isNull(), "missing").when(F.col("m_id").isNull(), "extra")
        .when(~F.col("m_id").eqNullSafe(F.col("o_id")), "identity").when(F.col("m_xyz") != F.col("o_xyz"), "coordinates")
    )
    return a.join(b, "id", "full_outer").select("id", code.alias("code")).where("code IS NOT NULL")


def project_scores(slots: DataFrame, atoms: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    """Adds q to the template's slots by the component's identity and the atom's name.

    Optional parts of an identity match where the slot has none. matches tells
    how many atoms a slot found; one is right.
    """
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"a.{c}")) for c in required]
    loose = [F.col(f"s.{c}").isNull() | (F.col(f"s.{c}") == "") | F.col(f"s.{c}").eqNullSafe(F.col(f"a.{c}")) for c in optional]
    cond = same[0]
    for c in [*same[1:], *loose]:
        cond = cond & c
    found = slots.alias("s").join(atoms.alias("a"), cond, "left")
    return found.groupBy(*[F.col(f"s.{c}") for c in slots.columns]).agg(F.count("a.q").alias("matches"), F.min("a.q").alias("q"))


def pair_index(pairs: DataFrame) -> DataFrame:
    """(emdb_id, pdb_ids, n): the entries of each map, ids in upper case, in the order of the map's number."""
    rows = pairs.select(F.upper("emdb_id").alias("emdb_id"), F.lower("pdb_id").alias("pdb_id"))
    return rows.groupBy("emdb_id").agg(F.sort_array(F.collect_list("pdb_id")).alias("pdb_ids"), F.count("*").alias("n"))


def migrated_keys(old: DataFrame, new: DataFrame, entry: str, locator: list[str], rank: str) -> DataFrame:
    """(entry, digest, old_<rank>, new_<rank>, change): unchanged, reassigned, added or removed, by a digest of what locates a row."""
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(locator)])), 256).alias("digest")
    a = old.select(entry, digest, F.col(rank).alias(f"old_{rank}"))
    b = new.select(entry, digest, F.col(rank).alias(f"new_{rank}"))
    o, n = F.col(f"old_{rank}"), F.col(f"new_{rank}")
    change = F.when(o.isNull(), "added").when(n.isNull(), "removed").when(o == n, "unchanged").otherwise("reassigned")
    return a.join(b, [entry, "digest"], "full_outer").withColumn("change", change)


def missing(wanted: DataFrame, there: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are wanted and not there."""
    return wanted.select(*key).distinct().join(there.select(*key), key, "left_anti")


def equal_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with side; as often as they are more."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def overlay(base: DataFrame, additions: DataFrame, key: list[str]) -> DataFrame:
    """The base's rows with the additions', of which the later win."""
    kept = base.join(additions.select(*key), key, "left_anti")
    return kept.unionByName(additions)


def waived_exactly(unknown: DataFrame, waiver: DataFrame, key: str, digest: str) -> DataFrame:
    """Violations of a waiver that must hold each unknown row, with its digest, and nothing else."""
    both = unknown.select(key, F.col(digest).alias("raw")).join(waiver.select(key, F.col(digest).alias("waived")), key, "full_outer")
    code = F.when(F.col("waived").isNull(), "not_waived").when(F.col("raw").isNull(), "not_unknown").when(F.col("raw") != F.col("waived"), "digest")
    return both.select(key, code.alias("code")).where("code IS NOT NULL")


def symmetric_difference(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Edges of one side alone, ends in order."""
    norm = lambda d: d.select(F.least(*columns[:2]).alias(columns[0]), F.greatest(*columns[:2]).alias(columns[1]), *columns[2:]).distinct()
    return equal_sets(norm(left), norm(right))


def condition(c: Column, text: str) -> Column:
    """An error with the text wherever the condition fails."""
    return F.when(c, F.lit(True)).otherwise(F.raise_error(F.lit(text)))


def audited_entries(audits: DataFrame, index: DataFrame, statuses: DataFrame) -> DataFrame:
    """Each entry of an audited map with the entry's status: one map stands for several entries."""
    entries = index.select("emdb_id", F.explode("pdb_ids").alias("pdb_id"))
    return audits.join(entries, "emdb_id").join(statuses.select("pdb_id", "status"), "pdb_id", "left")
