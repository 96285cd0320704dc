"""Occurrences, bonds and paths over edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxelforge.functions import fixed as X
from voxelforge.operators.components import connected_components
from voxelforge.session import cut, stored

#: Edges of a graph that ring_count holds in a task at most.
WHOLE = 1 << 18


def occurrences(atoms: DataFrame, edges: DataFrame, entry: str = "pdb_id") -> DataFrame:
    """Atoms with their occurrence: the connected parts of each entry, ranked by (smallest chain, number, atom id).

    atoms: entry, idx (unique), asym, seq (number or null), comp, atom_id. edges: src, dst of idx. Adds component and candidate_id.
    """
    parts = connected_components(edges.select("src", "dst"))
    told = atoms.join(parts.withColumnRenamed("node", "idx"), "idx", "left").withColumn("component", F.coalesce("component", "idx"))
    order = F.struct(F.min("asym").alias("a"), F.min(F.coalesce("seq", F.lit(10**9))).alias("s"), F.min("atom_id").alias("i")).alias("_order")
    first = told.groupBy(entry, "component").agg(order)
    rank = (F.row_number().over(Window.partitionBy(entry).orderBy("_order")) - 1).cast("long")
    return told.join(first.withColumn("candidate_id", rank).drop("_order"), [entry, "component"])


def residues(atoms: DataFrame, entry: str = "pdb_id") -> DataFrame:
    """(entry, candidate_id, kind, n_residues, n_atoms, components): residues of an occurrence in order, from 1."""
    each = atoms.groupBy(entry, "candidate_id", "asym", "seq", "comp").agg(F.count("*").alias("n"))
    listed = F.sort_array(F.collect_list(F.struct("asym", F.coalesce("seq", F.lit(10**9)).alias("seq"), "comp")))
    return (
        each.groupBy(entry, "candidate_id")
        .agg(F.count("*").alias("n_residues"), F.sum("n").alias("n_atoms"), listed.alias("components"))
        .withColumn("kind", F.when(F.col("n_residues") > 1, "BRANCHED").otherwise("CCD"))
    )


def covalent(partners: DataFrame, polymer: DataFrame, residue: list[str], atom: str) -> DataFrame:
    """Ligand residues that are bonded to an atom of a polymer."""
    return partners.join(polymer.select(atom).distinct(), atom, "left_semi").select(*residue).distinct()


def receptor_bonds(template: DataFrame, backbone: DataFrame, connected: DataFrame, key: list[str]) -> DataFrame:
    """(key..., src < dst, bond_type): bonds of three sources, of which a later one replaces an earlier on the same pair.

    template has type as text; a type that has no code raises. connected has type disulf... or covale; others don't count. Loops are left out.
    """
    code = lambda n: F.lit(X.BOND_CODES.index(n))
    known = F.create_map(*[v for i, n in enumerate(X.BOND_CODES) for v in (F.lit(n), F.lit(i))])
    of_template = F.coalesce(known[F.col("type")], F.raise_error(F.concat(F.lit("no code for "), F.col("type"))).cast("int"))
    of_connected = F.when(F.col("type").startswith("disulf"), code("disulfide")).when(F.col("type") == "covale", code("covale"))
    rows = (
        template.select(*key, "src", "dst", of_template.alias("bond_type"), F.lit(0).alias("rank"))
        .unionByName(backbone.select(*key, "src", "dst", code("backbone").alias("bond_type"), F.lit(1).alias("rank")))
        .unionByName(connected.select(*key, "src", "dst", of_connected.alias("bond_type"), F.lit(2).alias("rank")).where("bond_type IS NOT NULL"))
    )
    ends = rows.where("src <> dst").select(*key, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "bond_type", "rank")
    return ends.groupBy(*key, "src", "dst").agg(F.max_by("bond_type", "rank").cast("smallint").alias("bond_type"))


def shortest_paths(edges: DataFrame, key: list[str], most: int) -> DataFrame:
    """(key..., src, dst, hops) of an undirected, unweighted graph, up to `most` hops, by joining the frontier with the edges.

    The work grows with the pairs that are asked for; keys are small graphs.
    """
    both = cut(edges.select(*key, "src", "dst").union(edges.select(*key, "dst", "src")).distinct())
    nodes = both.select(*key, "src").distinct()
    found = nodes.select(*key, "src", F.col("src").alias("dst"), F.lit(0).alias("hops"))
    front = found
    for hop in range(1, most + 1):
        step = front.select(*key, F.col("src").alias("from"), F.col("dst").alias("src")).join(both, [*key, "src"]).select(*key, F.col("from").alias("src"), "dst").distinct()
        front = cut(step.join(found.select(*key, "src", "dst"), [*key, "src", "dst"], "left_anti").withColumn("hops", F.lit(hop)))
        if front.isEmpty():
            break
        found = found.unionByName(front)
    return found


def path_scalars(paths: DataFrame, key: list[str]) -> DataFrame:
    """(key..., n_nodes, wiener): the sum of the shortest paths over unordered pairs."""
    return paths.groupBy(*key).agg(F.count_if(F.col("hops") == 0).alias("n_nodes"), F.sum(F.when(F.col("src") < F.col("dst"), F.col("hops")).otherwise(0)).alias("wiener"))


def local_scalars(paths: DataFrame, key: list[str], hops: int = 3) -> DataFrame:
    """(key..., src, eccentricity, n1, n2, ...): how far a node's farthest is, and how many are so many hops away."""
    return paths.groupBy(*key, "src").agg(F.max("hops").alias("eccentricity"), *[F.count_if(F.col("hops") == h).alias(f"n{h}") for h in range(1, hops + 1)])


def ring_count(edges: DataFrame, key: list[str]) -> DataFrame:
    """(key..., rings): edges less nodes plus connected parts, the number of independent rings. A null key is a key.

    Edges are written once. A graph of up to WHOLE edges is a task's, with many others in one batch; so the edges move once,
    by key. Larger graphs, of which there are few, are dealt into blocks.
    """
    one = stored(edges.select(*key, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")))
    large = one.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > WHOLE)
    large = cut(large.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(key)], F.monotonically_increasing_id().alias("_graph")))
    if not large.take(1):
        return _rings_in_tasks(one, key)
    same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(key)]
    rings = _rings_by_blocks(one.join(F.broadcast(large), same).select("_graph", "src", "dst")).join(F.broadcast(large), "_graph")
    rest = one.join(F.broadcast(large), same, "left_anti")
    return _rings_in_tasks(rest, key).unionByName(rings.select(*[F.col(f"_{i}").alias(k) for i, k in enumerate(key)], "rings"))


def _rings_in_tasks(edges: DataFrame, key: list[str]) -> DataFrame:
    """ring_count of graphs that a task can hold; src <= dst, edges may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            starts = np.flatnonzero(batch["_at"].to_numpy() == 1)
            if len(starts):
                yield from counted([*held, batch.slice(0, starts[-1])])
                held = []
                batch = batch.slice(starts[-1])
            held.append(batch)
        yield from counted(held)

    def counted(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sum(b.num_rows for b in batches):
            rows = pa.Table.from_batches(batches).combine_chunks()
            first = rows["_at"].to_numpy() == 1
            codes = pa.concat_arrays([*rows["src"].chunks, *rows["dst"].chunks]).dictionary_encode("encode").indices.to_numpy()
            *_, rings = joined(np.cumsum(first) - 1, codes[: len(first)], codes[len(first) :])
            yield from rows.select(key).filter(pa.array(first)).append_column("rings", pa.array(rings, pa.int64())).to_batches()

    ordered = edges.withColumn("_at", F.row_number().over(Window.partitionBy(*key).orderBy("src", "dst")))
    return ordered.mapInArrow(run, T.StructType([*edges.select(*key).schema, T.StructField("rings", T.LongType())]))


def joined(graph: np.ndarray, src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(graph, code, root) of each node, and the number of independent rings of each graph, 0 to the last.

    A root is the place of the first node of a connected part. Edges may repeat, with their ends in the same order.
    """
    wide = int(max(src.max(), dst.max())) + 1
    nodes, ends = np.unique(np.concatenate([graph * wide + src, graph * wide + dst]), return_inverse=True)
    u, v = np.divmod(np.unique(ends[: len(src)] * len(nodes) + ends[len(src) :]), len(nodes))
    root, a, b = np.arange(len(nodes)), u, v
    while len(a):
        # The larger of two roots goes to the smallest that it meets; then all nodes go to their roots.
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != (up := root[root])).any():
            root = up
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    of, code = np.divmod(nodes, wide)
    count = lambda graphs: np.bincount(graphs, minlength=int(graph.max()) + 1)
    return of, code, root, count(of[u]) - count(of) + count(of[root == np.arange(len(nodes))])


def _rings_by_blocks(edges: DataFrame) -> DataFrame:
    """(_graph, rings) of graphs of any size, their edges (_graph, src <= dst, which may repeat) dealt by range into blocks.

    A block counts its own rings, and its connected parts stand for their nodes. A node of several parts links each with the
    next. Of links between the same two parts all but one close a ring; what is left is a graph of parts, as a rule a small one.
    Where it isn't, connected components are found of it.
    """
    most, node = max(WHOLE, 2), edges.schema["src"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, at = [], 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n > most:
                rows, ids, graph, src, dst, values = coded(held)
                # The last edge waits, as it may be repeated in what comes.
                other = np.flatnonzero((graph != graph[-1]) | (src != src[-1]) | (dst != dst[-1]))
                end = int(other[-1]) + 1 if len(other) else 0
                yield from block(ids, graph[:end], src[:end], dst[:end], values, at)
                held, n, at = rows.slice(end, 1).to_batches(), 1, at + 2 * end
        if n:
            yield from block(*coded(held)[1:], at)

    def coded(batches: list[pa.RecordBatch]) -> tuple:
        rows = pa.Table.from_batches(batches).combine_chunks()
        ids, graph = np.unique(rows["_graph"].to_numpy(), return_inverse=True)
        ends = pa.concat_arrays([*rows["src"].chunks, *rows["dst"].chunks]).dictionary_encode("encode")
        codes = ends.indices.to_numpy()
        return rows, ids, graph, codes[: len(graph)], codes[len(graph) :], ends.dictionary

    def block(ids: np.ndarray, graph: np.ndarray, src: np.ndarray, dst: np.ndarray, values: pa.Array, at: int) -> Iterator[pa.RecordBatch]:
        if len(graph):
            of, code, root, rings = joined(graph, src, dst)
            names, none = ["_graph", "node", "part", "n"], lambda kind: pa.nulls(len(rings), kind)
            yield pa.RecordBatch.from_arrays([pa.array(ids[: len(rings)]), none(values.type), none(pa.int64()), pa.array(rings, pa.int64())], names=names)
            yield pa.RecordBatch.from_arrays([pa.array(ids[of]), values.take(pa.array(code)), pa.array(root + at), pa.nulls(len(of), pa.int64())], names=names)

    long = T.LongType()
    kinds = T.StructType([T.StructField("_graph", long), T.StructField("node", node), T.StructField("part", long), T.StructField("n", long)])
    order = ["_graph", "src", "dst"]
    told = stored(edges.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, kinds))
    before = F.lag("part").over(Window.partitionBy("_graph", "node").orderBy("part"))
    met = told.where("part IS NOT NULL").withColumn("before", before).where("before IS NOT NULL")
    links = stored(met.groupBy("_graph", "before", "part").agg((F.count("*") - 1).alias("n")))
    parts = links.select(F.col("_graph").alias("graph"), F.col("before").alias("src"), F.col("part").alias("dst"))
    left = ring_count(parts, ["graph"]) if 2 * links.count() <= edges.count() else _rings_by_parts(parts, ["graph"])
    rings = told.where("part IS NULL").select("_graph", "n").unionByName(links.select("_graph", "n")).unionByName(left.selectExpr("graph AS _graph", "rings AS n"))
    return rings.groupBy("_graph").agg(F.sum("n").alias("rings"))


def _rings_by_parts(edges: DataFrame, key: list[str]) -> DataFrame:
    """ring_count of graphs of any size: each edge counts one, each node but the smallest of its part one less."""
    node = lambda c: F.struct(*key, F.col(c).alias("_node")).alias(c)
    pairs = edges.distinct()
    parts = connected_components(pairs.select(node("src"), node("dst")))
    less = parts.select("node.*", F.when(F.col("node") == F.col("component"), 0).otherwise(-1).alias("_n"))
    return pairs.select(*key, F.lit(1).alias("_n")).unionByName(less.select(*key, "_n")).groupBy(*key).agg(F.sum("_n").alias("rings"))


def graph_energy(edges: DataFrame, key: str) -> DataFrame:
    """(key, energy): the sum of the absolute eigenvalues of the adjacency matrix, by numpy for each small graph."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, pairs in zip(frame[key], frame["pairs"], strict=True):
                nodes = sorted({n for p in pairs for n in (p["src"], p["dst"])})
                at = {n: i for i, n in enumerate(nodes)}
                m = np.zeros((len(nodes), len(nodes)))
                for p in pairs:
                    m[at[p["src"]], at[p["dst"]]] = m[at[p["dst"]], at[p["src"]]] = 1
                out.append((k, float(np.abs(np.linalg.eigvalsh(m)).sum())))
            yield pd.DataFrame(out, columns=[key, "energy"])

    kind = dict(edges.dtypes)[key]
    return edges.groupBy(key).agg(F.collect_list(F.struct("src", "dst")).alias("pairs")).mapInPandas(run, f"{key} {kind}, energy double")


def gyration_radius(points: DataFrame, key: list[str]) -> DataFrame:
    """(key..., rg): the root of the mean squared distance from the centre."""
    var = sum((F.var_pop(a) for a in ("y", "z")), F.var_pop("x"))
    return points.groupBy(*key).agg(F.sqrt(var).alias("rg"))


def assemble(residue_atoms: DataFrame, residue_bonds: DataFrame, links: DataFrame, key: str = "object_key") -> tuple[DataFrame, DataFrame]:
    """(atoms, bonds) of branched objects: residues' atoms one after another, their bonds moved along, single bonds between residues.

    residue_atoms: key, residue_id, comp_row, atom_name, ... residue_bonds: key, residue_id, atom_1, atom_2 (comp_row), type.
    links: key, res_i, atom_i, res_j, atom_j (names); an end that isn't there raises.
    """
    row = (F.row_number().over(Window.partitionBy(key).orderBy("residue_id", "comp_row")) - 1).cast("int")
    atoms = residue_atoms.withColumn("row_idx", row)
    at = lambda i: atoms.select(key, "residue_id", F.col("comp_row").alias(f"atom_{i}"), F.col("row_idx").alias(f"row_{i}"))
    inside = residue_bonds.join(at(1), [key, "residue_id", "atom_1"]).join(at(2), [key, "residue_id", "atom_2"]).select(key, F.col("row_1").alias("atom_1"), F.col("row_2").alias("atom_2"), "type")
    end = lambda i: atoms.select(key, F.col("residue_id").alias(f"res_{i}"), F.col("atom_name").alias(f"atom_{i}"), F.col("row_idx").alias(f"row_{i}"))
    between = links.join(end("i"), [key, "res_i", "atom_i"], "left").join(end("j"), [key, "res_j", "atom_j"], "left")
    ok = F.when(F.col("row_i").isNull() | F.col("row_j").isNull(), F.raise_error(F.lit("a bond's end is missing"))).otherwise(F.lit(True))
    between = between.where(ok).select(key, F.least("row_i", "row_j").alias("atom_1"), F.greatest("row_i", "row_j").alias("atom_2"), F.lit("single").alias("type"))
    return atoms, inside.unionByName(between)


def fill_missing(keys: DataFrame, there: DataFrame, compute, key: str) -> DataFrame:
    """What is there with what `compute` makes of the keys that lack it, each once."""
    todo = keys.select(key).distinct().join(there.select(key), key, "left_anti")
    return there.unionByName(compute(todo))


def component_faults(atoms: DataFrame, templates: DataFrame) -> DataFrame:
    """(comp, atom, code): names that a template lacks, has twice or without an element."""
    twice = templates.groupBy("comp", "atom").agg(F.count("*").alias("n"), F.min("element").alias("element"))
    bad = twice.select("comp", "atom", F.when(F.col("atom") == "", "empty_name").when(F.col("n") > 1, "duplicate_name").when(F.coalesce(F.col("element"), F.lit(0)) <= 0, "invalid_element").alias("code"))
    absent = atoms.select("comp", "atom").distinct().join(templates.select("comp", "atom"), ["comp", "atom"], "left_anti").withColumn("code", F.lit("not_in_template"))
    return bad.where("code IS NOT NULL").unionByName(absent)
