"""Merkle manifest of a dataset, proved by octopus multiproofs.

Rows become leaves, in order of their id inside their group; 8 consecutive nodes of a level
become one node of the next until one is left, the group's subroot. The subroots, in order of
their groups, become the root in the same way. All nodes are rows of tables: a leaf's place is its
number in one range-partitioned sort, and a level is one aggregation of the one below it.

Proofs are made for partitions of ``LEAVES`` consecutive leaves, not one by one. From the places
alone each partition works out the least set of nodes that all its proofs need and that its own
leaves do not give; these coordinates are fetched in one join; then the partition derives every
interior node once and expands the proof of each leaf from them. So a node near the root is
fetched once for thousands of leaves, and no path is looked up node by node.

All of this holds for any subset of the leaves, whose partitions then miss more nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetboard.llm.common import cut, numbered

#: Nodes that become one.
FAN = 8
#: Leaves whose proofs are made together.
LEAVES = 2048
#: The tree of the subroots; a group's tree is named by the number of its first leaf.
TOP = -1
#: Nodes from this level on are wanted by many partitions, and are met under so many salts.
HIGH, SALTS = 6, 16
#: A tree of subroots of at most so many is met under salts as a whole.
FEW = 4096


def leaf(*columns: str | Column) -> Column:
    """SHA-256, in lower-case hex, of the columns: each ``-`` if NULL, else its UTF-8 length, ``:`` and itself."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    marked = [F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.sha2(F.concat(*marked), 256)


@dataclass
class Tree:
    """``leaves``: the given columns with g, tree, n (the group's leaves), top (the group's number) and subroot.

    ``nodes``: tree, level, pos, hash. ``groups``: how many groups; ``root``: NULL without leaves.
    """

    leaves: DataFrame
    nodes: DataFrame
    groups: int
    root: str | None


def _levels(bottom: DataFrame, most: int) -> list[DataFrame]:
    """All levels above and with ``bottom`` (tree, c, pos, hash); c counts the nodes of the tree's level."""
    levels = [bottom]
    while most > 1:
        below = levels[-1].where("c > 1")
        runs = below.groupBy("tree", "c", F.expr(f"pos DIV {FAN}").alias("pos")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("run")
        )
        hashes = F.array_join(F.transform("run", lambda x: x["hash"]), "")
        levels.append(cut(runs.select(
            "tree", F.expr(f"(c + {FAN - 1}) DIV {FAN}").alias("c"), "pos", F.sha2(hashes, 256).alias("hash")
        ), "nodes"))
        most = -(-most // FAN)
    return levels


def _table(levels: list[DataFrame]) -> DataFrame:
    each = [level.select("tree", F.lit(k).alias("level"), "pos", "hash") for k, level in enumerate(levels)]
    return reduce(DataFrame.unionAll, each)


def build(rows: DataFrame) -> Tree:
    """The tree over ``rows``: id, grp, leaf and any further columns.

    Groups and ids are in ascending order, NULL first (a NULL group is a group); rows of one id are
    in order of their leaf, and equal ones, which are leaves each, in the order they are stored.
    """
    stored = cut(rows, "leaves")
    stored = stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    leaves = numbered(stored, ["grp", "id", "leaf", "_file", "_row"], "order").drop("_file", "_row")
    sizes = cut(leaves.groupBy("grp").agg(F.min("g").alias("tree"), F.count("*").alias("n")), "groups")
    groups, most = sizes.agg(F.count("*"), F.max("n")).first()
    if not groups:
        none = leaves.select("*", *[F.lit(None).cast("long").alias(c) for c in ("tree", "n", "top")], F.lit(None).cast("string").alias("subroot"))
        return Tree(none, _table([none.select("tree", F.col("n").alias("c"), F.col("g").alias("pos"), F.col("leaf").alias("hash"))]), 0, None)
    order = numbered(sizes, ["tree"], "groups").withColumnRenamed("g", "top")

    def in_tree(trees: DataFrame) -> DataFrame:
        trees = trees.withColumnRenamed("grp", "_grp")
        return leaves.join(trees, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")

    levels = _levels(in_tree(sizes).select("tree", F.col("n").alias("c"), (F.col("g") - F.col("tree")).alias("pos"), F.col("leaf").alias("hash")), most)
    subroots = reduce(DataFrame.unionAll, [level.where("c = 1").select("tree", F.col("hash").alias("subroot")) for level in levels])
    order = cut(order.join(subroots, "tree"), "subroots")
    tops = _levels(order.select(F.lit(TOP).cast("long").alias("tree"), F.lit(groups).cast("long").alias("c"), F.col("top").alias("pos"), F.col("subroot").alias("hash")), groups)
    root = tops[-1].first().hash
    return Tree(in_tree(order), _table([*levels]).unionAll(_table(tops)), groups, root)


# ---- what one partition of leaves does


def _paths(trees: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Per tree and level that is not the last: tree, level, its nodes, the known places, the parents' places."""
    for tree in np.unique(trees):
        mine = trees == tree
        count, known, level = int(sizes[mine][0]), np.unique(places[mine]), 0
        while count > 1:
            parents = np.unique(known // FAN)
            yield int(tree), level, count, known, parents
            known, count, level = parents, -(-count // FAN), level + 1


def _children(parents: np.ndarray, count: int) -> np.ndarray:
    places = (parents[:, None] * FAN + np.arange(FAN)).ravel()
    return places[places < count]


def _coordinates(rows: pa.Table, groups: int) -> list[tuple[int, int, int, np.ndarray, np.ndarray]]:
    tree, n, g, top = (rows[c].to_numpy() for c in ("tree", "n", "g", "top"))
    up = np.full(len(top), TOP), np.full(len(top), groups), top
    return [*_paths(tree, n, g - tree), *_paths(*up)]


def _missing(rows: pa.Table, groups: int) -> pa.Table:
    """The union of the nodes that the proofs of these leaves need beside what the leaves give."""
    found = [np.zeros((0, 3), np.int64)]
    for tree, level, count, known, parents in _coordinates(rows, groups):
        lacking = np.setdiff1d(_children(parents, count), known, assume_unique=True)
        found.append(np.column_stack([np.full(len(lacking), tree), np.full(len(lacking), level), lacking]))
    tree, level, pos = np.concatenate(found).T
    p = np.full(len(tree), rows["p"][0].as_py())
    return pa.table({"p": p, "tree": tree, "level": level.astype(np.int32), "pos": pos})


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class _Runs:
    """Every run of siblings on the way of these leaves, interior nodes derived once."""

    def __init__(self, rows: pa.Table, fetched: pa.Table, groups: int):
        self.groups = groups
        hashes = dict(zip(zip(*(fetched[c].to_pylist() for c in ("tree", "level", "pos"))), fetched["hash"].to_pylist()))
        places = [rows[c].to_pylist() for c in ("tree", "g", "top", "leaf", "subroot")]
        for tree, g, top, own, subroot in zip(*places):
            hashes[tree, 0, g - tree] = own
            hashes[TOP, 0, top] = subroot
        #: By tree, level and parent the hashes of its children.
        self.runs: dict[tuple[int, int, int], list[str]] = {}
        for tree, level, count, _, parents in _coordinates(rows, groups):
            for parent in parents.tolist():
                run = [hashes[tree, level, at] for at in range(parent * FAN, min(count, parent * FAN + FAN))]
                self.runs[tree, level, parent] = run
                hashes[tree, level + 1, parent] = _sha("".join(run))
        self._ways: dict[tuple[int, int, int], tuple] = {}

    def way(self, tree: int, level: int, at: int, top: int) -> tuple:
        """From a node to the root, as nested pairs (before, after, rest): its run's other hashes."""
        key = tree, level, at
        if key not in self._ways:
            run = self.runs.get((tree, level, at // FAN))
            if run is not None:
                i = at % FAN
                self._ways[key] = (run[:i], run[i + 1 :], self.way(tree, level + 1, at // FAN, top))
            else:
                self._ways[key] = () if tree == TOP else self.way(TOP, 0, top, top)
        return self._ways[key]


def _steps(way: tuple) -> Iterator[tuple[list[str], list[str]]]:
    while way:
        before, after, way = way
        yield before, after


def fold(start: str, steps: Iterator[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and its proof lead to."""
    for before, after in steps:
        start = _sha("".join([*before, start, *after]))
    return start


def _ways(rows: pa.Table, fetched: pa.Table, groups: int) -> list[tuple]:
    runs = _Runs(rows, fetched, groups)
    return [runs.way(tree, 0, g - tree, top) for tree, g, top in zip(*(rows[c].to_pylist() for c in ("tree", "g", "top")))]


# ---- proofs and checks of many leaves


def _with_fetched(tree: Tree, wanted: DataFrame, function, schema: T.StructType, leaves: int) -> DataFrame:
    """``function(rows, fetched)`` on each partition of leaves and what it misses."""
    groups = tree.groups
    parted = wanted.withColumn("p", F.expr(f"g DIV {leaves}"))
    slim = parted.select("p", "tree", "n", "g", "top")
    lacking = slim.groupBy("p").applyInArrow(lambda rows: _missing(rows, groups), "p long, tree long, level int, pos long")
    high = (F.col("level") >= HIGH) | ((F.col("tree") == TOP) & (F.lit(groups <= FEW) | (F.col("level") >= 4)))
    lacking = lacking.withColumn("salt", F.when(high, F.col("p") % SALTS).otherwise(0).cast("int"))
    salts = F.when(high, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    nodes = tree.nodes.withColumn("salt", F.explode(salts))
    fetched = lacking.join(nodes, ["tree", "level", "pos", "salt"]).select("p", "tree", "level", "pos", "hash")
    return parted.groupBy("p").cogroup(fetched.groupBy("p")).applyInArrow(function, schema)


def _given(wanted: DataFrame) -> list[T.StructField]:
    inner = {"g", "tree", "n", "top", "subroot", "p"}
    return [f for f in wanted.schema if f.name not in inner]


def proofs(tree: Tree, wanted: DataFrame | None = None, *, leaves: int = LEAVES) -> DataFrame:
    """``wanted`` (all or some rows of ``tree.leaves``) with subroot, root and proof.

    A proof has a step per level, from the leaf to the root: the hashes before and after the node
    in its run. A lone leaf of a lone group has no steps.
    """
    wanted = tree.leaves if wanted is None else wanted
    given, root, groups = [f.name for f in _given(wanted)], tree.root, tree.groups
    step = T.StructType([T.StructField(c, T.ArrayType(T.StringType())) for c in ("before", "after")])
    added = [T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType()), T.StructField("proof", T.ArrayType(step))]

    def expand(rows: pa.Table, fetched: pa.Table) -> pa.Table:
        proof = [[{"before": b, "after": a} for b, a in _steps(way)] for way in _ways(rows, fetched, groups)]
        out = rows.select([*given, "subroot"]).append_column("root", pa.array([root] * len(proof), pa.string()))
        kind = pa.list_(pa.struct([("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))
        return out.append_column("proof", pa.array(proof, kind))

    return _with_fetched(tree, wanted, expand, T.StructType([*_given(wanted), *added]), leaves)


def audit(tree: Tree, wanted: DataFrame | None = None, *, seen: str = "seen", leaves: int = LEAVES) -> DataFrame:
    """``wanted`` held against the manifest: proof_sha256, folded_root and verified.

    ``seen`` is the leaf of a row as it is found now (NULL: as it was); it is folded with the
    siblings of its proof, and verified where that gives the root. ``proof_sha256`` is the hash of
    all siblings, level by level.
    """
    wanted = tree.leaves if wanted is None else wanted
    given, root, groups = [f.name for f in _given(wanted)], tree.root, tree.groups
    added = [T.StructField(c, T.StringType()) for c in ("subroot", "root", "proof_sha256", "folded_root")]
    added.append(T.StructField("verified", T.BooleanType()))

    def check(rows: pa.Table, fetched: pa.Table) -> pa.Table:
        digests, roots = [], []
        for way, own, now in zip(_ways(rows, fetched, groups), rows["leaf"].to_pylist(), rows[seen].to_pylist()):
            steps = list(_steps(way))
            digests.append(_sha("".join("".join(before) + "".join(after) for before, after in steps)))
            roots.append(fold(own if now is None else now, steps))
        out = rows.select([*given, "subroot"]).append_column("root", pa.array([root] * len(roots), pa.string()))
        for name, values in (("proof_sha256", digests), ("folded_root", roots)):
            out = out.append_column(name, pa.array(values, pa.string()))
        return out.append_column("verified", pa.array([r == root for r in roots], pa.bool_()))

    return _with_fetched(tree, wanted, check, T.StructType([*_given(wanted), *added]), leaves)
