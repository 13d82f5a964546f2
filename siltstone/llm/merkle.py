"""Merkle manifest of a dataset: one tree per source, one over the sources, and octopus multiproofs.

A node is named by its tree, its level (0: leaves) and its number there. Trees of sources are numbered
by the order of the sources; the tree over them is TOP, and its leaves are their roots.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltstone.llm.common import name, ready, settled
from siltstone.llm.order import with_place

ARITY = 16
TOP = -1
#: Leaves proved together by one task, as one partition of the manifest.
PART_LEAVES = 4096


def field_text(column: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest_of(columns: list[Column]) -> Column:
    return F.sha2(F.encode(F.concat(*(field_text(c) for c in columns)), "UTF-8"), 256)


def height(n: int) -> int:
    """Levels above the leaves of a tree with n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def level_above(nodes: DataFrame) -> DataFrame:
    """The parents of the nodes of one level: the digest of up to ARITY children, in their order."""
    children = F.array_sort(F.collect_list(F.struct("number", "digest")))
    joined = F.array_join(F.transform(children, lambda child: child["digest"]), "")
    return (
        nodes.groupBy("tree", F.floor(F.col("number") / ARITY).alias("above"))
        .agg(F.sha2(F.encode(joined, "UTF-8"), 256).alias("digest"), F.first("n").alias("n"))
        .select("tree", F.col("above").alias("number"), "digest", "n")
    )


def tree_levels(leaves: DataFrame, most: int) -> list[DataFrame]:
    """(tree, number, digest, n) of every level, from leaves with ``n``, the leaves of their tree.

    A level is written before the next is made from it. Trees that have come down to one node stop.
    """
    levels = [leaves.select("tree", "number", "digest", "n")]
    for k in range(height(most)):
        growing = levels[-1].where(F.col("n") > ARITY**k)
        levels.append(settled(level_above(growing), f"merkle-{k + 1}"))
    return levels


class Manifest:
    """Leaves and nodes of a dataset.

    ``leaves`` has the given columns beside ``tree``, ``number`` (within the tree), ``n`` (leaves of the
    tree), ``place`` (among all leaves) and ``digest``; ``nodes`` has every node of every tree.
    """

    def __init__(self, leaves: DataFrame, nodes: DataFrame, n_trees: int):
        self.leaves, self.nodes, self.n_trees = leaves, nodes, n_trees


def manifest(leaves: DataFrame, source: str, order: list[str], digest: str = "digest") -> Manifest:
    """Trees over ``leaves``: one per value of ``source`` (NULL first, then bytewise), each in the order of
    ``order`` and, among equals, of the digest. An empty table has no nodes.

    A source may hold any share of the rows: leaves are dealt by ranges, and parents gather ARITY
    children each. The driver gets the number of sources, the largest, and one count per task.
    """
    keys = [name(source).asc_nulls_first(), *(name(c).asc_nulls_first() for c in order), name(digest).asc()]
    placed = with_place(leaves, keys, "place", "merkle-leaves")
    sources = placed.groupBy(name(source).alias("source_")).agg(
        F.count("*").alias("n"), F.min("place").alias("first_")
    )
    sources = with_place(sources, [F.col("source_").asc_nulls_first()], "tree", "merkle-sources")
    size = sources.agg(F.count("*").alias("trees"), F.max("n").alias("most")).first()
    own = placed.join(sources, name(source).eqNullSafe(F.col("source_"))).drop("source_")
    own = own.withColumn("number", F.col("place") - F.col("first_")).drop("first_")
    levels = tree_levels(own.withColumnRenamed(digest, "digest"), size.most or 0)
    roots = [
        level.where((F.col("number") == 0) & (F.col("n") <= ARITY**k) & (F.col("n") > (ARITY ** (k - 1) if k else 0)))
        for k, level in enumerate(levels)
    ]
    tops = roots[0]
    for more in roots[1:]:
        tops = tops.unionByName(more)
    tops = tops.select(
        F.lit(TOP).cast("long").alias("tree"),
        F.col("tree").alias("number"),
        "digest",
        F.lit(size.trees).cast("long").alias("n"),
    )
    nodes = None
    for k, level in [*enumerate(levels), *enumerate(tree_levels(settled(tops, "merkle-tops"), size.trees))]:
        named = level.select("tree", F.lit(k).alias("level"), "number", "digest")
        nodes = named if nodes is None else nodes.unionByName(named)
    return Manifest(own, nodes, size.trees)


# ---- multiproofs -------------------------------------------------------------------------------


def spans(numbers: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level below the root: the numbers known there and the siblings that are not, both
    ascending, if the leaves ``numbers`` of a tree with n leaves are known."""
    known, found = np.unique(numbers), []
    while n > 1:
        parents = np.unique(known // ARITY)
        children = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        children = children[children < n]
        found.append((known, np.setdiff1d(children, known, assume_unique=True)))
        known, n = parents, -(-n // ARITY)
    return found


def missing_nodes(leaves: pd.DataFrame, n_trees: int) -> pd.DataFrame:
    """Coordinates of the fewest nodes that, with the given leaves, give the root."""
    rows = []

    def ask(tree: int, numbers: np.ndarray, n: int) -> None:
        for level, (_, absent) in enumerate(spans(numbers, n)):
            rows.extend((tree, level, int(x)) for x in absent)

    for tree, own in leaves.groupby("tree"):
        ask(tree, own["number"].to_numpy(), int(own["n"].iloc[0]))
    ask(TOP, leaves["tree"].to_numpy(), n_trees)
    return pd.DataFrame(rows, columns=["tree", "level", "number"])


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Octopus:
    """The nodes a partition knows: its leaves, what it fetched, and all that follows from them."""

    def __init__(self, leaves: pd.DataFrame, fetched: pd.DataFrame, n_trees: int):
        self.known = dict(zip(zip(fetched["tree"], fetched["level"], fetched["number"]), fetched["digest"]))
        self.groups: dict[tuple[int, int, int], str] = {}
        self.paths: dict[tuple[int, int, int], list[tuple[int, str]]] = {}
        self.sizes = {TOP: n_trees}
        self.roots: dict[int, str] = {}
        self.known.update(zip(zip(leaves["tree"], [0] * len(leaves), leaves["number"]), leaves["digest"]))
        for tree, own in leaves.groupby("tree"):
            self.sizes[tree] = int(own["n"].iloc[0])
            self.roots[tree] = self.known[(TOP, 0, tree)] = self.derive(tree, own["number"].to_numpy())
        self.root = self.derive(TOP, leaves["tree"].to_numpy())

    def derive(self, tree: int, numbers: np.ndarray) -> str:
        """The root of a tree; on the way each run of children that holds a known leaf, as one text."""
        n, level = self.sizes[tree], 0
        while n > 1:
            parents = np.unique(numbers // ARITY).tolist()
            for p in parents:
                children = range(p * ARITY, min((p + 1) * ARITY, n))
                text = self.groups[tree, level, p] = "".join(self.known[tree, level, c] for c in children)
                self.known[tree, level + 1, p] = sha(text)
            numbers, n, level = np.array(parents), -(-n // ARITY), level + 1
        return self.known[tree, level, 0]

    def path(self, tree: int, level: int, number: int) -> list[tuple[int, str]]:
        """(place among the children, all children) from a node up to the root, kept for shared parents."""
        key = (tree, level, number)
        if key not in self.paths:
            if -(-self.sizes[tree] // ARITY**level) > 1:
                p = number // ARITY
                step = (number % ARITY, self.groups[tree, level, p])
                self.paths[key] = [step, *self.path(tree, level + 1, p)]
            else:
                self.paths[key] = [] if tree == TOP else self.path(TOP, 0, tree)
        return self.paths[key]

    def proof(self, tree: int, number: int) -> tuple[list[tuple[int, str]], str]:
        """The path of a leaf and the digest of its siblings, level by level."""
        path = self.path(tree, 0, number)
        return path, sha("".join(text[: 64 * k] + text[64 * (k + 1) :] for k, text in path))


def folded(leaf: str, path: list[tuple[int, str]]) -> str:
    """The root that follows from a leaf and the siblings on its path."""
    for k, text in path:
        leaf = sha(text[: 64 * k] + leaf + text[64 * (k + 1) :])
    return leaf


def proofs(made: Manifest, claimed: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of the leaves with ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (the digest of all
    siblings from the leaf up), ``folded_root`` (what the path gives from the digest in column ``claimed``,
    NULL: its own) and ``verified``, whether that is the root.

    Leaves are dealt into partitions of neighbours. Each works out the fewest nodes it lacks, over all its
    leaves; these are fetched by one join; all roots, proofs and checks then follow inside the partition.
    A partition holds PART_LEAVES leaves and at most ARITY - 1 nodes per level and end of each run.
    """
    n_trees = made.n_trees
    own = made.leaves.withColumn("part", F.floor(F.col("place") / PART_LEAVES))
    kept = [name(c).alias(f"c{k}") for k, c in enumerate(keep)]
    leaves = own.select("part", "tree", "number", "n", "digest", name(claimed).alias("claimed"), *kept)

    def lacking(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        absent = missing_nodes(rows, n_trees)
        absent.insert(0, "part", key[0])
        return absent

    coordinates = leaves.select("part", "tree", "number", "n").groupBy("part")
    asked = coordinates.applyInPandas(lacking, "part bigint, tree bigint, level int, number bigint")
    fetched = made.nodes.join(asked, ["tree", "level", "number"])
    fetched = settled(fetched.select("part", "tree", "level", "number", "digest"), "merkle-fetched")
    results = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def prove(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        plain = rows.select(["tree", "number", "n", "digest"]).to_pandas()
        octopus = Octopus(plain, nodes.to_pandas(), n_trees)
        found = []
        others = rows.column("claimed").to_pylist()
        for tree, number, digest, other in zip(plain["tree"], plain["number"], plain["digest"], others):
            path, summary = octopus.proof(tree, number)
            found.append((digest, octopus.roots[tree], octopus.root, summary, folded(other or digest, path)))
        texts = [pa.array(x, pa.string()) for x in zip(*found)]
        held = [rows.column(f"c{k}") for k in range(len(keep))]
        return pa.table([*held, *texts], [*(f"c{k}" for k in range(len(keep))), *results])

    types = StructType(
        [StructField(f"c{k}", made.leaves.schema[c].dataType) for k, c in enumerate(keep)]
        + [StructField(c, StringType()) for c in results]
    )
    out = leaves.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(prove, types)
    return out.toDF(*keep, *results).withColumn("verified", F.col("folded_root") == F.col("root"))


def document_proofs(docs: DataFrame, fields: list[str], tampered: dict[str, Column], when: Column) -> DataFrame:
    """A manifest of documents (a leaf per row over ``fields``, a tree per ``source``, in the order of
    ``doc_id``) and the proof of every row, checked against its own content or, ``when`` that holds, against
    the content in which ``tampered`` replaces fields.

    NULL fields count as ``-``, NULL ids come first, repeated rows are leaves of their own. Other columns
    are ignored; an empty table gives no rows.
    """
    ready(docs.sparkSession)
    changed = [tampered.get(c, name(c)) for c in fields]
    leaves = docs.select(
        name("doc_id"),
        name("source"),
        digest_of([name(c) for c in fields]).alias("digest"),
        F.when(when, digest_of(changed)).alias("claimed"),
    )
    made = manifest(settled(leaves, "merkle-digests"), "source", ["doc_id"])
    return proofs(made, "claimed", ["doc_id"])
