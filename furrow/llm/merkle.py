"""Merkle manifest of a dataset: a tree for each source, a tree over the sources, and a proof for every row.

Nodes are lowercase hex SHA-256 digests; every ``fan`` consecutive nodes of a
level (the last run: fewer, even one) are concatenated and hashed into a node of
the next, until one is left.

Trees are worked on by superblocks of ``fan ** height`` consecutive nodes, which
are whole subtrees:

1. Upward. The nodes of a superblock are reduced together (one group in
   ``applyInPandas``) to their node ``height`` levels above; these are
   the nodes of the next tier, until each tree has one superblock. The subroots,
   numbered by source, are the first tier of the tree over the sources.
2. Downward. A superblock's nodes are cogrouped with the one row of outer
   nodes that their paths share, from the tier above. The group finishes the reduction
   inside the superblock, joins each node's inner siblings with the outer ones,
   and hands the paths on to the tier below, or for leaves folds them.

Numbers within a source come from a distributed rank, so a source that holds
most rows is split among tasks by range and by superblock. A group holds
``fan ** height`` narrow rows at most; texts are hashed where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import Scratch
from furrow.operators.ranking import rank_in_group

FAN = 3
HEIGHT = 7


def digest(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


def field(value: Column) -> Column:
    """A column's part of a leaf: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


def levels(nodes: list[str], fan: int, height: int | None = None) -> list[list[str]]:
    """The nodes and every level above them: ``height`` levels, or until one node is left."""
    out = [nodes]
    while len(out[-1]) > 1 if height is None else len(out) <= height:
        last = out[-1]
        out.append([digest("".join(last[i : i + fan])) for i in range(0, len(last), fan)])
    return out


def paths(nodes: list[list[str]], fan: int) -> Iterator[tuple[list[str], list[str]]]:
    """For each node of the lowest level its siblings, level by level: those before it and those after it, concatenated."""
    steps = []
    for level in nodes[:-1]:
        runs = [level[i : i + fan] for i in range(0, len(level), fan)]
        steps.append([("".join(run[:i]), "".join(run[i + 1 :])) for run in runs for i in range(len(run))])
    for at in range(len(nodes[0])):
        left, right = [], []
        for step in steps:
            left.append(step[at][0])
            right.append(step[at][1])
            at //= fan
        yield left, right


def fold(leaf: str, left: list[str], right: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for a, b in zip(left, right, strict=True):
        leaf = digest(a + leaf + b)
    return leaf


def block_paths(nodes: pd.DataFrame, alone: bool, fan: int, height: int) -> Iterator[tuple[list[str], list[str]]]:
    """Siblings, inside their superblock, of its nodes in order; ``alone``: the tree has no other superblock."""
    return paths(levels(nodes["node"].tolist(), fan, None if alone else height), fan)


NODES = "tree string, idx long, top string, full string"
PATHS = "tree string, block long, alone boolean, left array<string>, right array<string>"


class Forest:
    """Trees of nodes ``tree, idx`` (from 0 within its tree) ``, node``, by tiers of superblocks.

    ``tiers[k]``: the nodes of tier k with their ``block``; ``ends[k]``: roots (``tree, node``) of the trees that are one superblock there.
    """

    def __init__(self, scratch: Scratch, name: str, nodes: DataFrame, fan: int, height: int):
        self.scratch, self.name, self.fan, self.height = scratch, name, fan, height
        self.tiers, self.ends = [], []

        def block_roots(group: pd.DataFrame) -> pd.DataFrame:
            own = group.sort_values("idx")["node"].tolist()
            # a tree's only superblock ends where one node is left, any other after its height
            out = (levels(own, fan)[-1][0], levels(own, fan, height)[-1][0])
            return pd.DataFrame([(group["tree"].iloc[0], group["block"].iloc[0], *out)], columns=["tree", "idx", "top", "full"])

        more = True
        while more:
            self.tiers.append(nodes.withColumn("block", F.floor(F.col("idx") / F.lit(fan**height)).cast("long")))
            tier = self.tiers[-1].select("tree", "block", "idx", "node")
            done = scratch.write(tier.groupBy("tree", "block").applyInPandas(block_roots, NODES), f"{name}-{len(self.tiers)}")
            # superblocks are numbered without gaps: a tree that has only one has no number 1
            several = done.where("idx = 1").select("tree")
            self.ends.append(done.join(several, "tree", "left_anti").select("tree", F.col("top").alias("node")))
            nodes = done.join(several, "tree", "left_semi").select("tree", "idx", F.col("full").alias("node"))
            more = not several.isEmpty()

    def roots(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.ends)

    def outer(self, above: DataFrame) -> DataFrame:
        """The outer nodes of every superblock of the lowest tier: ``tree, block, alone, left, right``.

        ``above``: ``tree, left, right``, what is above the trees' roots. ``alone``: the tree has no other superblock.
        """

        fan, height = self.fan, self.height

        def down(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
            row, nodes = outer.iloc[0], nodes.sort_values("idx")
            rows = [(row["tree"], i, False, [*a, *row["left"]], [*b, *row["right"]]) for i, (a, b) in zip(nodes["idx"], block_paths(nodes, row["alone"], fan, height), strict=True)]
            return pd.DataFrame(rows, columns=["tree", "block", "alone", "left", "right"])

        known = None
        for k in range(len(self.tiers) - 1, -1, -1):
            # a tree enters at the tier where it is one superblock
            enter = above.join(self.ends[k], "tree", "left_semi").select("tree", F.lit(0).cast("long").alias("block"), F.lit(True).alias("alone"), "left", "right")
            known = self.scratch.write(enter if known is None else enter.unionByName(known), f"{self.name}-outer{k}")
            if k:
                known = self.tiers[k].groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInPandas(down, PATHS)
        return known


def manifest(
    docs: DataFrame, columns: list[str], tampered: Column, id_col: str = "doc_id", source_col: str = "source", fan: int = FAN, height: int = HEIGHT
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``columns``: those that a leaf is hashed from, in this order. ``tampered``: the
    leaf digest that is presented for the row instead of its own, null where it is its own; it is only
    folded, the tree and the proof are of the rows as they are. ``proof_sha256``:
    the hash of the row's siblings up to the root.

    Leaves of a source ascend by id, null first; rows with equal ids by leaf
    digest, and rows that are equal throughout are neighbours, so the result does
    not depend on partitioning. A null source is a source of its own, before all
    others, apart from the empty string. Null columns are ``-``. Columns not named are not read. No rows in, no rows out.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "merkle")
    # a null source has a key of its own that sorts first
    tree = F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit(""))
    # written before they are sorted by range, which reads twice: texts are hashed once
    rows = scratch.write(docs.select(tree.alias("tree"), F.col(id_col).cast("long").alias("doc_id"), leaf_digest([F.col(c) for c in columns]).alias("node"), tampered.alias("shown")), "rows")
    numbered = rank_in_group(rows, ["tree"], [F.asc_nulls_first("doc_id"), "node"])
    # ids travel as text, since pandas would make floating-point numbers of a column with nulls
    leaves = scratch.write(numbered.select("tree", (F.col("rank") - 1).alias("idx"), F.col("doc_id").cast("string").alias("doc_id"), "node", "shown"), "leaves")

    sources = Forest(scratch, "source", leaves, fan, height)
    subroots = scratch.write(sources.roots(), "subroots")
    whole = rank_in_group(subroots, [], ["tree"]).select(F.lit("").alias("tree"), (F.col("rank") - 1).alias("idx"), "node", F.col("tree").alias("source"))
    top = Forest(scratch, "top", scratch.write(whole, "whole"), fan, height)
    found = top.roots().first()
    root = found["node"] if found else ""

    none = F.array().cast("array<string>")
    start = spark.range(1).select(F.lit("").alias("tree"), none.alias("left"), none.alias("right"))

    def to_sources(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        if nodes.empty:
            return pd.DataFrame([], columns=["tree", "subroot", "left", "right"])
        row, nodes = outer.iloc[0], nodes.sort_values("idx")
        made = [(s, n, [*a, *row["left"]], [*b, *row["right"]]) for s, n, (a, b) in zip(nodes["source"], nodes["node"], block_paths(nodes, row["alone"], fan, height), strict=True)]
        return pd.DataFrame(made, columns=["tree", "subroot", "left", "right"])

    def finish(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        row, nodes = outer.iloc[0], nodes.sort_values("idx")
        left, right = list(row["left"]), list(row["right"])
        beyond = "".join(a + b for a, b in zip(left, right, strict=True))
        made = []
        for doc_id, leaf, shown, (a, b) in zip(nodes["doc_id"], nodes["node"], nodes["shown"], block_paths(nodes, row["alone"], fan, height), strict=True):
            proof = digest("".join(x + y for x, y in zip(a, b, strict=True)) + beyond)
            folded = fold(fold(shown if isinstance(shown, str) else leaf, a, b), left, right)
            made.append((doc_id, leaf, row["subroot"], root, proof, folded, folded == root))
        return pd.DataFrame(made, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    by = ("tree", "block")
    per_source = top.tiers[0].groupBy(*by).cogroup(top.outer(start).groupBy(*by)).applyInPandas(to_sources, "tree string, subroot string, left array<string>, right array<string>")
    per_source = scratch.write(per_source, "sources")
    outer = scratch.write(sources.outer(per_source.drop("subroot")).join(per_source.select("tree", "subroot"), "tree"), "outer")
    scratch.drop(*(key for key in list(scratch.paths) if key not in ("leaves", "outer")))
    made = sources.tiers[0].groupBy(*by).cogroup(outer.groupBy(*by)).applyInPandas(
        finish, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


#: The columns of a document's leaf, in the order of their hashing.
DOCUMENT = ["doc_id", "source", "lang", "n_chars", "text"]


def document_manifest(docs: DataFrame, fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """The manifest of documents, where every second id (by the CRC-32 of the id as text) is shown with its line feeds deleted."""
    struck = [F.translate("text", "\n", "") if c == "text" else F.col(c) for c in DOCUMENT]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(docs, DOCUMENT, F.when(even, leaf_digest(struck)), fan=fan, height=height)
