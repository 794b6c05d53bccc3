"""Merkle manifest of a dataset with nested-interval labels.

Rows are leaves of one tree a group, ordered by id; the trees' roots are the leaves of one more tree over the groups. A
node is labelled by its tree and the interval [lo, hi) of the leaf ranks that it covers. Ranks come from the
library's blocked scan, so a group that holds most of the rows is cut into blocks. Nodes are made level by level: the up
to ``fanout`` intervals of one bucket of a level, ``lo`` over the level's width, become the children of one node.

Proofs go down again: the nodes of a level are joined by tree and bucket with the level above, where the parent's interval
must contain theirs, and take over its proof. What the parent's interval holds beside the node's own is where its siblings
lie, on the left and on the right. No key of such a join has more than ``fanout`` rows on one side or one on
the other. Everything runs as built-in functions; each level is written to the shared folder once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.operators.blocks import FANOUT, measured_blocks
from tidemark.operators.scan import Scan, scan

#: Leaves of a group that one task orders.
BLOCK_ROWS = 4096


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tree_name(group: Column) -> Column:
    """A name for each group that is never null; names order as the groups do, a null group first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


@dataclass
class Tree:
    """steps[i]: the nodes of level i + 1 (tree, bucket, lo, hi, digest, children, lone). A lone row closes its tree: its only child is the root."""
    steps: list[DataFrame]
    fanout: int

    def roots(self) -> DataFrame:
        """(tree, lo, hi, digest) of each tree's root."""
        found = None
        for step in self.steps:
            own = step.where("lone").select("tree", "lo", "hi", "digest")
            found = own if found is None else found.unionByName(own)
        return found

    def nodes(self) -> DataFrame:
        """(tree, level, lo, hi, digest) of the inner nodes of all trees."""
        found = None
        for i, step in enumerate(self.steps):
            own = step.where("not lone").select("tree", F.lit(i + 1).alias("level"), "lo", "hi", "digest")
            found = own if found is None else found.unionByName(own)
        return found


def grow(leaves: DataFrame, name: str, fanout: int) -> Tree:
    """The trees over leaves (tree, lo, hi, digest) with ranks from 0 in each tree."""
    level, width, steps = leaves.select("tree", "lo", "hi", "digest"), 1, []
    while True:
        width *= fanout
        bucket = F.floor(F.col("lo") / F.lit(width)).cast("long")
        runs = level.groupBy("tree", bucket.alias("bucket")).agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
        lone = (F.col("bucket") == 0) & (F.size("children") == 1)  # ranks begin at 0: there is no other node
        hashed = F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), ""), 256)
        step = runs.select("tree", "bucket", F.element_at("children", 1)["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
                           F.when(lone, F.element_at("children", 1)["digest"]).otherwise(hashed).alias("digest"), "children", lone.alias("lone"))
        steps.append(common.written(leaves.sparkSession, step, f"{name}_level"))
        level = steps[-1].where("not lone")
        if level.isEmpty():
            return Tree(steps, fanout)


def _climb(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """Each node with its parent's ``root`` and its own proof: a row a level with what lies left and right of it."""
    kept = [c for c in nodes.columns if c != "children"]
    p = parents.select(F.col("tree").alias("p_tree"), F.col("bucket").alias("p_bucket"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), F.col("children").alias("p_children"),
                       F.col("lone").alias("p_lone"), F.col("proof").alias("p_proof"), F.col("root").alias("p_root"))
    contained = (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
    joined = nodes.join(p, (F.col("tree") == F.col("p_tree")) & (F.floor(F.col("lo") / F.lit(width)).cast("long") == F.col("p_bucket")) & contained)
    text = lambda inside: F.array_join(F.transform(F.filter("p_children", inside), lambda c: c["digest"]), "")
    own = F.struct(text(lambda c: c["hi"] <= F.col("lo")).alias("left"), text(lambda c: c["lo"] >= F.col("hi")).alias("right"))
    proof = F.when(F.col("p_lone"), F.col("p_proof")).otherwise(F.concat(F.array(own), F.col("p_proof")))
    return joined.select(*kept, *(["children"] if "children" in nodes.columns else []), proof.alias("proof"), F.col("p_root").alias("root"))


def attach(leaves: DataFrame, tree: Tree, tops: DataFrame) -> DataFrame:
    """``leaves`` with proof and root; ``tops`` has (tree, proof, root), how to go on from each tree's root."""
    parents = None
    for i in reversed(range(len(tree.steps))):
        step = tree.steps[i]
        here = step.where("lone").join(tops, "tree")
        if parents is not None:
            here = here.unionByName(_climb(step.where("not lone"), parents, tree.fanout ** (i + 2)))
        parents = here
    return _climb(leaves, parents, tree.fanout)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


@dataclass
class Manifest:
    """leaves: (tree, lo, hi, id, digest, carried columns). groups: (tree, lo, hi, digest), the groups' roots as leaves. within, over: their trees."""
    leaves: DataFrame
    groups: DataFrame
    within: Tree
    over: Tree

    def root(self) -> str | None:
        """The digest of the dataset; None for an empty one."""
        found = self.over.roots().first()
        return found["digest"] if found else None

    def proofs(self) -> DataFrame:
        """The leaves with ``subroot``, ``root`` and ``proof``, an array with the digests (left, right) beside the leaf's way up, one for each level."""
        ends = self.over.roots().select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("proof"), F.col("digest").alias("root"))
        tops = attach(self.groups.select(F.col("tree").alias("group"), F.lit("").alias("tree"), "lo", "hi", "digest"), self.over, ends)
        tops = common.written(tops.sparkSession, tops.select(F.col("group").alias("tree"), "proof", F.struct(F.col("digest").alias("subroot"), "root").alias("root")), "tops")
        found = attach(self.leaves, self.within, tops)
        return found.select(*self.leaves.columns, "proof", "root.subroot", "root.root")


def _ranked(rows: DataFrame, keys: list[str], order: list[str], position: Column, block_rows: int) -> DataFrame:
    """``rows`` with the interval [lo, hi) of their rank in ``order`` among those of their keys."""
    cut, block = measured_blocks(rows, keys=keys, at=position, rows=block_rows)
    found = scan(cut, keys=keys, order=order, block=block, specs={"hi": Scan("count")}, fanout=FANOUT)
    return found.select(*rows.columns, (F.col("hi") - 1).alias("lo"), "hi")


def manifest(docs: DataFrame, columns: list[str], *, group_col: str = "lang", id_col: str = "doc_id", fanout: int = 8, carried: dict[str, Column] | None = None,
             block_rows: int = BLOCK_ROWS) -> Manifest:
    """The manifest of all rows of ``docs``: a leaf is the digest of ``columns``, ``carried`` columns stay beside it.

    Groups order by their text, bytewise, a null one first; leaves by id (a whole number), null ids first, rows of one id
    by their digest. Rows that repeat are leaves each. Null and empty values differ. Other columns don't count.
    An empty table has no root and no leaves. The leaves are written once, without the columns they are made of.
    """
    spark = docs.sparkSession
    own = docs.select(tree_name(docs[group_col]).alias("tree"), docs[id_col].alias("id"), leaf(docs, columns).alias("digest"), *[c.alias(n) for n, c in (carried or {}).items()])
    own = common.written(spark, own, "leaves")
    leaves = common.written(spark, _ranked(own, ["tree"], ["id", "digest"], F.col("id"), block_rows), "ranked")
    within = grow(leaves, "within", fanout)
    roots = within.roots().select("tree", "digest")
    beginning = F.conv(F.rpad(F.substring(F.hex(F.col("tree").cast("binary")), 1, 14), 14, "0"), 16, 10).cast("long")  # seven bytes of the name order as names do
    groups = common.written(spark, _ranked(roots, [], ["tree"], beginning, block_rows), "groups")
    over = grow(groups.select(F.lit("").alias("tree"), "lo", "hi", "digest"), "over", fanout)
    return Manifest(leaves, groups, within, over)


def leaf(docs: DataFrame, columns: list[str], instead: dict[str, Column] | None = None) -> Column:
    """The digest of a row's ``columns``, some of them replaced by what ``instead`` has."""
    return digest(*[encoded((instead or {}).get(c, docs[c])) for c in columns])
