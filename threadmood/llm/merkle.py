"""A manifest of a dataset as a Merkle tree per group of rows and one over the groups.

Every node is the SHA-256, in hex, of up to FAN children's hex digests one after the other. A
parent keeps a copy of its hash state before each child slot. To fold a changed child upwards the
matching state is resumed with the replacement and the right siblings only; what stands to the
left is in the state already.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from threadmood.llm.shared import stored

#: Children of a node.
FAN = 16
#: Levels that are folded inside one group of rows: FAN ** LEVELS leaves of a tree that follow each other.
LEVELS = 3
CHUNK = FAN**LEVELS


def digest_of(*values: Column) -> Column:
    """SHA-256 of values one after the other, each as its UTF-8 byte count, ``:`` and itself, or ``-`` if NULL."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.sha2(F.concat(*parts), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: every row with its tree, its position there and the tree's size; ``chunks``: per CHUNK
    leaves of a tree, the way up from there to the root, and the tree's own root; ``root``: that of all."""

    leaves: DataFrame
    chunks: DataFrame
    root: str | None


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes with ``position`` in their ``tree`` and ``total``, its size, by ``tree`` and then the order.

    Rows are sorted over the cluster and counted per tree and partition; only these counts are
    summed up in order, so no tree has to fit into one task. Rows that are equal throughout are
    told apart by their place in the stored input, and may spread over partitions too.
    """
    keys = ["tree", *order, "place"]
    placed = nodes.withColumn("place", F.monotonically_increasing_id())
    sorted_ = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("place")
    rows = stored(sorted_.withColumn("row", F.monotonically_increasing_id()), "merkle-sorted")
    rows = rows.withColumn("stretch", F.shiftright("row", 33))
    counts = rows.groupBy("tree", "stretch").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    whole = Window.partitionBy("tree")
    before = F.sum("n").over(whole.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("tree", "stretch", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total"))
    position = F.col("before") + F.col("row") - F.col("first")
    return rows.join(counts, ["tree", "stretch"]).withColumn("position", position).drop("row", "stretch", "first", "before")


def _families(nodes: DataFrame) -> DataFrame:
    """(tree, position, total, children) of the parents of all nodes (tree, position, total, digest)."""
    ordered = F.sort_array(F.collect_list(F.struct("position", "digest")))
    return nodes.groupBy("tree", F.floor(F.col("position") / FAN).alias("position")).agg(
        F.ceil(F.max("total") / FAN).alias("total"), F.transform(ordered, lambda x: x["digest"]).alias("children"), F.max("total").alias("below")
    )


def _parents(families: DataFrame) -> DataFrame:
    """Their nodes; a tree's only node is its root and is not hashed again."""
    joined = F.sha2(F.array_join("children", ""), 256)
    digest = F.when(F.col("below") > 1, joined).otherwise(F.col("children")[0])
    return families.select("tree", "position", "total", digest.alias("digest"))


def _ways(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For each node the slots and children it passes on the way up, from below: (tree, position, way); and (tree, digest) of all roots."""
    ways = nodes.select("tree", "position", F.array().cast("array<struct<slot: int, children: array<string>>>").alias("way"))
    step, most = 1, nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        families = stored(_families(nodes), "merkle-level")
        above = families.where("below > 1").select("tree", F.col("position").alias("parent"), "children")
        slot = (F.floor(F.col("position") / step) % FAN).cast("int")
        longer = F.concat("way", F.array(F.struct(slot.alias("slot"), "children")))
        parent = F.floor(F.col("position") / (step * FAN))
        ways = (
            ways.withColumn("parent", parent)
            .join(above, ["tree", "parent"], "left")
            .select("tree", "position", F.when(F.col("children").isNull(), F.col("way")).otherwise(longer).alias("way"))
        )
        nodes, step, most = _parents(families), step * FAN, -(-most // FAN)
    return ways, nodes.select("tree", "digest")


def build(df: DataFrame, id_col: str, group_col: str, leaf_col: str, instead_col: str | None = None) -> Manifest:
    """The manifest of df's rows, whose hex digest is ``leaf_col``; a digest that is to be tried in its place stays with it.

    Leaves of a group ascend by id (NULL first, then by digest), trees by group (NULL first, then
    bytewise). Equal rows are leaves of their own; other columns are ignored. An empty table has no root.
    """
    group = F.col(group_col).cast("string")
    tree = F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group))
    instead = F.col(instead_col) if instead_col else F.lit(None)
    rows = df.select(F.col(id_col).alias("id"), tree.alias("tree"), F.col(leaf_col).alias("leaf"), instead.cast("string").alias("instead"))
    rows = stored(rows, "merkle-leaves")
    leaves = stored(_numbered(rows, ["id", "leaf", "instead"]), "merkle-numbered")
    nodes = leaves.select("tree", "position", "total", F.col("leaf").alias("digest"))
    for _ in range(LEVELS):
        nodes = _parents(_families(nodes))
    chunks, roots = _ways(stored(nodes, "merkle-chunks"))
    roots = stored(roots.select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest"), "merkle-roots")
    numbered = stored(_numbered(roots, ["member"]), "merkle-trees")
    up, top = _ways(numbered.select("tree", "position", "total", "digest"))
    trees = numbered.join(up, ["tree", "position"]).select(F.col("member").alias("tree"), F.col("digest").alias("subroot"), F.col("way").alias("rest"))
    whole = chunks.join(trees, "tree").select("tree", F.col("position").alias("chunk"), F.concat("way", "rest").alias("way"), "subroot")
    root = top.first()
    return Manifest(leaves, stored(whole, "merkle-ways"), root["digest"] if root else None)


class Parent:
    """A node over some children: its digest, and its hash state before each child."""

    def __init__(self, children: list[bytes]):
        self.children, self.before = children, []
        state = hashlib.sha256()
        for child in children:
            self.before.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()
        self.rights = [b"".join(children[i + 1 :]) for i in range(len(children))]
        self.siblings = [b"".join(children[:i]) + right for i, right in enumerate(self.rights)]

    def folded(self, slot: int, child: bytes) -> bytes:
        """The digest with another child in the slot."""
        state = self.before[slot].copy()
        state.update(child + self.rights[slot])
        return state.hexdigest().encode()


def _fold(way: list[dict], total: int, own: list[bytes], instead: list[bytes | None]) -> tuple[list[bytes], list[str]]:
    """Of the leaves of a chunk in order: the root with the replacement folded in, and the digest of all siblings."""
    found = [new or old for new, old in zip(instead, own, strict=True)]
    proofs = [hashlib.sha256() for _ in own]
    nodes, step = own, 1
    for _ in range(LEVELS):
        if total <= 1:
            break
        parents = [Parent(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        for i, proof in enumerate(proofs):
            parent, slot = parents[i // (step * FAN)], i // step % FAN
            proof.update(parent.siblings[slot])
            found[i] = parent.folded(slot, found[i])
        nodes, step, total = [parent.digest for parent in parents], step * FAN, -(-total // FAN)
    for family in way:
        parent, slot = Parent([child.encode() for child in family["children"]]), family["slot"]
        for i, proof in enumerate(proofs):
            proof.update(parent.siblings[slot])
            found[i] = parent.folded(slot, found[i])
    return found, [proof.hexdigest() for proof in proofs]


def proofs(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root, verified) per row of the manifest.

    ``proof`` is the SHA-256 of the siblings' digests, level by level from the leaf to the root.
    ``folded_root`` is the root that follows from the digest to be tried where there is one, and from
    the leaf itself elsewhere; ``verified`` says that it is the manifest's. Rows are taken together by CHUNK at most, however large a tree is.
    """
    chunk = F.floor(F.col("position") / CHUNK)
    rows = manifest.leaves.select("tree", chunk.alias("chunk"), "position", "total", "id", "leaf", "instead")
    id_field = T.StructField("id", manifest.leaves.schema["id"].dataType)
    schema = T.StructType([id_field, *(T.StructField(name, T.StringType()) for name in ("leaf", "subroot", "proof", "folded_root"))])

    def fold(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("position")
        own = [x.encode() for x in left["leaf"].to_pylist()]
        new = [None if x is None else x.encode() for x in left["instead"].to_pylist()]
        way = right.to_pylist()[0]
        found, digests = _fold(way["way"], left["total"][0].as_py(), own, new)
        return pa.table(
            {
                "id": left["id"],
                "leaf": left["leaf"],
                "subroot": pa.array([way["subroot"]] * len(own), pa.string()),
                "proof": pa.array(digests, pa.string()),
                "folded_root": pa.array([x.decode() for x in found], pa.string()),
            }
        )

    keys = ["tree", "chunk"]
    folded = rows.groupBy(*keys).cogroup(manifest.chunks.groupBy(*keys)).applyInArrow(fold, schema)
    root = F.lit(manifest.root).cast("string")
    return folded.select("id", "leaf", "subroot", root.alias("root"), "proof", "folded_root", (F.col("folded_root") == root).alias("verified"))
