"""Placing documents into shards by a hierarchical weighted hash tree (operator 4).

The tree has regions, racks and shards. At each level every child draws ln(u) / weight, u being
a hash of the document id and the child's name; the largest draw wins. A child wins in
proportion to its weight, and draws of children do not depend on each other: a weight that
grows only pulls rows into its subtree, one that shrinks only gives rows away. A new shard
therefore opens as a subtree of its own, so that no row moves between old shards.

Law ``key``: the id and the number of shards alone decide, equal texts included.

Defined results: a null text has no bytes (size 16) and the checksum of the empty text; rows
with a null id draw as the empty id and share a shard, as rows that repeat an id do; slots
count every row once; an empty table gives no rows; extra columns are not read.

Everything is built from column functions; no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import in_order, text_of

SHARDS = 40
ROW_OVERHEAD = 16
# region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]


def even_tree(shards: int = SHARDS, regions: int = 2, racks: int = 4) -> Tree:
    """``shards`` shards of weight one, dealt in order over the racks of the regions."""
    tree: Tree = {}
    for shard in range(shards):
        region, rack = shard * regions // shards, shard * regions * racks // shards % racks
        tree.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, in a region of its own."""
    new = 1 + max(shard for racks in tree.values() for shards in racks.values() for shard in shards)
    return {**tree, f"region-of-{new}": {"rack0": {new: weight}}}


def _children(tree: Tree) -> Column:
    """The tree as a map from a node's path to its children and their weights."""
    rack_weight = {(r, k): sum(shards.values()) for r, racks in tree.items() for k, shards in racks.items()}
    nodes = {"": {r: sum(rack_weight[r, k] for k in racks) for r, racks in tree.items()}}
    for r, racks in tree.items():
        nodes[f"/{r}"] = {k: rack_weight[r, k] for k in racks}
        for k, shards in racks.items():
            nodes[f"/{r}/{k}"] = {str(s): w for s, w in shards.items()}
    pairs = []
    for path, children in nodes.items():
        listed = [F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in children.items()]
        pairs += [F.lit(path), F.array(*listed)]
    return F.create_map(*pairs)


def _descend(children: Column, path: Column, key: Column) -> Column:
    """The path of the child with the largest draw; equal draws go to the later name."""

    def drawn(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.concat_ws("/", path, child["name"]), key), 11)
        draw = F.ln((bits + F.lit(1)) / F.lit(float(2**53))) / child["weight"]
        return F.struct(draw.alias("draw"), child["name"].alias("name"))

    return F.concat_ws("/", path, F.array_max(F.transform(F.element_at(children, path), drawn))["name"])


def place(df: DataFrame, tree: Tree, key: Column, out: str) -> DataFrame:
    """``df`` with the shard of every row in ``out``, one level of the tree after the other."""
    children = _children(tree)
    df = df.withColumn("_path", F.lit(""))
    for _ in ("region", "rack", "shard"):
        df = df.withColumn("_path", _descend(children, F.col("_path"), key))
    return df.withColumn(out, F.substring_index("_path", "/", -1).cast("int")).drop("_path")


def shard(docs: DataFrame, tree: Tree, larger: Tree | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    text = text_of(text_column)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    rows = place(rows, tree, key, "shard")
    rows = place(rows, larger, key, "grown_shard") if larger else rows.withColumn("grown_shard", F.lit(None).cast("int"))
    # Sorting by shard and a hash of the whole row splits a shard, and a repeated id, over many tasks.
    spread = F.xxhash64("doc_id", "text_crc32", "size")
    placed = in_order(rows, F.col("shard"), spread)
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))
    slotted = placed.join(F.broadcast(firsts), "shard")  # a row per shard of the tree
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("position") - F.col("first")).alias("slot"), "grown_shard",
    )


def shares(tree: Tree) -> dict[int, float]:
    """The share of all rows every shard should get."""
    weights = reduce(lambda a, b: a | b, (s for racks in tree.values() for s in racks.values()))
    return {s: w / sum(weights.values()) for s, w in weights.items()}
