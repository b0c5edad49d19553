"""Shards by a weighted hash tree: region, rack, shard.

At each level every child draws ``-ln(u) / weight`` with ``u`` from a hash of the document key and
the child's name, and the smallest draw wins. A child wins in proportion to its weight, and when
the weights of one subtree change, documents move only into or out of that subtree. New capacity
is added as a region of its own, so the one shard that is new is the only one that takes rows.

Slots are gapless within a shard. They are numbered in ranges of the key's hash, so that no task
needs a whole shard; the table of range sizes has ``shards * RANGES`` rows by construction.

Defined results: a null key is placed as the empty text, null text has no bytes, rows with equal
keys share a shard, an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

RANGES = 256
ROW_BYTES = 16

Tree = dict[str, dict[str, dict[int, float]]]


def even_tree(regions: int, racks: int, shards: int) -> Tree:
    """A tree with equal weights; shards are numbered from 0 in order."""
    return {
        f"r{i}": {f"k{j}": {(i * racks + j) * shards + s: 1.0 for s in range(shards)} for j in range(racks)}
        for i in range(regions)
    }


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    new = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return tree | {f"r{len(tree)}": {"k0": {new: weight}}}


def _weight(node) -> float:
    return sum(_weight(x) for x in node.values()) if isinstance(node, dict) else node


def _children(node, path: str = "") -> dict[str, list[tuple[str, float]]]:
    """Of every inner node, by path: its children's paths and weights."""
    if not isinstance(node, dict):
        return {}
    out = {path: [(f"{path}/{name}", float(_weight(child))) for name, child in node.items()]}
    for name, child in node.items():
        out |= _children(child, f"{path}/{name}")
    return out


def draw(key: Column, path: Column, weight: Column) -> Column:
    """An exponential draw: 52 bits of MD5 as a uniform number, over the weight."""
    bits = F.conv(F.substring(F.md5(F.concat(path, F.lit("/"), key)), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(2**52)) / weight


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard at the end of the way down; a level's draws are made for the winning node's children only."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    below = F.create_map(
        *[
            x
            for path, children in _children(tree).items()
            for x in (F.lit(path), F.array(*[F.struct(F.lit(p).alias("path"), F.lit(w).alias("weight")) for p, w in children]))
        ]
    )

    def step(path, _):
        draws = F.transform(below[path], lambda c: F.struct(draw(key, c["path"], c["weight"]).alias("draw"), c["path"].alias("path")))
        return F.array_min(draws)["path"]

    leaf = F.aggregate(F.array(*[F.lit(level) for level in range(3)]), F.lit(""), step)
    return F.substring_index(leaf, "/", -1).cast("int")


def assign_shards(docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text", new_weight: float = 1.0) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    placed = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(id_col), tree).alias("shard"),
        shard_of(F.col(id_col), grown(tree, new_weight)).alias("grown_shard"),
        F.conv(F.substring(F.md5(key), 1, 2), 16, 10).cast("int").alias("range"),
    )
    within = Window.partitionBy("shard", "range")
    numbered = placed.withColumn("n", F.row_number().over(within.orderBy("doc_id", "size", "text_crc32")))
    sizes = placed.groupBy("shard", "range").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return numbered.join(starts, ["shard", "range"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("start") + F.col("n") - 1).alias("slot"), "grown_shard"
    )
