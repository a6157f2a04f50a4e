"""Sharding by a hierarchical weighted hash tree, in SQL functions alone.

A tree has regions, racks and shards, each leaf with a weight; an inner node
weighs as much as its leaves. A row starts at the root and on each level takes
the child with the smallest ``-ln(u) / weight``, ``u`` being a hash of seed,
child path and row key in (0, 1). A child's draw depends on nothing but its own
path and weight, so a change of weights moves rows only between the subtrees
whose weights changed.

A row that moves into a grown region is drawn again below it, among old racks
too. One more shard therefore opens a region of its own (``tree_of``): the rows
that leave the others then all go to the new shard.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, staged

# Shards of the first tree: 2 regions of 2 racks of 2.
FIRST_SHARDS = 8
SHARDS_PER_RACK = 2
RACKS_PER_REGION = 2
# Hex digits of the hash that make a draw: 52 bits, exact in a double.
DRAW_DIGITS = 13
# Buckets in which slots are numbered, for each shuffle partition.
BUCKETS_PER_PARTITION = 4

Tree = Mapping[str, Mapping[str, Mapping[int, float]]]


@dataclass(frozen=True)
class Child:
    path: str
    weight: float
    below: tuple[Child, ...] = ()
    shard: int = -1


def tree_of(shards: int, weight: float = 1.0) -> dict[str, dict[str, dict[int, float]]]:
    """The tree for a number of shards; each one after the first
    FIRST_SHARDS stands in a region of its own."""
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        if shard < FIRST_SHARDS:
            rack = shard // SHARDS_PER_RACK
            region = f"region{rack // RACKS_PER_REGION}"
        else:
            rack, region = shard, f"added{shard}"
        tree.setdefault(region, {}).setdefault(f"rack{rack}", {})[shard] = weight
    return tree


def _nodes(tree: Tree) -> tuple[Child, ...]:
    regions = []
    for region, racks in tree.items():
        below = []
        for rack, leaves in racks.items():
            shards = tuple(
                Child(f"{region}/{rack}/{s}", float(w), shard=s) for s, w in leaves.items() if w > 0
            )
            if shards:
                below.append(Child(f"{region}/{rack}", sum(c.weight for c in shards), shards))
        if below:
            regions.append(Child(region, sum(c.weight for c in below), tuple(below)))
    if not regions:
        raise ValueError("the tree has no shard with a weight above 0")
    return tuple(regions)


def draw(path: str, weight: float, key: Column, seed: str) -> Column:
    """What a child asks for a row; the smallest draw wins."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|{path}|"), key)), 1, DRAW_DIGITS)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DRAW_DIGITS)
    return -F.log(u) / F.lit(weight)


def _descend(children: tuple[Child, ...], key: Column, seed: str) -> Column:
    if len(children) == 1:
        only = children[0]
        return F.lit(only.shard) if not only.below else _descend(only.below, key, seed)
    asked = [draw(c.path, c.weight, key, seed) for c in children]
    least = F.least(*asked)
    chosen = None
    for child, ask in zip(children, asked):
        value = F.lit(child.shard) if not child.below else _descend(child.below, key, seed)
        took = ask == least
        chosen = F.when(took, value) if chosen is None else chosen.when(took, value)
    return chosen


def shard_of(key: Column, tree: Tree, seed: str = "tree") -> Column:
    """The shard (int) of a key. A null key is a key like any other."""
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    return _descend(_nodes(tree), text, seed).cast("int")


def assign(
    docs: DataFrame, shards: int = FIRST_SHARDS, seed: str = "tree", key: str = "doc_id"
) -> DataFrame:
    """Put rows into shards by their key and number each shard's rows.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; 1 for a null text),
    text_crc32 (of the bytes; 0 for null or empty), law ('key'), shard, slot
    (gapless from 0 in each shard) and grown_shard (with one shard more).

    Key and shard count alone decide: rows with one key, repeated rows and rows
    with a null key meet in one shard each. Slots follow a hash of the row's
    own values, so a rerun gives the same ones (equal rows are alike). Other
    columns of ``docs`` are ignored; an empty table gives no rows.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    buckets = BUCKETS_PER_PARTITION * partitions(docs.sparkSession)
    placed = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), tree_of(shards), seed).alias("shard"),
        shard_of(F.col(key), tree_of(shards + 1), seed).alias("grown_shard"),
    )
    placed = placed.withColumn(
        "_bucket",
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets)).cast("int"),
    )
    placed = staged(placed, "shards")
    # One row per shard and bucket, both bounded: broadcast.
    filled = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = filled.select(
        "shard", "_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "size", "text_crc32")
    return (
        placed.withColumn("_at", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), ["shard", "_bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "law",
            "shard",
            (F.col("_before") + F.col("_at")).cast("long").alias("slot"),
            "grown_shard",
        )
    )
