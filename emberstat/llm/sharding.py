"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of regions and racks. A document descends from the top:
at each node every child draws an exponential number from the hash of the
document's key and the child's name, divided by the child's weight, and the
smallest draw wins. So a child gets its share by weight, and a changed weight
moves documents only into or out of the subtree that holds it. Shards are added
as regions of their own (``grown``), which take rows only into themselves.
DataFrame functions only.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, stage

Leaf = tuple[str, str, int, float]
#: Rows of a shard that are put in order in one task.
BUCKET_ROWS = 100_000


def leaves(shards: int) -> list[Leaf]:
    """The tree that a table of ``shards`` equal shards starts with: two to a rack and two racks to a region; what is over is
    a region of its own each. Trees of different counts are laid out anew; ``grown`` adds shards to one that is in use."""
    whole = shards // 4 * 4
    return [(f"r{k // 4}", f"r{k // 4}/k{k // 2}", k, 1.0) if k < whole else (f"x{k}", f"x{k}/k", k, 1.0) for k in range(shards)]


def grown(shards: list[Leaf], more: int = 1, weight: float = 1.0) -> list[Leaf]:
    """The tree with ``more`` shards, numbered on. Each opens a region of its own and no shard ever changes its region, so no
    other subtree's weight changes and rows move only into the new shards."""
    first = max((s for _, _, s, _ in shards), default=-1) + 1
    return shards + [(f"x{k}", f"x{k}/k", k, weight) for k in range(first, first + more)]


def tree(shards: list[Leaf]) -> dict[str, list[tuple[str, float]]]:
    """Children with their weights (the sum of their leaves) of each node; leaves without weight hold nothing."""
    weight: dict[str, dict[str, float]] = {}
    for region, rack, shard, w in shards:
        for node, child in (("", region), (region, rack), (rack, f"{rack}#{shard}")):
            if w > 0:
                weight.setdefault(node, {})
                weight[node][child] = weight[node].get(child, 0.0) + w
    if not weight:
        raise ValueError("no shard has a weight")
    return {node: sorted(children.items()) for node, children in weight.items()}


def _draw(key: Column, child: Column) -> Column:
    """Uniform in (0, 1) from 52 bits of an MD5 that any engine can compute."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("@"), child)), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def shard_of(key: Column, shards: list[Leaf]) -> Column:
    """Shard of a key (null counts as an empty one, so null keys share a shard)."""
    nodes = tree(shards)
    kids = {n: F.array(*[F.struct(F.lit(c).alias("name"), F.lit(w).alias("weight")) for c, w in v]) for n, v in nodes.items()}
    children = F.create_map(*chain.from_iterable((F.lit(n), a) for n, a in kids.items()))
    key = F.coalesce(key.cast("string"), F.lit(""))

    def descend(node: Column) -> Column:
        draws = F.transform(F.element_at(children, node), lambda c: F.struct((-F.ln(_draw(key, c["name"])) / c["weight"]).alias("draw"), c["name"].alias("name")))
        return F.array_min(draws)["name"]

    return F.substring_index(descend(descend(descend(F.lit("")))), "#", -1).cast("int")


def assign(docs: DataFrame, shards: list[Leaf], key_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with the column ``name``: the shard of each row, by its key and the shards alone (so rows of one key
    share a shard, a null key counts as empty, an empty table stays empty). A column of that name is replaced."""
    return docs.withColumn(name, shard_of(F.col(f"`{key_col}`"), shards))


def placed(docs: DataFrame, shards: list[Leaf], larger: list[Leaf], key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where each document goes: ``key``, ``size`` (UTF-8 bytes of the text, null: none, plus 1), ``text_crc32`` (null
    text: null), ``law``, ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard`` under ``larger``.

    Slots follow a hash of key, size and checksum. Each shard is cut into buckets of that hash, as many as its rows
    need; a window numbers a bucket and the buckets' row counts give its first slot. Rows that are equal in all
    three take neighbouring slots in any order.
    """
    key, text = F.col(f"`{key_col}`"), F.col(f"`{text_col}`")
    df = docs.select(key.alias("key"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"))
    order = F.md5(F.concat_ws(":", F.lit("slot"), F.col("key").cast("string"), "size", "text_crc32"))
    df = stage(df.select("*", shard_of(F.col("key"), shards).alias("shard"), shard_of(F.col("key"), larger).alias("grown_shard"), order.alias("place")), "placed")
    parts = df.count() // BUCKET_ROWS // max(1, len(shards)) + 1
    df = df.withColumn("bucket", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / float(1 << 32) * parts).cast("long"))
    counts = stage(df.groupBy("shard", "bucket").agg(F.count("*").alias("n")), "bucket-counts")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = stage(counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("first")), "bucket-starts")
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("place"))
    out = df.withColumn("own", own).join(checked_broadcast(first, 32), ["shard", "bucket"])
    return out.select("key", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("own") - 1).cast("long").alias("slot"), "grown_shard")
