"""Mixing sources to target weights by Sainte-Lague apportionment.

The corpus' words are cut into equal blocks. Blocks are seats: they go to the
sources by the highest quotients target / (2 k + 1), and each source's seats
go on to its shards by the same rule, which gives every shard an integer
quota. In a shard the documents stand in a seeded order on a line of words;
a quota of q out of a blocks takes every block q // a times and q % a of them,
spread evenly from a seeded start, once more. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, stage

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_WORDS = 16
#: Words of a shard: as many documents are put in order in one task.
SHARD_WORDS = 1 << 20
_ALL_BEFORE = (Window.unboundedPreceding, -1)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``number``, ``weight`` and ``target`` (words) to (source, source_size), a row for each source.

    Sources by code point, null last, weigh ``weights`` in turn and share all words; a target stops at ``most``
    times its source's size, and what is over is shared by weight among the others until none is above. That is
    the level at which all uncapped sources get the same words a weight: sources are taken by the level at which
    they reach their cap, and one is capped if the level left for it and those after it is as high.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = sources.withColumn("number", F.row_number().over(by_name).cast("long"))
    n = n.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int")))
    n = n.withColumn("cap", most * F.col("source_size"))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), "number").rowsBetween(*_ALL_BEFORE)
    n = n.withColumns({"all_size": F.sum("source_size").over(everything), "all_weight": F.sum("weight").over(everything),
                       "used": F.coalesce(F.sum("cap").over(by_level), F.lit(0).cast("long")),
                       "gone": F.coalesce(F.sum("weight").over(by_level), F.lit(0).cast("long"))})
    level = (F.col("all_size") - F.col("used")).cast("double") / (F.col("all_weight") - F.col("gone"))
    n = n.withColumn("capped", F.col("cap").cast("double") / F.col("weight") <= level)
    n = n.withColumns({"used": F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0).cast("long")),
                       "gone": F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))).over(everything), F.lit(0).cast("long"))})
    share = F.try_divide((F.col("all_size") - F.col("used")).cast("double"), F.col("all_weight") - F.col("gone")) * F.col("weight")
    return n.select("source", "source_size", "number", "weight", "all_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def sainte_lague(cells: DataFrame, group: list[str], cell: str, share: str, seats: str) -> DataFrame:
    """Adds ``quota``: the ``seats`` of each group (a column, equal in the group) given to its cells by the highest
    quotients share / (2 k + 1), the smaller ``cell`` first where quotients are equal.

    Seats that every rounding gives are not listed one by one: with n cells and s seats, the seats at the divisor
    of s - n / 2 are all won and those beyond the divisor of s + n / 2 all lost. Only the few between, about two
    a cell, are ranked. Cells without a share get none.
    """
    own = Window.partitionBy(*group)
    df = cells.withColumns({"_all": F.sum(share).over(own), "_n": F.count("*").over(own)})
    rate = F.try_divide(F.col(share), F.col("_all"))
    low = F.floor(rate * F.greatest(F.col(seats) - F.col("_n") / 2, F.lit(0.0)) + F.lit(0.5 - 1e-9))
    high = F.floor(rate * (F.col(seats) + F.col("_n") / 2) + F.lit(0.5 + 1e-9))
    df = df.withColumns({"_low": F.coalesce(F.greatest(low, F.lit(0)), F.lit(0)).cast("long"), "_high": F.coalesce(high, F.lit(0)).cast("long")})
    df = df.withColumn("_left", F.col(seats) - F.sum("_low").over(own))
    open_ = df.filter("_high > _low").select(*group, cell, "_left", F.col(share).alias("_share"), F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_k"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy((F.col("_share") / (2 * F.col("_k") - 1)).desc(), cell, "_k"))
    won = open_.withColumn("_rank", rank).filter("_rank <= _left").groupBy(*group, cell).agg(F.count("*").alias("_more"))
    out = df.join(won, [*group, cell], "left").withColumn("quota", F.col("_low") + F.coalesce("_more", F.lit(0).cast("long")))
    return out.select(*cells.columns, "quota")


def _taken_before(x):
    """Words that the mix takes of the first ``x`` words of a shard."""
    block = F.floor(x / F.lit(BLOCK_WORDS)).cast("long")

    def chosen(upto):  # of the blocks before
        return F.floor((F.col("start") + upto) * F.col("extra") / F.col("blocks")) - F.floor(F.col("start") * F.col("extra") / F.col("blocks"))

    inside = x - block * BLOCK_WORDS
    return F.col("base") * x + chosen(block) * BLOCK_WORDS + (chosen(block + 1) - chosen(block)) * inside


def mix(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        extra: list | None = None) -> DataFrame:
    """How often the mix takes each document.

    Returns ``id``, ``source``, ``size`` (words of the text), ``source_size``, ``target`` (of the source), ``taken``
    (words the mix takes, repeats counted; up to 3 times ``size``), ``draw`` (seeded MD5 of id and text) and the
    columns ``extra``. A null text has no words and is not taken; a null id or source is a value like others, the
    null source comes last. Rows with equal id and text stand next to each other in any order and each get what
    their place takes. Without any words targets are 0; an empty table stays empty. The same rows and seed give
    the same mix, however the table is split.
    """
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(ident.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    size = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sized = stage(docs.select(*(extra or []), ident.alias("id"), F.col(f"`{source_col}`").alias("source"), size.alias("size"), draw.alias("draw")), "sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    seats = sources.withColumn("seats", F.ceil(F.col("all_size") / F.lit(BLOCK_WORDS)).cast("long"))
    quotas = stage(sainte_lague(seats.withColumn("all", F.lit(0)), ["all"], "number", "target", "seats").drop("all", "seats", "weight", "all_size"), "quotas")
    q = checked_broadcast(quotas.withColumnRenamed("source", "own_source"), 256)
    df = sized.join(q, F.col("source").eqNullSafe(F.col("own_source"))).drop("own_source")
    shards = F.ceil(F.greatest("source_size", F.lit(1)) / F.lit(SHARD_WORDS))
    df = df.withColumn("shard", F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") / float(1 << 32) * shards).cast("long"))
    cells = df.groupBy("number", "shard", "quota").agg(F.sum("size").alias("words")).withColumnRenamed("quota", "seats")
    cells = sainte_lague(cells, ["number"], "shard", "words", "seats")
    blocks = F.ceil(F.col("words") / F.lit(BLOCK_WORDS)).cast("long")
    cells = cells.filter("words > 0").withColumn("blocks", blocks).withColumn("quota", F.least("quota", MOST_REPEATS * F.col("blocks")))
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("number").cast("string"), F.col("shard").cast("string"))), 1, 8), 16, 10).cast("long")
    cells = stage(cells.select("number", "shard", "blocks", F.floor(F.col("quota") / F.col("blocks")).cast("long").alias("base"),
                               F.pmod("quota", "blocks").alias("extra"), F.pmod(start, F.col("blocks")).alias("start")), "shard-quotas")
    line = Window.partitionBy("number", "shard").orderBy("draw").rowsBetween(*_ALL_BEFORE)
    # rows without words take no place on the line: however many, they are not put in order
    on_line = df.filter("size > 0").withColumn("before", F.coalesce(F.sum("size").over(line), F.lit(0).cast("long")))
    on_line = on_line.join(checked_broadcast(cells, 64), ["number", "shard"])
    taken = (_taken_before(F.col("before") + F.col("size")) - _taken_before(F.col("before"))).cast("long")
    columns = [*(extra or []), "id", "source", "size", "source_size", "target"]
    blank = df.filter("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"), "draw")
    return on_line.select(*columns, taken.alias("taken"), "draw").unionByName(blank)


def mixed(docs: DataFrame, seed: str = "mix", **columns) -> DataFrame:
    """The mixed corpus, all columns as they were: a document is repeated as often as the mix takes its words; a part
    of a document that is over counts as one more copy with that probability (by its seeded draw)."""
    rows = stage(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "documents")
    names = {k: columns.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    flat = rows.select(F.col("rid").alias("_rid"), *[F.col("row")[c].alias(c) for c in names.values()])
    plan = mix(flat, seed, extra=["_rid"], **names)
    odds = F.conv(F.substring("draw", 9, 8), 16, 10).cast("double") / float(1 << 32)
    copies = F.floor(F.try_divide(F.col("taken"), F.col("size")) + odds).cast("int")
    plan = stage(plan.filter("taken > 0").select(F.col("_rid").alias("rid"), copies.alias("copies")).filter("copies > 0"), "plan")
    return rows.join(checked_broadcast(plan, 24), "rid").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
