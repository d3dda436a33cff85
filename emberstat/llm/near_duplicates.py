"""Near-duplicate documents by order MinHash, verified by banded alignment.

A document is the sequence of its 5-word shingles. For each of ``SKETCHES``
hash functions its sketch holds the ``PICKED`` shingles of the smallest hash
values, labelled by their occurrence number and kept *in text order*: equal
entries say that the shingles agree and stand in the same order, which plain
MinHash doesn't see. A document of few shingles also has an entry for every
sequence that is left when as many shingles go as a link allows. Documents with
an equal entry meet in a bucket.

Documents with equal word sequences are one node. A bucket is resolved by
leaders: a leader is aligned with the other members, a member that no
verified link joins to a leader becomes a leader itself, until every member
is linked to one or has been one. So large groups of copies cost one
alignment a member. Where many members of a bucket stay apart, they share a
passage but little else, and wait for the last round: no bucket is capped or
expanded into all pairs. Before texts are fetched, a bitmap of each document's labelled
shingles bounds what two documents can share; a pair below the bound is not
aligned, and no link is lost by that.
Links are joined to classes by star contraction. In the last round all documents
of different classes that share one of their rarest shingles, which two linked
ones must, are compared: so the classes are those of all links, whatever the
sketches and leaders have missed.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache, reduce
from itertools import combinations
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch, scratch_path
from .common import checked_broadcast, compact, join_groups, list_array, mix64, pieces, shingles, small_batches, stage, words_of

SHINGLE, SKETCHES, PICKED, SIMILARITY = 5, 16, 4, 0.8
#: Texts of fewer shingles meet by exact entries.
FEW = 20
#: Leaders of a bucket in the second round; members that may all lead in the third.
LEADERS, SMALL = 16, 32
#: Slots of the table that counts shingles, as powers of two: at least, at most (a byte each), and in a part that is summed at a time.
SLOTS, PART = (16, 25), 16
#: 64-bit words of the bitmap, and of the finer one by the number of shingles (none for few, which the first tells apart).
BITMAP = 16
FINE = ((192, 0), (768, 64), (3072, 256), (1 << 62, 1024))
_ONE = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix64(np.arange(1, SKETCHES + 1, dtype=np.uint64) * _ONE)
_ODD = mix64(_SEEDS) | np.uint64(1)


def labelled(items: np.ndarray) -> np.ndarray:
    """Each item with its occurrence number mixed in, so that repeats differ."""
    order = np.argsort(items, kind="stable")
    sorted_ = items[order]
    at = np.arange(len(items))
    fresh = np.ones(len(items), bool)
    fresh[1:] = sorted_[1:] != sorted_[:-1]
    number = np.empty(len(items), np.uint64)
    number[order] = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
    return mix64(items + number * _ONE)


def bitmap(own: np.ndarray, words: int = BITMAP) -> np.ndarray:
    """Labelled shingles as set bits. A bit that only one of two documents has stands for a shingle that the other
    one lacks."""
    bits = np.zeros(64 * words, np.uint8)
    if words:
        bits[(own >> np.uint64(20)) % np.uint64(64 * words)] = 1
    return np.packbits(bits).view(np.int64)


def order_minhash(own: np.ndarray) -> np.ndarray:
    """The sketch entries of one document's labelled shingles."""
    n, take = len(own), min(PICKED, len(own))
    out = np.zeros(SKETCHES, np.uint64)
    step = max(1, (1 << 21) // n)  # hash functions at a time: bounded memory for very long texts
    for at in range(0, SKETCHES, step):
        if n > take:
            values = (own[None, :] ^ _SEEDS[at : at + step, None]) * _ODD[at : at + step, None]
            place = np.sort(np.argpartition(values, take - 1, axis=1)[:, :take], axis=1)
        else:
            place = np.broadcast_to(np.arange(n), (len(_SEEDS[at : at + step]), n))
        entry = np.zeros(len(place), np.uint64)
        for k in range(take):
            entry = mix64(entry * _ONE + own[place[:, k]])
        out[at : at + step] = entry
    return out


@lru_cache(maxsize=None)
def _left(n: int, gone: int, anywhere: bool) -> np.ndarray:
    """The places that stay of ``n`` when ``gone`` of them go, a row for each choice: at either end or anywhere."""
    if anywhere:
        return np.array([np.delete(np.arange(n), c) for c in combinations(range(n), gone)])
    return np.array([np.arange(k, k + n - gone) for k in range(gone + 1)])


def short_entries(words: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Entries that two linked texts of fewer than ``FEW`` shingles always share: the hash of what they have in common.

    At most a fifth of a linked text's shingles have no match, 3 here, and 4 in both texts. Shingles overlap, so these
    stand at the ends, or else both sides of a gap say the same words at two distances: then a word comes again
    within 3 words, and the shingles of such a text are left out anywhere.
    """
    n = len(items)
    if n >= FEW:
        return items[:0]
    most = int(n * (1 - SIMILARITY) + 1e-9)
    again = any((words[p:] == words[:-p]).any() for p in range(1, most + 1))
    out = []
    for gone in range(most + 1):
        rows = items[_left(n, gone, again)]
        entry = np.full(len(rows), n - gone, np.uint64)
        for k in range(rows.shape[1]):
            entry = mix64(entry * _ONE + rows[:, k])
        out.append(entry)
    return np.unique(np.concatenate(out))


def _trimmed(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """What is left without an equal head and tail, and how many these hold."""
    gone = 0
    for step in (1, -1):
        short = min(len(x), len(y))
        differ = np.flatnonzero(x[::step][:short] != y[::step][:short])
        n = int(differ[0]) if len(differ) else short
        x, y, gone = x[::step][n:][::step], y[::step][n:][::step], gone + n
    return x, y, gone


def aligned(x: np.ndarray, y: np.ndarray, band: int, need: int = 0) -> int:
    """Matches of the best alignment that keeps within ``band`` of the diagonal (longest common subsequence,
    bit-parallel: an integer of the band's width is the part of a row that can change). It gives up, with what it has,
    as soon as ``need`` matches are out of reach."""
    x, y, gone = _trimmed(x, y)
    n, m = len(x), len(y)
    if not n or not m:
        return gone
    places: dict[int, list[int]] = {}
    for i, v in enumerate(x.tolist()):
        places.setdefault(v, []).append(i)
    width = 2 * band + 1
    full = (1 << width) - 1
    seen: dict[int, list[int]] = {}  # of each value: places that entered, first place of the mask, mask
    row, low, found = full, -band, 0  # bit i of the row stands for place low + i of x; found: matches below
    for j, v in enumerate(y.tolist()):
        while low < j - band:
            found += not row & 1
            row = row >> 1 | 1 << width - 1
            low += 1
        at = places.get(v)
        if at is not None:
            have = seen.setdefault(v, [0, low, 0])
            mask, entered = have[2] >> low - have[1], have[0]
            while entered < len(at) and at[entered] < low + width:
                if at[entered] >= low:
                    mask |= 1 << at[entered] - low
                entered += 1
            seen[v] = [entered, low, mask]
            hit = row & mask
            row = (row + hit | row - hit) & full
        if need and j % 512 == 0 and gone + found + width - row.bit_count() + m - j - 1 < need:
            break
    return gone + found + width - row.bit_count()


def similarity(x: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned shingles as a share of all (in order: matches / (both - matches)), or a lower bound of it that reaches
    ``least``; 0 if it can't. Bands grow until the alignment reaches ``least``, or the band is as wide as an alignment that
    reaches it can stray."""
    n, m = len(x), len(y)
    if min(n, m) < least * max(n, m) or not n:
        return 0.0
    need = least / (1 + least) * (n + m)  # matches of a pair that just reaches it
    if len(np.intersect1d(labelled(x), labelled(y), assume_unique=True)) < need - 1e-9:
        return 0.0
    # shingles that the other text doesn't have can't match
    x, y = x[np.isin(x, y)], y[np.isin(y, x)]
    most = max(int(len(x) + len(y) - 2 * need) + 1, 1)
    band = min(64, most)
    while True:
        match = aligned(x, y, band, int(np.ceil(need - 1e-9)))
        if band == most or match >= need - 1e-9:
            return match / (n + m - match)
        band = min(8 * band, most)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, 2):
            texts = piece.column(2)
            words = words_of(texts)
            cuts = np.searchsorted(words.doc, np.arange(len(texts) + 1))
            prints, sizes, sketches = [], [], []
            for k in range(len(texts)):
                own = words.hash[cuts[k] : cuts[k + 1]]
                items = shingles(own, SHINGLE)
                sizes.append(len(items))
                if len(own):
                    prints.append(hashlib.md5(own.tobytes()).digest())
                    sketches.append(np.concatenate([order_minhash(labelled(items)), short_entries(own, items)]).view(np.int64))
                else:  # no words: only equal texts belong together
                    prints.append(hashlib.md5(b"text:" + texts[k].as_py().encode()).digest() if texts[k].is_valid else None)
                    sketches.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(prints, pa.binary()), pa.array(sizes, pa.int32()),
                                              pa.array(sketches, pa.list_(pa.int64()))], ["rid", "id", "print", "n", "sketch"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, 1):
            words = words_of(piece.column(1))
            cuts = np.searchsorted(words.doc, np.arange(piece.num_rows + 1))
            coarse, fine = [], []
            for k in range(piece.num_rows):
                own = labelled(shingles(words.hash[cuts[k] : cuts[k + 1]], SHINGLE))
                coarse.append(bitmap(own))
                fine.append(bitmap(own, next(w for most, w in FINE if len(own) <= most)))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(coarse, kind), pa.array(fine, kind)], ["node", "bits", "fine"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, 2):
            for piece in pieces(part, 3):
                left, right = words_of(piece.column(2)), words_of(piece.column(3))
                edges = np.arange(piece.num_rows + 1)
                a, b = np.searchsorted(left.doc, edges), np.searchsorted(right.doc, edges)
                keep = [k for k in range(piece.num_rows)
                        if similarity(shingles(left.hash[a[k] : a[k + 1]], SHINGLE), shingles(right.hash[b[k] : b[k + 1]], SHINGLE)) >= SIMILARITY]
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(keep, pa.int64())), piece.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])


def _items(batches: Iterator[pa.RecordBatch]):
    """Of (node, text) rows: the nodes of each piece and the labelled shingles of each text."""
    for batch in batches:
        for piece in pieces(batch, 1):
            words = words_of(piece.column(1))
            cuts = np.searchsorted(words.doc, np.arange(piece.num_rows + 1))
            yield piece.column(0).to_pylist(), [labelled(shingles(words.hash[a:b], SHINGLE)) for a, b in zip(cuts, cuts[1:])]


def _counted(bits: int):
    """(node, text) to the parts of one table for the task: of the labelled shingles of all its texts, how many fall in each
    of 2^``bits`` slots, up to 255."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, np.uint8)
        for _, items in _items(batches):
            slots, count = np.unique(np.concatenate([*items, np.zeros(0, np.uint64)]) >> np.uint64(64 - bits), return_counts=True)
            table[slots] = np.minimum(table[slots] + count, 255)
        for k, part in enumerate(table.reshape(-1, 1 << PART)):
            if part.any():  # few bits a slot
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part, 1)], pa.binary())], ["part", "counts"])

    return run


def _summed(part: pa.Table) -> pa.Table:
    """One part of all tasks' tables as one: counts of 128 and more in eighths of a doubling, so that a byte holds them."""
    total = sum(np.frombuffer(zlib.decompress(x), np.uint8).astype(np.float64) for x in part["counts"].to_pylist())
    code = np.where(total < 128, total, 128 + 8 * np.log2(np.maximum(total, 128) / 128)).clip(0, 255).astype(np.uint8)
    return pa.table([part["part"][:1].cast(pa.int32()), pa.array([zlib.compress(code, 1)], pa.binary())], names=["part", "counts"])


def shingle_counts(texts: DataFrame, words: int) -> np.ndarray:
    """How often the labelled shingles of all ``texts`` (node, text), about ``words``, fall in each slot (the first bits of a
    shingle); larger counts are rounded. There is a slot for 4 shingles or fewer until the table has its largest size."""
    bits = min(max(int(words // 4).bit_length(), SLOTS[0]), SLOTS[1])
    parts = texts.coalesce(texts.sparkSession.sparkContext.defaultParallelism).mapInArrow(_counted(bits), "part int, counts binary")
    table = np.zeros((1 << bits - PART, 1 << PART), np.uint8)
    for row in parts.groupBy("part").applyInArrow(_summed, "part int, counts binary").collect():
        table[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
    return table.ravel()


def _prefixes(common):
    """(node, text) to the text's rarest labelled shingles, by the counts of their slots and then by hash: as many as a linked
    text can't do without."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = common.value
        shift = np.uint64(64 - (len(counts).bit_length() - 1))
        for nodes, items in _items(batches):
            out = [own[np.lexsort((own, counts[own >> shift]))[: len(own) - int(np.ceil(SIMILARITY * len(own) - 1e-9)) + 1]] for own in items]
            size = np.array([len(x) for x in out], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), list_array(size, pa.array(np.concatenate([*out, np.zeros(0, np.uint64)]).view(np.int64)))],
                                             ["node", "items"])

    return run


def prefix_pairs(texts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Pairs (node, leader) of a node that ``waits`` with any node of ``texts`` (node, text, n, comp, waits) of another ``comp`` that
    can be linked: all of them, and few others. With ``known`` (node, n, comp; written), ``texts`` is (node, text), only the nodes
    of ``known`` count, all of them wait, and a pair comes once (node < leader).

    Ordered in one way by rarity, two texts that share enough shingles share one early in both. So each shows only its
    rarest shingles, and a passage that many texts share, but none consists of, brings no two together. The order comes
    from the counts of all shingles (``shingle_counts``); which links are found doesn't depend on it. Shingles that only
    one ``comp`` shows, as those within a group of copies, go before rows meet."""
    once = known is not None
    if known is None:
        known = stage(texts.select("node", "n", "comp", "waits"), "prefix-nodes")
    else:
        known = known.withColumn("waits", F.lit(True))
    words = known.agg(F.sum("n")).first()[0] or 0
    texts = texts.select("node", "text")
    common = texts.sparkSession.sparkContext.broadcast(shingle_counts(texts, words))
    lists = texts.mapInArrow(_prefixes(common), "node long, items array<long>").join(checked_broadcast(known, 40), "node")
    lists = compact(lists.select("node", "n", "comp", "waits", "items"), "prefixes")
    early = lists.select("node", "n", "comp", "waits", F.posexplode("items").alias("place", "item"))
    # by half of the hash, rows are small; of two that can be linked one shows the item within its first ninth
    first = 2 * SIMILARITY / (1 + SIMILARITY) * F.col("n") <= F.col("n") - F.col("place") + 1e-6
    shown = early.groupBy(F.hash("item").alias("half")).agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max(first).alias("first"))
    shown = compact(shown.filter("low < high AND first").select("half"), "shared-items")
    early = compact(early.join(checked_broadcast(shown, 16), F.hash("item") == F.col("half"), "left_semi"), "shared-prefixes")
    other = early.select(F.col("node").alias("leader"), F.col("place").alias("at"), "item", F.col("n").alias("m"), F.col("comp").alias("leader_comp"))
    need = F.lit(SIMILARITY / (1 + SIMILARITY)) * (F.col("n") + F.col("m")) - 1e-6
    met = early.filter("waits").join(other, "item").filter(
        (F.col("node") < F.col("leader") if once else F.lit(True))
        & (F.col("comp") != F.col("leader_comp")) & (F.col("n") - F.col("place") >= need) & (F.col("m") - F.col("at") >= need)
        & (F.least("n", "m") >= SIMILARITY * F.greatest("n", "m")))
    return met.select("node", "leader").distinct()


def _star_pass(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (a, b), a < b: larger neighbours move to the smallest neighbour,
    then smaller ones do."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b")
    least = large.groupBy("b").agg(F.min("a").alias("m"))
    small = large.join(least, "b").select(F.col("m").alias("l"), F.explode(F.array("a", "b")).alias("g")).filter("l < g")
    return compact(small.select(F.col("l").alias("a"), F.col("g").alias("b")).distinct(), "stars")


def settled(links: DataFrame) -> DataFrame:
    """Stars (a, b) that join every linked node b to the smallest node a that links lead to: star steps until nothing
    changes, each written to the shared folder."""
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    before = None
    while (now := edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()) != before:
        edges, before = _star_pass(edges), now
    return edges


def _as_leaders(members: DataFrame, keys: list, order: str, also: list[str]) -> DataFrame:
    """The member with the largest ``order`` of each group, as a leader."""
    best = members.groupBy("bucket", *keys).agg(F.max(F.struct(F.col(order).alias("by"), "node", "n", "bits", "fine", *also)).alias("l"))
    named = [F.col("l.node").alias("leader"), F.col("l.n").alias("m"), F.col("l.bits").alias("other_bits"), F.col("l.fine").alias("other_fine")]
    # as many and as wide as buckets: they meet the members in a shuffle join
    return compact(best.select("bucket", *named, *[F.col(f"l.{c}").alias(f"leader_{c}") for c in also]), "leaders")


def _only(a: str, b: str) -> Column:
    """Bits of bitmap ``a`` that ``b`` lacks."""
    if a.endswith("fine"):
        lacks = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
        return F.aggregate(lacks, F.lit(0), lambda s, x: s + x)
    return reduce(lambda s, x: s + x, [F.bit_count(F.col(a)[k].bitwiseAND(F.bitwise_not(F.col(b)[k]))) for k in range(BITMAP)])


def _within(kind: str) -> Column:
    """What the two can share at most, all but the shingles that only one of them has, may do."""
    most = F.least(F.col("n") - _only(kind, f"other_{kind}"), F.col("m") - _only(f"other_{kind}", kind))
    return most + 1e-6 >= SIMILARITY / (1 + SIMILARITY) * (F.col("n") + F.col("m"))


def _ordered(met: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of nodes and leaders whose lengths and bitmaps allow a link."""
    near = (F.least("n", "m") >= SIMILARITY * F.greatest("n", "m")) & _within("bits") & ((F.size("fine") != F.size("other_fine")) | _within("fine"))
    return met.filter(near).select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are linked."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right_text"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left_text", "right_text")
    return compact(joined.mapInArrow(_align, "a long, b long"), "links")


def _leader_rounds(nodes: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stars (a, b) of the links that leaders find, and the pairs (a, b) tested for it (see ``find_links``)."""
    # exact entries follow the sketches, in no order
    entries = nodes.select("node", "n", F.posexplode("sketch")).select(F.xxhash64(F.least("pos", F.lit(SKETCHES)), "col").alias("bucket"), "node", "n")
    shared = entries.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = compact(entries.join(shared, "bucket"), "buckets")
    weight = compact(members.groupBy("node").agg(F.sum("size").alias("met")), "candidates")
    texts = stage(texts.join(checked_broadcast(weight, 24), texts["rid"] == weight["node"]).select("node", "text"), "candidate-texts")
    prints = texts.mapInArrow(_bitmaps, "node long, bits array<long>, fine array<long>").join(weight, "node")
    prints = compact(prints.join(nodes.select("node", "n"), "node"), "bitmaps")
    members = compact(members.join(checked_broadcast(prints.drop("n"), 8 * (F.size("bits") + F.size("fine")) + 48), "node"), "members")
    texts = checked_broadcast(texts, F.octet_length("text") + 32, 16 << 20)

    leaders = _as_leaders(members, [], "met", [])
    tested = compact(_ordered(members.join(leaders, "bucket").filter(F.col("node") != F.col("leader"))), "pairs")
    edges = settled(_verified(tested, texts))
    open_ = members.filter("size > 2")  # two members have met
    led = leaders.select("bucket", "leader")
    for last in (False, True):
        labels = checked_broadcast(edges.select(F.col("b").alias("node"), F.col("a").alias("comp")), 24)
        named = compact(open_.select("bucket", "node").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "labels")
        done = named.join(checked_broadcast(led, 24), (named["node"] == led["leader"]) & (named["bucket"] == led["bucket"]), "left_semi")
        done = compact(done.select("bucket", "comp").distinct(), "led")
        now = open_.join(checked_broadcast(named, 32), ["bucket", "node"])
        left = now.join(checked_broadcast(done, 24), ["bucket", "comp"], "left_anti")
        if last:
            waiting = left.groupBy("bucket").agg(F.count("*").alias("waiting"))
            crowds = compact(waiting.filter(F.col("waiting") > SMALL).select("bucket"), "crowds")
            left = left.join(checked_broadcast(crowds, 16), "bucket", "left_anti")
        new = _as_leaders(left, [(F.col("node") if last else F.pmod(F.xxhash64("node"), F.lit(LEADERS))).alias("salt")], "node", ["comp"])
        led = led.unionByName(new.select("bucket", "leader"))
        met = _ordered(now.join(new, "bucket").filter(F.col("comp") != F.col("leader_comp")))
        pairs = compact(met.join(checked_broadcast(tested, 24), ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            tested = tested.unionByName(pairs)
            edges = settled(edges.unionByName(_verified(pairs, texts)))
    return edges, tested


def find_links(nodes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Classes of linked nodes (node, comp), or None without links. ``nodes``: node, n, sketch; ``texts``: rid, text.

    In the first round a bucket has one leader: the member that meets most others over all its buckets, which in a
    group of copies is near their origin. Then up to ``LEADERS`` members that no link joins to a leader lead. Then all
    that are left lead in buckets with at most ``SMALL`` of them; those of other buckets, texts that share a passage but
    little else, wait. At last all nodes meet those of other classes by their rarest shingles (``prefix_pairs``), which
    finds every link between classes. So rows grow with the entries and the shingles.
    """
    spark = nodes.sparkSession
    paths = scratch_path(spark, "leader-stars"), scratch_path(spark, "leader-pairs")
    with scratch(spark):  # what the rounds have written goes
        for frame, path in zip(_leader_rounds(nodes, texts), paths):
            frame.coalesce(spark.sparkContext.defaultParallelism).write.parquet(path)
    edges, tested = (spark.read.schema("a long, b long").parquet(path) for path in paths)
    whole = texts.select(F.col("rid").alias("node"), "text")
    labels = checked_broadcast(edges.select(F.col("b").alias("node"), F.col("a").alias("comp")), 24)
    known = compact(nodes.filter("n > 0").select("node", "n").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "known")
    pairs = prefix_pairs(whole, known).select(F.col("node").alias("a"), F.col("leader").alias("b"))
    pairs = compact(pairs.join(checked_broadcast(tested, 24), ["a", "b"], "left_anti"), "prefix-pairs")
    if not pairs.isEmpty():
        own = compact(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "prefix-pair-nodes")
        own = stage(whole.join(checked_broadcast(own, 16), "node", "left_semi"), "prefix-pair-texts")
        sides = compact(own.mapInArrow(_bitmaps, "node long, bits array<long>, fine array<long>").join(known.select("node", "n"), "node"), "prefix-bitmaps")
        sides = checked_broadcast(sides, 8 * (F.size("bits") + F.size("fine")) + 48)
        other = sides.select(F.col("node").alias("leader"), F.col("n").alias("m"), F.col("bits").alias("other_bits"), F.col("fine").alias("other_fine"))
        met = pairs.select(F.col("a").alias("node"), F.col("b").alias("leader")).join(sides, "node").join(other, "leader")
        found = _verified(compact(_ordered(met), "pairs"), checked_broadcast(own, F.octet_length("text") + 32, 16 << 20))
        edges = settled(edges.unionByName(found))
    if edges.isEmpty():
        return None
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias("comp"))
    return stars.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct())


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Near-duplicate classes of all rows of ``docs``.

    Returns the staged rows (``rid``, ``row`` with all columns) and, for each ``rid``: ``id``, ``class_id`` (smallest
    id of the class), ``kept`` (true for one row of each class: smallest id, nulls last, then first in the input)
    and ``class_rows``.

    Two texts are linked if their 5-word shingles (words with A-Z lower-cased; a shorter text is one shingle) align
    in order to 0.8 or more of all their shingles; classes are what links connect. Equal word sequences are always
    together. A text without words is only together with equal texts, a null text is alone. A class whose ids are
    all null has a null ``class_id``. Repeated rows are copies of each other. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = stage(docs.select(F.monotonically_increasing_id().alias("rid"), row), "documents")
    id_type = docs.schema[id_col].dataType.simpleString()
    sketched = stage(rows.select("rid", F.col("row")[id_col].alias("id"), F.col("row")[text_col].alias("text")).mapInArrow(
        _sketch, f"rid long, id {id_type}, print binary, n int, sketch array<long>"), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid"))
    equal = stage(sketched.filter("print IS NOT NULL").groupBy("print").agg(
        F.min("rid").alias("node"), first.alias("first"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "nodes")
    comps = find_links(equal.select("node", "n", "sketch"), rows.select("rid", F.col("row")[text_col].alias("text")))
    own = equal.select("print", "node", "first", "rows")
    if comps is None:
        own = own.withColumn("class_rows", F.col("rows"))
    else:
        linked = own.join(checked_broadcast(comps, 32), "node").select("print", "comp", "first", "rows")
        best = linked.groupBy("comp").agg(F.min("first").alias("best"), F.sum("rows").alias("class_rows"))
        better = linked.join(best, "comp").select("print", "best", "class_rows")
        own = own.join(better, "print", "left").select("print", "rows", F.coalesce("best", "first").alias("first"),
                                                       F.coalesce("class_rows", "rows").alias("class_rows"))
    own = stage(own.select("print", "rows", "first", "class_rows"), "classes")
    # a whole group of copies has one print: large groups don't meet in one task
    found = join_groups(sketched.filter("print IS NOT NULL").select("rid", "id", "print"), own, "print", "rows", 128)
    found = found.select("rid", "id", F.col("first.id").alias("class_id"), (F.col("first.rid") == F.col("rid")).alias("kept"), "class_rows")
    alone = sketched.filter("print IS NULL").select("rid", "id", F.col("id").alias("class_id"), F.lit(True).alias("kept"), F.lit(1).cast("long").alias("class_rows"))
    return rows, found.unionByName(alone)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate class, all columns as they were (see ``classes``)."""
    rows, found = classes(docs, id_col, text_col)
    gone = checked_broadcast(stage(found.filter("NOT kept").select("rid"), "copies"), 16)
    return rows.join(gone, "rid", "left_anti").select("row.*")
