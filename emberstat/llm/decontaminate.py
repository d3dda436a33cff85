"""Benchmark decontamination with suffix arrays of the training text.

Each task cuts its documents into shards of a bounded number of bytes and
sorts the suffixes of the shard's word stream. Every benchmark suffix that is
long enough to hold a window is binary-searched in that array: the interval
of training suffixes that share its first words is narrowed word by word, and
what is left at the window's length are the places where it stands. From
there each match is extended to its full verbatim length.

Documents are never shuffled. The benchmark is the query set: it goes to the
tasks in blocks of at most ``block_words`` words, one after the other, so a
broadcast has a size that does not depend on the benchmark's.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, list_array, pieces, small_batches, with_results, words_of

RESULTS = ["n_words", "hits", "items", "longest_match"]
#: Text of a shard; a longer document is a shard of its own.
SHARD_BYTES = 2 << 20
_HIT = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order by the first ``depth`` symbols at least (prefix doubling; suffixes that are
    already told apart are not sorted again)."""
    n = len(symbols)
    order = np.argsort(symbols).astype(np.int64)
    if n == 0:
        return order
    first = symbols[order]
    slots = np.arange(n)
    fresh = np.ones(n, bool)
    fresh[1:] = first[1:] != first[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # behind the end
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))
    done = 1
    while done < depth:
        open_ = ~fresh
        open_[:-1] |= ~fresh[1:]
        slot = slots[open_]
        if not len(slot):
            break
        own = order[slot]
        key = rank[own] * (n + 1) + rank[np.minimum(own + done, n)] + 1
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[slot] = own
        new = np.ones(len(slot), bool)
        new[1:] = key[1:] != key[:-1]
        fresh[slot] = new
        rank[own] = np.maximum.accumulate(np.where(new, slot, 0))
        done *= 2
    return order


def _bound(symbols, order, depth, wanted, lo, hi, right):
    """First slot of [lo, hi) whose symbol at ``depth`` is not below (``right``: is above) the wanted one."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        found = symbols[order[np.where(open_, mid, 0)] + depth]
        go = open_ & (found <= wanted if right else found < wanted)
        lo = np.where(go, mid + 1, lo)
        hi = np.where(open_ & ~go, mid, hi)
    return lo


class Block:
    """Some benchmark items: the words of each distinct text, and the ids that have it."""

    def __init__(self, rows: list[tuple[str | None, str]], window: int) -> None:
        words = words_of(pa.array([t for _, t in rows], pa.string()))
        seen: dict[bytes, int] = {}
        self.ids: list[list[str]] = []
        parts: list[np.ndarray] = []
        cuts = np.searchsorted(words.doc, np.arange(len(rows) + 1))
        for k, (item, _) in enumerate(rows):
            own = words.hash[cuts[k] : cuts[k + 1]]
            if len(own):
                at = seen.setdefault(own.tobytes(), len(parts))
                if at == len(parts):
                    parts.append(own)
                    self.ids.append([])
                if item is not None:
                    self.ids[at].append(item)
        size = np.array([len(p) for p in parts], np.int64)
        self.words = np.concatenate([*parts, np.zeros(1, np.uint64)])
        ends = np.cumsum(size)
        span = np.minimum(size, window)
        self.suffix = np.concatenate([np.arange(e - n, e - s + 1) for e, n, s in zip(ends, size, span)] or [np.zeros(0, np.int64)])
        self.owner = np.repeat(np.arange(len(parts)), size - span + 1)
        self.span, self.ends = span[self.owner], ends[self.owner]


def blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of bounded size (one at least, so that every document is counted)."""
    rows: list[tuple[str | None, str]] = []
    n, some = 0, False
    read = benchmark.select(F.col(item_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))
    for item, text in read.toLocalIterator():
        rows.append((item, text))
        n += len(text) // 2 + 1
        if n >= block_words:
            yield Block(rows, window)
            rows, n, some = [], 0, True
    if rows or not some:
        yield Block(rows, window)


def _search(words: Words, n_docs: int, block: Block, window: int):
    """Occurrences of the block's windows: first and last word in the shard's word order, block text, verbatim length."""
    n = len(words.hash)
    place = np.arange(n) + words.doc  # an end mark stands behind each document
    symbols = np.zeros(n + n_docs + window + 1, np.uint64)
    symbols[place] = words.hash
    order = suffix_array(symbols[: n + n_docs], window)
    lo = np.zeros(len(block.suffix), np.int64)
    hi = np.full(len(block.suffix), len(order), np.int64)
    live = np.arange(len(block.suffix) if len(order) else 0)
    hi[len(live) :] = 0
    for depth in range(window):
        live = live[(depth < block.span[live]) & (lo[live] < hi[live])]
        if not len(live):
            break
        wanted = block.words[block.suffix[live] + depth]
        a = _bound(symbols, order, depth, wanted, lo[live], hi[live], False)
        b = _bound(symbols, order, depth, wanted, a, hi[live], True)
        lo[live], hi[live] = a, b
    count = hi - lo
    which = np.repeat(np.arange(len(count)), count)
    slot = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    at = order[slot]
    length = block.span[which].copy()
    longer = np.arange(len(which))
    while len(longer):  # extend each match word by word to its verbatim end
        item, doc = block.suffix[which[longer]] + length[longer], at[longer] + length[longer]
        inside = item < block.ends[which[longer]]
        longer, item, doc = longer[inside], item[inside], doc[inside]
        longer = longer[block.words[item] == symbols[doc]]
        length[longer] += 1
    first = np.searchsorted(place, at)
    return first, first + block.span[which], block.owner[which], length


def _scan(broadcast, window: int, keep_text: bool, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = broadcast.value
        for batch in batches:
            for piece in pieces(batch, 1, SHARD_BYTES):
                words = words_of(piece.column(1))
                n_docs = piece.num_rows
                cuts = np.searchsorted(words.doc, np.arange(n_docs + 1))
                start, end, owner, length = _search(words, n_docs, block, window)
                doc = words.doc[start] if len(start) else start
                step = np.zeros(len(words.hash) + 1, np.int64)
                np.add.at(step, start, 1)
                np.add.at(step, end, -1)
                covered = np.cumsum(step)[:-1] > 0
                if not first:  # what earlier blocks have hit
                    for k, spans in enumerate(piece.column(3).to_pylist()):
                        for s in spans:
                            covered[cuts[k] + s["start"] : cuts[k] + s["end"]] = True
                begin = covered.copy()
                begin[1:] &= ~covered[:-1] | (words.doc[1:] != words.doc[:-1])
                stop = covered.copy()
                stop[:-1] &= ~covered[1:] | (words.doc[1:] != words.doc[:-1])
                begin, stop = np.flatnonzero(begin), np.flatnonzero(stop) + 1
                own = words.doc[begin] if len(begin) else begin
                found: list[set[str]] = [set() for _ in range(n_docs)] if first else [set(x) for x in piece.column(4).to_pylist()]
                longest = np.zeros(n_docs, np.int64) if first else piece.column(5).to_numpy().copy()
                for d, o in np.unique(np.stack([doc, owner]), axis=1).T:
                    found[d].update(block.ids[o])
                np.maximum.at(longest, doc, length)
                spans = pa.StructArray.from_arrays([pa.array(begin - cuts[own]), pa.array(stop - cuts[own])], ["start", "end"])
                out = [piece.column(0), *([piece.column(1)] if keep_text else []), pa.array(np.diff(cuts), pa.int64()),
                       list_array(np.bincount(own, minlength=n_docs), spans), pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                       pa.array(longest, pa.int64())]
                yield pa.RecordBatch.from_arrays(out, ["row", *(["text"] if keep_text else []), *RESULTS])

    return run


def find_matches(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = 13,
                 block_words: int = 4_000_000) -> DataFrame:
    """Verbatim benchmark passages in every document.

    Returns the columns ``keep`` (all by default) with ``n_words``, ``hits`` (merged word spans covered by an
    occurring window), ``items`` (ids with an occurring window, as strings in order) and ``longest_match`` (words
    of the longest verbatim match, 0 without one); an input column of such a name is replaced.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
    Null texts and texts without words have 0 words and no hits; an item with a null id still hits words but is
    not listed; repeated documents give a row each; equal items are all listed; with an empty benchmark nothing
    is hit and with no documents nothing is returned. Words are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    df = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    parts = [spark.sparkContext.broadcast(b) for b in blocks(benchmark, item_col, item_text_col, window, block_words)]
    for k, part in enumerate(parts):
        last = k == len(parts) - 1
        schema = T.StructType([df.schema["row"], *([] if last else [df.schema["text"]]), T.StructField("n_words", T.LongType()),
                               T.StructField("hits", _HIT), T.StructField("items", T.ArrayType(T.StringType())),
                               T.StructField("longest_match", T.LongType())])
        df = df.mapInArrow(_scan(part, window, not last, k == 0), schema)
    return with_results(df, "row", RESULTS)


def n_hit_words():
    return F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])


def contaminated(least_percent: int = 5):
    """At least this share of the words stands in benchmark windows, and one word at least."""
    return (n_hit_words() > 0) & (100 * n_hit_words() >= least_percent * F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated documents, all columns as they were (see ``find_matches``)."""
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{options.pop('text_col', 'text')}`").alias("text"))
    found = find_matches(packed, benchmark, keep=["row"], **options)
    return found.filter(~contaminated()).select("row.*")
