"""Ranked lexical search with range-maximum sparse tables.

Documents are scanned once: of each, the query terms with their occurrences
and the length are kept and written to the shared folder. Each task reads a
part of them in blocks of a bounded number of postings. In a block every term
has a posting list of documents with their impacts, and a sparse table that
gives the largest impact of any document interval in two look-ups. The sum of
these maxima over an item's terms bounds what a document of the interval can
score. The interval of the largest bound is split at its document of maximum
impact, which is scored; short intervals are scored whole; what is bounded
below the k-th best is never looked at. The best of all tasks are ranked at
the end, so no task sees more than its blocks and k rows an item.

Items are the query set: they go to the tasks in parts of a bounded number of
words, one after the other.
"""

from __future__ import annotations

from heapq import heappop, heappush
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import list_array, pieces, small_batches, stage, words_of

#: Postings and documents of a block; documents of an interval that is scored whole; intervals looked at together.
BLOCK_POSTINGS, BLOCK_DOCS, LEAF, TOGETHER = 1 << 20, 1 << 16, 256, 32


class Part(NamedTuple):
    """Some items: their ids, the distinct terms of each as places in ``terms`` (sorted word hashes)."""

    ids: list
    items: list[np.ndarray]
    terms: np.ndarray


def item_parts(items: DataFrame, item_col: str, text_col: str, part_words: int) -> Iterator[Part]:
    """The items in parts of bounded size."""

    def part(rows: list[tuple]) -> Part:
        words = words_of(pa.array([t for _, t in rows], pa.string()))
        cuts = np.searchsorted(words.doc, np.arange(len(rows) + 1))
        terms, place = np.unique(words.hash, return_inverse=True)
        return Part([i for i, _ in rows], [np.unique(place[a:b]) for a, b in zip(cuts, cuts[1:])], terms)

    rows, n = [], 0
    for item, text in items.select(F.col(f"`{item_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).toLocalIterator():
        rows.append((item, text))
        n += len(text) // 2 + 1
        if n >= part_words:
            yield part(rows)
            rows, n = [], 0
    if rows:
        yield part(rows)


def _occurrences(broadcast):
    """(id, text) to (id, n, terms, tfs): words of the document, its query terms and how often each stands there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = broadcast.value.terms
        for batch in batches:
            for piece in pieces(batch, 1):
                words, rows = words_of(piece.column(1)), piece.num_rows
                place = np.minimum(np.searchsorted(terms, words.hash), max(len(terms) - 1, 0))
                known = terms[place] == words.hash if len(terms) else np.zeros(len(words.hash), bool)
                pair, tf = np.unique(words.doc[known] * max(len(terms), 1) + place[known], return_counts=True)
                doc, term = np.divmod(pair, max(len(terms), 1))
                size = np.bincount(doc.astype(np.int64), minlength=rows)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.bincount(words.doc.astype(np.int64), minlength=rows)),
                                                  list_array(size, pa.array(term.astype(np.int32))), list_array(size, pa.array(tf.astype(np.int32)))],
                                                 ["id", "n", "terms", "tfs"])

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, terms) to (term, total): documents of each term; term -1 counts the documents with words, -2 their words."""
    found, docs, words = np.zeros(0, np.int64), 0, 0
    for batch in batches:
        n = batch.column(0).to_numpy()
        docs, words = docs + int((n > 0).sum()), words + int(n.sum())
        own = np.bincount(batch.column(1).flatten().to_numpy(), minlength=len(found))
        own[: len(found)] += found
        found = own
    term = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], term]).astype(np.int64)), pa.array(np.concatenate([[docs, words], found[term]]).astype(np.int64))],
                                     ["term", "total"])


class Index:
    """Posting lists of one block, one behind the other by term, each in document order, with their sparse tables.

    A table holds ranks of impacts, equal impacts in a random order, so that a split at the maximum cuts an interval of
    equal documents near its middle."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.n = n_docs
        key = term.astype(np.int64) * n_docs + doc
        by = np.argsort(key, kind="stable")
        self.key, self.doc, self.impact = key[by], doc[by].astype(np.int64), impact[by]
        self.start = np.searchsorted(self.key, np.arange(n_terms + 1) * n_docs)
        size = len(key)
        self.by_rank = np.lexsort((np.random.default_rng(0).permutation(size), self.impact))
        rank = np.empty(size, np.int32)
        rank[self.by_rank] = np.arange(size, dtype=np.int32)
        longest = int(np.diff(self.start).max(initial=0))
        self.level = np.zeros(longest + 1, np.int64)  # largest power of two in a length
        for k in range(1, longest.bit_length()):
            self.level[1 << k :] = k
        self.table = np.zeros((max(longest.bit_length(), 1), size), np.int32)
        self.table[0] = rank
        for k in range(1, longest.bit_length()):
            half = 1 << k - 1
            self.table[k] = self.table[k - 1]
            np.maximum(self.table[k - 1][: size - half], self.table[k - 1][half:], out=self.table[k][: size - half])
        self.board = np.zeros(n_docs, np.int64)

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Rank of the largest impact among the postings [lo, hi), -1 for none."""
        some = hi > lo
        level = self.level[np.where(some, hi - lo, 1)]
        safe = np.where(some, lo, 0)
        other = np.where(some, hi - (1 << level), 0)
        return np.where(some, np.maximum(self.table[level, safe], self.table[level, other]), -1)

    def bounds(self, ranks: np.ndarray) -> np.ndarray:
        return np.where(ranks >= 0, self.impact[self.by_rank[np.maximum(ranks, 0)]], 0).sum(axis=-1)

    def scores(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the posting ranges and the sums of their impacts."""
        size = hi - lo
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        np.add.at(self.board, self.doc[at], self.impact[at])
        found = np.flatnonzero(self.board)
        total = self.board[found]
        self.board[found] = 0
        return found, total

    def best(self, terms: np.ndarray, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The k documents of the highest scores (equal ones: the first), of those that reach ``least`` and are above 0."""
        terms = terms[self.start[terms + 1] > self.start[terms]]
        doc, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(terms):
            return doc, score
        lo, hi = self.start[terms], self.start[terms + 1]
        heap: list[tuple] = [(-int(self.bounds(self.maxima(lo, hi))), 0, self.n, lo, hi)]

        def beaten(bound: int, first: int) -> bool:
            return bound < least or len(doc) == k and (bound < score[-1] or bound == score[-1] and first > doc[-1])

        while heap and not beaten(-heap[0][0], heap[0][1]):
            now = [heappop(heap) for _ in range(min(TOGETHER, len(heap)))]
            first, end = np.array([x[1] for x in now]), np.array([x[2] for x in now])
            lo, hi = np.stack([x[3] for x in now]), np.stack([x[4] for x in now])
            wide = end - first > LEAF
            read = [(lo[~wide].ravel(), hi[~wide].ravel())]
            children: list[tuple] = []
            if wide.any():
                first, end, lo, hi = first[wide], end[wide], lo[wide], hi[wide]
                split = self.doc[self.by_rank[self.maxima(lo, hi).max(axis=1)]]
                at = terms[None, :] * self.n + split[:, None]
                a, b = np.searchsorted(self.key, at), np.searchsorted(self.key, at + 1)
                read.append((a.ravel(), b.ravel()))
                children = [(first, split, lo, a), (split + 1, end, b, hi)]
            found, total = self.scores(np.concatenate([x for x, _ in read]), np.concatenate([x for _, x in read]))
            doc, score = np.concatenate([doc, found]), np.concatenate([score, total])
            by = np.lexsort((doc, -score))[:k]
            doc, score = doc[by], score[by]
            for first, end, lo, hi in children:
                bound = self.bounds(self.maxima(lo, hi))
                for j in np.flatnonzero(bound > 0):
                    if not beaten(int(bound[j]), int(first[j])):
                        heappush(heap, (-int(bound[j]), int(first[j]), int(end[j]), lo[j], hi[j]))
        return doc[score >= max(least, 1)], score[score >= max(least, 1)]


def _search(part, weights, docs: int, words: int, k: int):
    """(id, n, terms, tfs) to (item, id, score): the k best documents of this task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = part.value.items, weights.value
        best: list[list[tuple]] = [[] for _ in items]
        kind = pa.int64()

        def search(rows: pa.RecordBatch) -> None:
            ids = rows.column(0)
            order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            terms = rows.column(2).flatten().to_numpy().astype(np.int64)
            tf = rows.column(3).flatten().to_numpy().astype(np.int64)
            size = pc.list_value_length(rows.column(2)).to_numpy()
            m = np.array([50 + 50 * n * docs // words for n in rows.column(1).to_pylist()], np.int64)
            impact = weight[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, size)))
            some = impact > 0
            index = Index(terms[some], np.repeat(place, size)[some], impact[some], len(order), len(weight))
            for i, own in enumerate(items):
                doc, score = index.best(own, k, -best[i][-1][0] if len(best[i]) == k else 0)
                new = [(-s, d is None, d) for s, d in zip(score.tolist(), ids.take(pa.array(order[doc])).to_pylist())]
                if new:
                    best[i] = sorted(best[i] + new, key=lambda x: x if not x[1] else x[:2])[:k]

        held: list[pa.RecordBatch] = []
        postings = rows = 0
        for batch in batches:
            kind = batch.schema.field(0).type
            sizes = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy())
            at = 0
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, before + BLOCK_POSTINGS - postings, side="right")))
                to = min(to, at + BLOCK_DOCS - rows)
                held.append(batch.slice(at, to - at))
                postings, rows, at = postings + int(sizes[to - 1]) - before, rows + to - at, to
                if postings >= BLOCK_POSTINGS or rows >= BLOCK_DOCS or at < batch.num_rows:
                    search(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, postings, rows = [], 0, 0
        if held:
            search(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
        yield pa.RecordBatch.from_arrays([pa.array([i for i, b in enumerate(best) for _ in b], pa.int32()), pa.array([x[2] for b in best for x in b], kind),
                                          pa.array([-x[0] for b in best for x in b], pa.int64())], ["place", "id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", part_words: int = 200_000) -> DataFrame:
    """For each row of ``items`` the ``k`` documents of the highest scores above 0 (all, if fewer): ``item_id``, ``rank``
    (from 1), ``doc_id``, ``score``.

    Terms are the words of the whole text with A-Z lower-cased. With N documents that have words, L words in all, df
    documents of a term, n words of a document and tf of them the term: a term weighs w = floor(1000 ln((2N+2)/(2df+1))),
    and scores w * ((10^9 tf) div (1000 tf + 20 m)) with m = 50 + (50 n N) div L; a document's score is the sum over the
    item's distinct terms. Equal scores rank by ascending id, a null id last; rows of an equal id in any order.

    A null or empty text has no terms: such an item has no rows, such a document never ranks and doesn't count in N. A
    repeated document or item is a row of its own. Empty tables give no rows. Other columns are not looked at. Words
    are compared by 64-bit hashes. Ids can be of any type that can be ordered.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_col].dataType
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    best = spark.createDataFrame([], T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()),
                                                   T.StructField("doc_id", id_type), T.StructField("score", T.LongType())]))
    for part in item_parts(items, item_col, item_text_col, part_words):
        shared = spark.sparkContext.broadcast(part)
        held = stage(texts.mapInArrow(_occurrences(shared), T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()),
                     T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))])), "occurrences")
        totals = held.select("n", "terms").mapInArrow(_frequencies, "term long, total long").groupBy("term").agg(F.sum("total").alias("total"))
        df = np.zeros(len(part.terms) + 2, np.int64)  # as many as the part has terms; -1 and -2 are the last
        for term, total in totals.collect():
            df[term] = total
        n_docs, n_words = int(df[-1]), int(df[-2])
        weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df[:-2] + 1))).astype(np.int64)
        with_terms = held.filter(F.size("terms") > 0)
        found = with_terms.mapInArrow(_search(shared, spark.sparkContext.broadcast(weight), n_docs, n_words, k),
                                      T.StructType([T.StructField("place", T.IntegerType()), T.StructField("id", id_type), T.StructField("score", T.LongType())]))
        order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(part.ids)), T.StructType([T.StructField("place", T.IntegerType()), T.StructField("item_id", item_type)]))
        # as many rows as the part has items, which part_words bounds
        best = best.unionByName(found.join(F.broadcast(names), "place").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    return best
