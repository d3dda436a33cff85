"""Helpers shared by the text operators: word hashing over whole Arrow batches,
staging on the shared folder, column packing."""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Words of the lower-cased text (only A-Z are lower-cased): runs of digits, a-z and all non-ASCII code points.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BYTES = np.arange(256)
_FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
# every byte of a non-ASCII code point is >= 0x80, so the class test works on bytes
_IS_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n + 1, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_POW: list[np.ndarray] = [_powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)]


def _pow_tables(n: int) -> list[np.ndarray]:
    if len(_POW[0]) <= n:
        size = 1 << int(n).bit_length()
        tables = [_powers(_BASE, size), _powers(_INVERSE, size)]
        if size > 1 << 22:  # a single long text: do not keep its tables
            return tables
        _POW[:] = tables
    return _POW


class Words(NamedTuple):
    """Words of a batch of texts: folded bytes, byte span, text index and 64-bit hash of each word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array and the byte offset of each text (one more than texts); null counts as empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, off, data = texts.buffers()
    if off is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def words_of(texts: pa.Array) -> Words:
    """All words of all texts at once: whole texts, numpy only."""
    raw, offsets = utf8(texts)
    data = _FOLD[raw]
    n = len(data)
    inside = _IS_WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a text border also ends a word
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    up, down = _pow_tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_HASH[data] * up[:n], out=total[1:])
    value = mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    value[value == 0] = 1  # 0 marks the end of a text
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, end, doc, value)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of k words of one text; a shorter text with words is one shingle."""
    k = min(k, len(words))
    if k == 0:
        return words[:0]
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out = mix64(out * _BASE + words[i : i + len(out)])
    return out


def pieces(batch: pa.RecordBatch, text: int, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``max_bytes`` of text each, or a single row: the memory of a step
    is bounded by this and the longest text, whatever the batch holds."""
    _, offsets = utf8(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def list_array(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and go on from the copy: it is not computed
    twice, survives lost executors and is read column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compact(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for tables of ids: as many files as the cluster has cores, not one for each shuffle partition."""
    return stage(df.coalesce(df.sparkSession.sparkContext.defaultParallelism), name)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts go to Python in Arrow batches of at most ``rows`` rows (Spark's default of 10,000 texts may not fit
    beside a task). Lowers the session's setting; a lower one stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def with_results(packed: DataFrame, row: str, results: list[str]) -> DataFrame:
    """Unpack the input row and put the results beside it; a result replaces an input column of its name."""
    names = [f.name for f in packed.schema[row].dataType.fields if f.name not in results]
    return packed.select(*[F.col(row)[n].alias(n) for n in names], *results)


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def checked_broadcast(small: DataFrame, row_bytes: int | Column, limit: int = 64 << 20) -> DataFrame:
    """Mark a *staged* side for broadcast if its rows, counted (or summed up, where ``row_bytes`` is a column), fit
    ``limit`` bytes; else the join stays a shuffle join."""
    if isinstance(row_bytes, Column):
        size = small.agg(F.sum(row_bytes)).first()[0] or 0
    else:
        size = small.count() * row_bytes
    return F.broadcast(small) if size <= limit else small


#: A key with more than one in so many rows is hot, so there are fewer hot keys than this.
HOT_KEYS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, row_bytes: int, limit: int = 64 << 20) -> DataFrame:
    """Inner join of ``rows`` with one row for each ``key``, which holds in ``size`` how many rows have it (both staged). Groups
    within ``limit`` bytes are broadcast. Beyond, fewer than ``HOT_KEYS`` hot groups are, and the others meet their rows in a
    shuffle join, where no key has more than a small share of all rows."""
    n, total = groups.agg(F.count("*"), F.sum(size)).first()
    if n * row_bytes <= limit:
        return rows.join(F.broadcast(groups), key)
    hot = F.broadcast(groups.filter(F.col(size) * HOT_KEYS > total))
    cold = rows.join(hot.select(key), key, "left_anti").join(groups.filter(F.col(size) * HOT_KEYS <= total), key)
    return rows.join(hot, key).unionByName(cold)
