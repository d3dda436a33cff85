"""Token counts of byte-pair vocabularies by heap-and-linked-list merging.

A text is cut at the vocabulary's special strings, then into words by the
vocabulary's pattern. A word's symbols (bytes) form a linked list; a heap
holds its adjacent pairs by merge rank. The lowest pair is popped and joined,
stale entries are skipped, until no pair has a rank. The count is the number
of symbols less the merges; no identifiers are made.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush
from typing import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, small_batches, with_results

# fixed values: the pattern of byte-level vocabularies of this kind
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A chunk whose border meets other white space: its neighbours decide where words end.
_UNSURE = 1 << 48
#: Short words (and runs between spaces) whose counts a worker keeps, twice: the latest and the ones before.
CACHE_WORDS = 700_000
#: Bits of a symbol's number in a pair, and of a place in a heap entry.
_SYMBOL, _PLACE = 20, 32


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else the
    next code point from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """Merge ranks and special strings of a byte-level BPE file (bounded: a vocabulary)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    number = {s: b for b, s in enumerate(_byte_symbols())}
    rank_of: dict[int, int] = {}
    merges: list[tuple[int, int, int]] = []
    for rank, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        rank_of.setdefault(number[a] << _SYMBOL | number[b], rank)
        merges.append((number[a], number[b], number.setdefault(a + b, len(number))))
    return {"rank_of": rank_of, "merges": merges, "special": sorted((x["content"] for x in spec.get("added_tokens") or []), key=len, reverse=True)}


def count_merged(word: bytes, vocabulary: dict) -> int:
    """Symbols left of one word after all merges. A heap entry is a rank and a place; it is stale if the two symbols
    there are no longer the rank's pair."""
    rank_of, merges = vocabulary["rank_of"].get, vocabulary["merges"]
    symbol = list(word)
    n = len(symbol)
    heap = [r << _PLACE | i for i, (a, b) in enumerate(zip(word, word[1:])) if (r := rank_of(a << _SYMBOL | b)) is not None]
    if not heap:
        return n
    heapify(heap)
    following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    symbol.append(-1)  # behind the end
    left, last = n, (1 << _PLACE) - 1
    while heap:
        entry = heappop(heap)
        first, second, joined = merges[entry >> _PLACE]
        i = entry & last
        if symbol[i] != first:
            continue
        j = following[i]
        if symbol[j] != second:
            continue
        symbol[i], symbol[j] = joined, -1
        left -= 1
        following[i] = k = following[j]
        if k < n:
            previous[k] = i
            if (r := rank_of(joined << _SYMBOL | symbol[k])) is not None:
                heappush(heap, r << _PLACE | i)
        if (h := previous[i]) >= 0 and (r := rank_of(symbol[h] << _SYMBOL | joined)) is not None:
            heappush(heap, r << _PLACE | h)
    return left


class _Kept(dict):
    """Results of ``make`` by short key; when full, only those of the last ``CACHE_WORDS`` new keys stay."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, key: str) -> int:
        if (n := self.before.get(key)) is None:
            n = self.make(key)
        if len(key) <= 64:
            if len(self) >= CACHE_WORDS:
                self.before = dict(self)
                self.clear()
            self[key] = n
        return n


class Counter:
    """Counts of whole texts; counts of short words are kept in a bounded table."""

    def __init__(self, vocabulary: dict) -> None:
        self.words = regex.compile(_PATTERN)
        special = vocabulary["special"]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.word = _Kept(lambda word: count_merged(word.encode(), vocabulary)).__getitem__
        self.chunk = _Kept(lambda c: _UNSURE if not c or c[0].isspace() or c[-1].isspace() else self.plain(f" {c}")).__getitem__

    def plain(self, text: str) -> int:
        return sum(map(self.word, self.words.findall(text)))

    def segment(self, text: str) -> int:
        """A space between two other characters always begins a word, so chunks between such spaces count alone."""
        head, *chunks = text.split(" ")
        if head and not head[-1].isspace() or not chunks:
            total = sum(map(self.chunk, chunks))
            if total < _UNSURE:
                return total + self.plain(head)
        return self.plain(text)

    def count(self, text: str) -> int:
        if self.special is None:
            return self.segment(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.segment, parts))


def count_tokens(docs: DataFrame, vocabulary: str, keep: list[str] | None = None, text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """The columns ``keep`` (all by default) with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (more than ``limit`` tokens) of each whole text; an input column of such a name is replaced.

    ``vocabulary`` is the path of a byte-level BPE file on the driver; its merges are broadcast (bounded by the
    vocabulary). Special strings inside a text count as one token each, as the file's library does by default.
    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows each give a row; an empty table none.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row"), F.col(f"`{text_col}`").alias("text"),
                     F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long").alias("n_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            for piece in pieces(batch, 1):
                counts = pa.array([counter.count(t) if t else 0 for t in piece.column(1).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), counts], ["row", "n_bytes", "n_tokens"])

    schema = T.StructType([df.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    counted = df.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
    return with_results(counted, "row", ["n_bytes", "n_tokens", "over_limit"])
