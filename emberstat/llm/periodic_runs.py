"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q, of ``LEAST_EXPONENT``
periods or more, that can't be extended. Periods below ``SMALLEST`` are
detected directly: words that equal the word q places on. Any other period
belongs to one dyadic scale t with t <= q < 2t. There each window of t words
has a hash, and a position is selected if its window, or the one t places on,
has the smallest hash of the t + 1 windows from it. So selection depends on the
next 2t words alone: in a run a selected position is selected again one period
on, with an equal context, and next selected positions of equal context propose
their distance as a period. Windows inside runs of a period of t/4 or less would
all look alike; these runs are known from smaller scales and their windows are
left out. Proposals are extended word by word, so no hash decides a run.

All texts of a piece are worked on together as one sequence, with an end mark
of its own behind each.
"""

from __future__ import annotations

import hashlib
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import list_array, mix64, pieces, small_batches, with_results

LEAST_EXPONENT, LEAST_LENGTH, SMALLEST = 4, 6, 4
RESULTS = ["n_words", "runs", "collapsed", "collapsed_sha256"]
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Runs(NamedTuple):
    """Runs by start: first place, length, period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and ends of the stretches of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _extend(symbols: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The largest stretch around ``at`` where each symbol equals the one ``period`` places on, compared in growing
    blocks; as (start, end of the run)."""
    lo, size = at, 64
    while lo > 0:
        a = max(0, lo - size)
        differ = np.flatnonzero(symbols[a:lo] != symbols[a + period : lo + period])
        if len(differ):
            lo = a + int(differ[-1]) + 1
            break
        lo, size = a, size * 2
    hi, size, n = at, 64, len(symbols) - period
    while hi < n:
        b = min(n, hi + size)
        differ = np.flatnonzero(symbols[hi:b] != symbols[hi + period : b + period])
        if len(differ):
            hi += int(differ[0])
            break
        hi, size = b, size * 2
    return lo, hi + period


def find_runs(symbols: np.ndarray, ends: np.ndarray) -> Runs:
    """All runs of ``LEAST_EXPONENT`` periods or more. ``symbols`` (int64): texts one behind the other, each with an end
    mark of its own at the places ``ends``; no run crosses one."""
    n = len(symbols)
    found: dict[tuple[int, int], int] = {}  # (start, end): smallest period

    def take(start: int, end: int, period: int) -> None:
        if end - start >= LEAST_EXPONENT * period:
            found[start, end] = min(period, found.get((start, end), period))

    for q in range(1, SMALLEST):
        lo, hi = _stretches(symbols[:-q] == symbols[q:]) if n > q else (np.zeros(0, int),) * 2
        for k in np.flatnonzero(hi - lo >= (LEAST_EXPONENT - 1) * q):
            take(int(lo[k]), int(hi[k]) + q, q)
    sizes = np.diff(np.concatenate([[-1], ends])) - 1
    place, t = np.arange(n), 1
    name = mix64(symbols.astype(np.uint64) * _ODD + np.uint64(1))
    while n and LEAST_EXPONENT * max(t, SMALLEST) <= sizes.max(initial=0):
        if t >= SMALLEST:  # texts that are too short for this scale are left out, with their end marks
            keep = np.repeat(sizes >= LEAST_EXPONENT * t, sizes + 1)
            if not keep.all():
                place, name, sizes = place[keep], name[keep], sizes[sizes >= LEAST_EXPONENT * t]
        n = len(place)
        # windows of 2t symbols; what reaches over the last end mark is no window
        twice = mix64(name[: max(n - t, 0)] * _ODD + mix64(name[t:]))
        if t >= SMALLEST and n > 2 * t:
            _scale(symbols, place, name, twice, t, found, take)
        name = np.concatenate([twice, mix64((np.arange(n - len(twice)) + (t << 32)).astype(np.uint64))])
        t *= 2
    rows = np.array(sorted((s, e - s, q) for (s, e), q in found.items()), np.int64).reshape(-1, 3)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return Runs(*rows.T)


def _scale(symbols, place, name, twice, t, found, take) -> None:
    """Runs of the periods t to 2t - 1."""
    n = len(name)
    # windows inside runs of small periods: places in the kept texts, which are whole, so they stay neighbours
    quiet = np.zeros(n + 1, np.int64)
    small = np.array([(s, e) for (s, e), q in found.items() if 4 * q <= t and e - s >= t], np.int64).reshape(-1, 2)
    if len(small):
        first = np.searchsorted(place, small[:, 0])
        own = place[np.minimum(first, n - 1)] == small[:, 0]  # runs of texts that are left out are not here
        np.add.at(quiet, first[own], 1)
        np.add.at(quiet, (first + small[:, 1] - small[:, 0] - t + 1)[own], -1)
    own = np.where(np.cumsum(quiet)[:-1] > 0, _MOST, mix64(name ^ np.uint64(t)))
    least, width = own.copy(), 1
    while width < t:  # minima of 1, 2, 4 ... t windows
        np.minimum(least[:-width], least[width:], out=least[:-width])
        width *= 2
    m = n - 2 * t
    least = np.minimum(least[:m], own[t : t + m])
    chosen = np.flatnonzero((least != _MOST) & ((least == own[:m]) | (least == own[t : t + m])))
    by = np.argsort(twice[chosen], kind="stable")
    at = chosen[by]
    context = twice[at]
    step = at[1:] - at[:-1]
    pair = np.flatnonzero((context[1:] == context[:-1]) & (step >= t) & (step < 2 * t))
    start, period = place[at[pair]], step[pair]
    order = np.lexsort((start, period))
    last, until = 0, -1
    for s, q in zip(start[order].tolist(), period[order].tolist()):
        if q != last:
            last, until = q, -1
        if s < until:  # in the stretch that was extended last
            continue
        if not np.array_equal(symbols[s : s + 2 * t], symbols[s + q : s + q + 2 * t]):
            continue
        lo, hi = _extend(symbols, s, q)
        until = hi - q
        take(lo, hi, q)


def words_of_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (runs of anything but ASCII white space) of all texts, and the number of each text's words."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, owner = pc.list_flatten(split), pc.list_parent_indices(split)
    some = pc.not_equal(flat, "")
    return flat.filter(some), np.bincount(owner.filter(some).to_numpy().astype(np.int64), minlength=len(texts))


def _runs(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                words, sizes = words_of_texts(piece.column(1))
                ends = np.cumsum(sizes + 1) - 1
                symbols = np.empty(len(words) + len(sizes), np.int64)
                text = np.ones(len(symbols), bool)
                text[ends] = False
                symbols[ends] = -1 - np.arange(len(ends))
                symbols[text] = words.dictionary_encode().indices.to_numpy()
                runs = find_runs(symbols, ends)
                owner = np.searchsorted(ends, runs.start)
                cover = np.zeros(len(symbols) + 1, np.int64)
                report = runs.length >= LEAST_LENGTH
                runs, owner = Runs(*[x[report] for x in runs]), owner[report]
                np.add.at(cover, runs.start + runs.period, 1)
                np.add.at(cover, runs.start + runs.length, -1)
                stays = (np.cumsum(cover)[:-1] == 0)[text]
                kept = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[stays], minlength=len(sizes))
                collapsed = pc.binary_join(list_array(kept, words.filter(pa.array(stays))), " ")
                own = runs.start - np.concatenate([[0], ends[:-1] + 1])[owner] if len(owner) else runs.start
                spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (own, runs.length, runs.period)], ["start", "length", "period"])
                digest = pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in collapsed])
                out = [piece.column(0), pa.array(sizes, pa.int64()), list_array(np.bincount(owner, minlength=len(sizes)), spans),
                       *([collapsed] if keep_text else []), digest]
                yield pa.RecordBatch.from_arrays(out, ["row", *[c for c in RESULTS if keep_text or c != "collapsed"]])

    return run


def periodic_runs(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """The columns ``keep`` (all by default) with ``n_words``, ``runs`` (start in words from 0, length, period; by start,
    then period), ``collapsed`` (unless ``keep_text`` is false: the words without those that any run holds after its
    first period, joined by one space) and ``collapsed_sha256``; an input column of such a name is replaced.

    A run has its smallest period, spans ``LEAST_EXPONENT`` periods and ``LEAST_LENGTH`` words or more and no neighbouring
    word extends it. Words are what ASCII white space parts, compared as they are. A null, empty or blank text has no
    words, no runs and an empty collapsed text. Repeated rows give a row each; an empty table stays empty. A task holds
    1 MB of text, or one longer text, with some 20 numbers a word.
    """
    small_batches(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    df = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    span = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    kinds = {"n_words": T.LongType(), "runs": T.ArrayType(span), "collapsed": T.StringType(), "collapsed_sha256": T.StringType()}
    results = [c for c in RESULTS if keep_text or c != "collapsed"]
    found = df.mapInArrow(_runs(keep_text), T.StructType([df.schema["row"], *[T.StructField(c, kinds[c]) for c in results]]))
    return with_results(found, "row", results)


def best_run():
    """The run of the greatest length / period, compared exactly (ties: smallest start, then period); null without any."""
    def better(a, b):
        # runs come by start, then period; a text has fewer than 2^31 words, so the products fit
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate("runs", none, better)


def runs_digest():
    """SHA-256 of a line ``start,length,period`` for each run."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)
