"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberstat.llm.periodic_runs import find_runs, periodic_runs
from emberstat.llm.queries import QUERIES
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    """Every maximal stretch of each period, smallest period only."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def runs_of(texts):
    symbols, ends, names = [], [], {}
    for k, t in enumerate(texts):
        symbols += [names.setdefault(w, len(names)) for w in t] + [-1 - k]
        ends.append(len(symbols) - 1)
    r = find_runs(np.array(symbols, np.int64), np.array(ends))
    out = [[] for _ in texts]
    for s, n, q in zip(*[x.tolist() for x in r]):
        k = int(np.searchsorted(ends, s))
        if n >= 6:
            out[k].append((s - (ends[k - 1] + 1 if k else 0), n, q))
    return [sorted(x) for x in out]


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def random_text(r):
    w = []
    for _ in range(r.randint(0, 8)):
        if r.random() < 0.5:
            w += [r.randint(0, r.choice([1, 2, 50])) for _ in range(r.randint(0, 40))]
        else:
            root = [r.randint(0, r.choice([1, 3, 50])) for _ in range(r.randint(1, 40))]
            w += root * r.randint(1, 7) + root[: r.randint(0, len(root))]
    return w


def test_random_texts_and_shapes():
    r = random.Random(4)
    texts = [random_text(r) for _ in range(600)]
    fib = [0], [0, 1]
    while len(fib[1]) < 3000:
        fib = fib[1], fib[1] + fib[0]
    # nested: a run of runs; squares and cubes only; one symbol
    texts += [fib[1], thue_morse(2000), ([0] * 30 + [1]) * 20, (([1, 2] * 5 + [3]) * 6 + [4]) * 5, [7] * 5000, [7] * 5, [7] * 6, [], list(range(100)) * 4, list(range(100)) * 4 + [0], list(range(101)) * 3]
    got = runs_of(texts)
    for t, g in zip(texts, got):
        assert g == brute_runs(t), t[:60]
    assert sum(map(len, got)) > 500


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=80), min_size=1, max_size=4))
def test_small_alphabets(texts):
    assert runs_of(texts) == [brute_runs(t) for t in texts]


def expected(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_brute_force(spark):
    rows = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    t = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    assert len(rows) == len(t["doc_id"])
    for d, text in zip(t["doc_id"], t["text"]):
        assert rows[d] == expected(d, text)
    assert sum(r[0] > 0 for r in rows.values()) >= 10


def test_odd_rows(spark):
    book = " ".join(f"w{i % 30_000}" for i in range(130_000))
    odd = [(1, None, "x"), (2, "", "x"), (None, " \t\n", "x"), (3, "a " * 6, "x"), (3, "a " * 6, "x"), (4, "a\x0ba\x0ca\ra\ta\na b", "x"),
           (5, "x" * 300_000, None), (6, book, "x"), (7, "é é é é é é\u00a0é é", "x")]
    df = spark.createDataFrame(odd, "runs long, text string, collapsed string").withColumnRenamed("runs", "n_words")
    rows = [(r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(df).collect()]
    assert sorted(len(r[1]) for r in rows) == [0] * 5 + [1] * 4  # a no-break space is part of a word
    assert rows[0] == (0, [], "") and rows[3] == (6, [(0, 6, 1)], "a") and rows[3] == rows[4] and rows[5] == (7, [(0, 6, 1)], "a b")
    assert rows[7][1] == [(0, 130_000, 30_000)] and len(rows[7][2].split()) == 30_000
    assert periodic_runs(df.limit(0)).count() == 0 and set(periodic_runs(df).columns) == {"n_words", "runs", "text", "collapsed", "collapsed_sha256"}


@pytest.mark.parametrize("n", [1 << 20])
def test_long_text_is_linear(n):
    r = np.random.default_rng(1)
    symbols = np.concatenate([r.integers(0, 1000, n), np.tile(np.arange(100_000), 5), [-1]])
    found = find_runs(symbols, np.array([len(symbols) - 1]))
    assert (found.length[found.period == 100_000] >= 500_000).any()
