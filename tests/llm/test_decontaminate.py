"""Suffix-array matches against a scan of every window, blocks, and odd tables."""

import random

import numpy as np
import pytest

from emberstat.llm import decontaminate as dc
from tests.llm import brute


def expected(text, items, window=13):
    """words, hit words, item ids, longest verbatim match."""
    w = brute.words(text)
    hit, ids, longest = set(), set(), 0
    for item, t in items:
        own = brute.words(t)
        n = min(window, len(own))
        if not n:
            continue
        for i in range(len(own) - n + 1):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == own[i : i + n]:
                    hit.update(range(p, p + n))
                    if item is not None:
                        ids.add(str(item))
                    k = n
                    while i + k < len(own) and p + k < len(w) and own[i + k] == w[p + k]:
                        k += 1
                    longest = max(longest, k)
    return len(w), len(hit), sorted(ids), longest


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array(seed):
    r = np.random.default_rng(seed)
    s = r.integers(0, 4, 300).astype(np.uint64)
    order = dc.suffix_array(s, 8)
    assert sorted(order) == list(range(300))
    keys = [tuple(s[i : i + 8]) for i in order]
    assert keys == sorted(keys)


@pytest.fixture(scope="module")
def tables():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(30)]
    draw = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(draw(r.choice([5, 13, 20, 40])))) for i in range(25)]
    items += [(100, items[0][1]), (0, items[0][1]), (None, items[3][1]), (101, None), (102, ""), (103, "?!"), (104, "w1")]
    docs = []
    for i in range(120):
        words = draw(r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            own = r.choice(items[:25])[1].split()
            a = r.randrange(len(own))
            words += own[a : a + r.randint(1, 40)] + draw(2)
        docs.append((i, " ".join(words).upper() if i % 7 == 0 else ", ".join(words), f"s{i % 3}"))
    docs += [(None, items[1][1], None), (200, None, "s"), (201, "", "s"), (0, docs[0][1], "s0")]
    return docs, items


@pytest.mark.parametrize("block_words", [4_000_000, 60])
def test_matches_brute_force(spark, tables, block_words):
    docs, items = tables
    df = spark.createDataFrame(docs, "doc_id long, text string, n_words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find_matches(df, bench, keep=["doc_id"], block_words=block_words)
    got = sorted((str(r["doc_id"]), r["n_words"], sum(h["end"] - h["start"] for h in r["hits"]), r["items"], r["longest_match"]) for r in found.collect())
    assert got == sorted((str(d), *expected(t, items)) for d, t, _ in docs)


def test_removes_contaminated_rows_whole(spark, tables):
    docs, items = tables
    df = spark.createDataFrame(docs, "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = dc.decontaminate(df, bench)
    assert kept.columns == df.columns
    want = [d for d in docs if not ((e := expected(d[1], items))[1] > 0 and 20 * e[1] >= e[0])]
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, want))
    assert dc.decontaminate(df, bench.limit(0)).count() == len(docs)
    assert dc.decontaminate(df.limit(0), bench).count() == 0


def test_a_very_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    long = " ".join(["filler words come again"] * 400_000) + " " + passage
    df = spark.createDataFrame([(1, long), (2, passage)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    rows = {r["doc_id"]: r for r in dc.find_matches(df, bench).collect()}
    assert rows[1]["n_words"] == 1_600_020 and rows[1]["longest_match"] == 20 and rows[1]["items"] == ["7"]
    assert [tuple(h) for h in rows[1]["hits"]] == [(1_600_000, 1_600_020)]
