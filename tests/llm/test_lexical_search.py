"""Ranked search against scoring every document."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from emberstat.llm import lexical_search
from emberstat.llm.lexical_search import Index, search
from tests.llm import brute


def ranked(docs, items, k):
    own = [(d, Counter(brute.words(t))) for d, t in docs]
    n, total = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c in own:
            m = 50 + (50 * sum(c.values()) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(brute.words(text)) if t in c)
            if s > 0:
                rows.append((-s, d is None, d))
        rows.sort(key=lambda x: x if not x[1] else x[:2])
        out += [(item, r + 1, x[2], -x[0]) for r, x in enumerate(rows[:k])]
    return out


def corpus(seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{int(r.paretovariate(0.7))}" for _ in range(400)]
    docs = [(i if r.random() > 0.02 else None, " ".join(r.choices(vocabulary, k=r.randint(0, 60)))) for i in range(n)]
    docs += [(n + i, "Copy of ONE text w1 w2") for i in range(n // 3)] + [(7, docs[7][1]), (n * 9, None), (n * 9 + 1, " ?!")]
    r.shuffle(docs)
    items = [(f"i{k}", " ".join(r.choices(vocabulary, k=r.randint(1, 30)))) for k in range(12)]
    return docs, items + [("copy", "one copy, one text"), ("i0", items[0][1]), ("null", None), ("none", "unknown terms"), (None, "w1 w2 w3")]


@pytest.mark.parametrize("leaf, block", [(256, 1 << 20), (2, 300)])
def test_equals_brute_force(spark, monkeypatch, leaf, block):
    docs, items = corpus(3, 900)
    monkeypatch.setattr(lexical_search, "LEAF", leaf)  # driver-side modules are used by local workers through the pickled function
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", block)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, rank int, score string").repartition(3)
    i = spark.createDataFrame(items, "item_id string, text string")
    got = [tuple(r) for r in search(d, i, k=10).collect()]
    key = lambda x: (x[0] or "", x[1], x[3], -1 if x[2] is None else x[2])
    assert sorted(got, key=key) == sorted(ranked(docs, items, 10), key=key)
    assert {tuple(r) for r in search(d, i, k=10, part_words=20).collect()} == set(got)


@pytest.mark.parametrize("leaf", [1, 7, 256])
def test_index_finds_the_best_of_a_block(monkeypatch, leaf):
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    r = np.random.default_rng(leaf)
    for trial in range(60):
        n_docs, n_terms = int(r.integers(1, 400)), int(r.integers(1, 12))
        pairs = np.unique(r.integers(0, n_docs * n_terms, int(r.integers(1, 1500))))
        term, doc = pairs // n_docs, pairs % n_docs
        impact = r.integers(1, int(r.choice([2, 5, 10**9])), len(pairs)) if trial % 3 else np.ones(len(pairs), np.int64)
        index = Index(term, doc, impact, n_docs, n_terms)
        for k, least in ((1, 0), (5, 0), (50, 0), (5, 3)):
            own = np.unique(r.integers(0, n_terms, 4))
            total = np.zeros(n_docs, np.int64)
            some = np.isin(term, own)
            np.add.at(total, doc[some], impact[some])
            want = [(d, s) for d, s in sorted(enumerate(total.tolist()), key=lambda x: (-x[1], x[0])) if s >= max(1, least)][:k]
            found, score = index.best(own, k, least)
            assert list(zip(found.tolist(), score.tolist())) == want


def test_few_documents_of_many_are_looked_at(monkeypatch):
    """Most of a block is bounded away, also where a third of it is one text."""
    r = np.random.default_rng(2)
    n = 50_000
    rare = np.sort(r.choice(n, 300, replace=False))
    common = np.sort(r.choice(n, 20_000, replace=False))
    term = np.concatenate([np.zeros(300, int), np.ones(20_000, int), np.full(n // 3, 2)])
    doc = np.concatenate([rare, common, np.arange(n // 3)])
    impact = np.concatenate([r.integers(900, 1000, 300), r.integers(1, 50, 20_000), np.full(n // 3, 60)])
    index = Index(term, doc, impact, n, 3)
    seen = []
    scores = index.scores
    monkeypatch.setattr(index, "scores", lambda lo, hi: (seen.append(int((hi - lo).sum())), scores(lo, hi))[1])
    index.best(np.array([0, 1, 2]), 50)
    assert sum(seen) < len(doc) / 2
    seen.clear()
    index.best(np.array([2]), 50)
    assert sum(seen) < 10_000


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "Word " * 200_000), (4, "word ünï 漢字"), (4, "word ünï 漢字"), (5, "other")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "WORD 漢字"), (1, "WORD 漢字"), (2, None)], "item_id int, text string")
    rows = sorted(tuple(r)[:3] for r in search(docs, items).collect())
    assert rows == sorted([(1, 1, 4), (1, 2, 4), (1, 3, 3)] * 2)
    assert search(docs.limit(0), items).count() == 0 and search(docs, items.limit(0)).count() == 0
    assert search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
