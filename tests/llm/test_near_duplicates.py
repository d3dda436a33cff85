"""Near-duplicate classes against all pairs, and the shapes a table can have."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from emberstat.llm import near_duplicates as nd
from emberstat.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute


def groups(rows, key):
    out = {}
    for r in rows:
        out.setdefault(r[key], set()).add(r["doc_id"])
    return sorted(map(sorted, out.values()))


def test_query_matches_all_pairs(spark):
    table = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    rows = QUERIES["op4_near_duplicates"](spark, SMALL).collect()
    want = {}
    for d, c in zip(table["doc_id"], brute.near_classes(table["text"])):
        want.setdefault(c, []).append(d)
    assert groups(rows, "class_id") == sorted(map(sorted, want.values()))
    assert {r["class_id"]: r["doc_id"] for r in rows if r["kept"]} == {min(c): min(c) for c in want.values()}


@pytest.mark.parametrize("seed", range(4))
def test_alignment_is_the_longest_common_subsequence(seed):
    r = random.Random(seed)
    for _ in range(60):
        x = [r.randrange(12) for _ in range(r.randint(1, 80))]
        y = [v for v in x if r.random() > 0.1]
        for _ in range(r.randint(0, 6)):
            y.insert(r.randint(0, len(y)), r.randrange(12))
        y = y or [1]
        a, b = np.array(x, np.uint64), np.array(y, np.uint64)
        assert nd.aligned(a, b, len(x) + len(y)) == brute.lcs(x, y)
        s = brute.lcs(x, y) / (len(x) + len(y) - brute.lcs(x, y))
        got = nd.similarity(a, b)
        assert got == 0 and s < 0.8 or got == pytest.approx(s)


def test_odd_tables(spark):
    body = " ".join(f"w{i}" for i in range(100))
    near = body.replace("w50", "x")
    turned = " ".join(f"w{i}" for i in [*range(50, 100), *range(50)])
    rows = [(1, body, "a"), (2, near, "b"), (3, body.upper() + "!", None), (None, None, "c"), (4, None, "c"), (5, "", None), (6, "", "d"),
            (7, "?!", "e"), (8, "two words", "f"), (9, "Two, words", "g"), (1, body, "a"), (10, turned, "h"), (None, "alone here", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rid string")
    got = nd.classes(df)[1].collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["class_id"], []).append(r)
    assert sorted(r["id"] for r in by[1]) == [1, 1, 2, 3] and sum(r["kept"] for r in by[1]) == 1
    assert {r["class_rows"] for r in by[1]} == {4}
    assert sorted(r["id"] for r in by[5]) == [5, 6] and sorted(r["id"] for r in by[8]) == [8, 9]
    assert all(len(by[k]) == 1 for k in (4, 7, 10))
    kept = nd.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "None", "4", "5", "7", "8", "10", "None"])
    assert nd.deduplicate(df.limit(0)).count() == 0


def test_one_large_group_and_a_shared_passage(spark):
    """A group of near copies is one class; texts that share a passage stay apart."""
    r = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(120):
        text = list(base)
        text[r.randrange(120)] = f"v{i}"
        rows.append((i, " ".join(text)))
    passage = [f"p{i}" for i in range(60)]
    rows += [(1000 + i, " ".join([*(f"u{i}x{j}" for j in range(30)), *passage])) for i in range(60)]
    got = nd.classes(spark.createDataFrame(rows, "doc_id long, text string"))[1].collect()
    assert {x["class_id"] for x in got if x["id"] < 1000} == {0}
    assert all(x["class_id"] == x["id"] for x in got if x["id"] >= 1000)


def test_chains_lose_no_link(spark):
    """Each text is near the next one only; the class holds the whole chain."""
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(base)))
        for j in range(3):
            base[(i * 3 + j) * 5 + 2] = f"n{i}.{j}"
    got = nd.classes(spark.createDataFrame(rows, "doc_id long, text string"))[1].collect()
    want = brute.near_classes([t for _, t in rows])
    assert {x["id"]: x["class_id"] for x in got} == {i: want[i] for i in range(12)}


def test_short_near_copies_always_meet(spark):
    # 4 of 5 shingles: the sketches miss 2.8 % of such pairs
    words = [[f"p{k}w{i}" for i in range(9)] for k in range(600)]
    rows = [(2 * k, " ".join(w)) for k, w in enumerate(words)] + [(2 * k + 1, " ".join(w[1:] if k % 2 else w[:-1])) for k, w in enumerate(words)]
    got = {r["id"]: r["class_id"] for r in nd.classes(spark.createDataFrame(rows, "doc_id long, text string"))[1].collect()}
    assert [d for d in got if got[d] != d // 2 * 2] == []


def test_short_entries_meet_for_every_link():
    r = random.Random(2)
    seen = 0
    for _ in range(4000):
        w = [r.randrange(r.choice([2, 3, 50])) for _ in range(r.randint(8, 22))]
        at, n = r.choice([0, len(w), r.randint(0, len(w))]), r.randint(1, 4)
        v = w[:at] + r.choice([w[max(0, at - n) : at], [r.randrange(50)]]) + w[at:]
        a, b = (nd.mix64(np.array(t, np.uint64)) for t in (w, v))
        x, y = nd.shingles(a, nd.SHINGLE), nd.shingles(b, nd.SHINGLE)
        if len(y) < nd.FEW and nd.similarity(x, y) >= nd.SIMILARITY:
            seen += 1
            assert len(np.intersect1d(nd.short_entries(a, x), nd.short_entries(b, y)))
    assert seen > 300


def crowd(n, seed=5):
    """Texts that share a passage of half their words, and a few that are near one of them."""
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, [*(f"u{i}x{j}" for j in range(30)), *passage, *(f"v{i}x{j}" for j in range(30))]) for i in range(n)]
    near = []
    for k in range(0, n, 40):
        text = list(rows[k][1])
        text[r.randrange(30)] = "changed"
        near.append((n + k, text))
    return [(i, " ".join(t)) for i, t in rows + near]


def test_a_shared_passage_does_not_make_all_pairs(spark, monkeypatch):
    seen = {}
    prefix_pairs = nd.prefix_pairs

    def counted(*args):
        out = prefix_pairs(*args)
        seen["prefix"] = seen.get("prefix", 0) + out.count()
        return out

    monkeypatch.setattr(nd, "prefix_pairs", counted)
    for n in (400, 1200):
        seen.clear()
        rows = crowd(n)
        got = {x["id"]: x["class_id"] for x in nd.classes(spark.createDataFrame(rows, "doc_id long, text string"))[1].collect()}
        assert all(got[i] == (i - n if i >= n else i) for i, _ in rows)
        assert "prefix" in seen and seen["prefix"] <= 4 * n  # the last round met a crowd, and made no pairs of it


def test_prefix_pairs_hold_every_link(spark):
    r = random.Random(8)
    texts = []
    for k in range(60):
        base = [f"w{r.randrange(60)}" for _ in range(r.choice([12, 40, 90]))]
        texts.append(base)
        for _ in range(2):
            copy = list(base)
            for _ in range(r.randint(1, max(1, len(base) // 20))):
                copy[r.randrange(len(copy))] = f"z{r.randrange(9)}"
            texts.append(copy)
    texts = [" ".join(t) for t in texts]
    sh = [brute.shingles(t) for t in texts]
    df = spark.createDataFrame([(i, t, len(s), i, True) for i, (t, s) in enumerate(zip(texts, sh))], "node long, text string, n int, comp long, waits boolean")
    found = {(x["node"], x["leader"]) for x in nd.prefix_pairs(df).collect()}
    links = {(i, j) for i in range(len(sh)) for j in range(len(sh)) if i != j and texts[i] != texts[j] and brute.linked(sh[i], sh[j])}
    assert len(links) >= 40 and links <= found


def few_share(n=60, each=6):
    """Groups of texts that share two thirds of their words, too little to be linked."""
    rows = [(g * each + i, " ".join([*(f"u{g}x{i}x{j}" for j in range(40)), *(f"p{g}x{j}" for j in range(80))])) for g in range(n) for i in range(each)]
    return [(i, t, 116, i, True) for i, t in rows], "node long, text string, n int, comp long, waits boolean"


def test_the_order_of_prefixes_counts_every_shingle(spark, monkeypatch):
    """Passages that only a few texts share are known as such, however large the table: their texts don't meet."""
    monkeypatch.setattr(nd, "SAMPLE", 500, raising=False)  # a sample would be this small a share of a large table
    assert nd.prefix_pairs(spark.createDataFrame(*few_share())).count() <= 20


def test_full_slots_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(nd, "SLOTS", (1, 1))
    monkeypatch.setattr(nd, "PART", 1)
    rows, kind = few_share(8)
    rows += [(1000 + i, t.replace(t.split()[3], "changed"), 116, 1000 + i, True) for i, t, *_ in rows]
    found = {(x["node"], x["leader"]) for x in nd.prefix_pairs(spark.createDataFrame(rows, kind)).collect()}
    assert {(i, 1000 + i) for i in range(48)} <= found


def test_shingle_counts(spark):
    texts = [" ".join(f"w{i % 7}x{j}" for j in range(30)) for i in range(300)] + ["one more", "", "c " * 400]
    items = np.concatenate([nd.labelled(nd.shingles(nd.words_of(pa.array([t])).hash, nd.SHINGLE)) for t in texts])
    want = np.bincount((items >> np.uint64(64 - nd.SLOTS[0])).astype(np.int64), minlength=1 << nd.SLOTS[0])
    df = spark.createDataFrame(list(enumerate([*texts, None])), "node long, text string").repartition(3)
    assert (nd.shingle_counts(df, len(items)) == want).all() and want.max() < 128
    many = nd.shingle_counts(spark.createDataFrame([(i, "a b c d e") for i in range(600)], "node long, text string").repartition(4), 600)
    assert np.count_nonzero(many) == 1 and many.max() == 128 + int(8 * np.log2(600 / 128))


def test_links_without_a_common_entry_are_found(spark):
    """29 of 36 shingles, and no sketch entry in common: only the last round compares them."""
    rows = []
    for k, seed in enumerate((225, 584)):
        words = [f"s{seed}w{i}" for i in range(40)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:33]))]
    own = [nd.labelled(nd.shingles(nd.words_of(pa.array([t])).hash, nd.SHINGLE)) for _, t in rows]
    assert all(not len(np.intersect1d(nd.order_minhash(own[k]), nd.order_minhash(own[k + 1]))) for k in (0, 2))
    rows.append((9, "some other text of a few words that nobody copied"))
    got = {r["id"]: r["class_id"] for r in nd.classes(spark.createDataFrame(rows, "doc_id long, text string"))[1].collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 9: 9}


def test_long_texts_are_aligned_within_their_band():
    import time

    r = np.random.default_rng(3)
    x = nd.mix64(np.arange(200_000, dtype=np.uint64))
    y = np.delete(x, r.choice(len(x), 15_000, replace=False))
    y = np.insert(y, r.choice(len(y), 5_000), nd.mix64(np.arange(1 << 40, (1 << 40) + 5_000, dtype=np.uint64)))
    began = time.time()
    assert nd.similarity(x, y) >= 0.8
    assert nd.similarity(x, r.permutation(x)) < 0.8
    turned = np.concatenate([x[30_000:], x[:30_000]])
    assert nd.similarity(x, turned) < 0.8
    assert time.time() - began < 10


def test_very_long_documents(spark):
    book = [f"w{i}" for i in range(150_000)]
    other = [f"x{i}" if i % 50 == 0 else w for i, w in enumerate(book)]
    rows = [(1, " ".join(book)), (2, " ".join(other[:140_000] + ["end"])), (3, " ".join(reversed(book))), (4, "a b c d e f")]
    got = {x["id"]: x["class_id"] for x in nd.classes(spark.createDataFrame(rows, "doc_id long, text string"))[1].collect()}
    want = brute.shingles(rows[0][1]), brute.shingles(rows[1][1])
    share = len(set(want[0]) & set(want[1])) / len(set(want[0]) | set(want[1]))
    assert got == {1: 1, 2: 1 if share >= 0.8 else 2, 3: 3, 4: 4}
