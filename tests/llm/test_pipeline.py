"""Every pipeline stage on its own input against a plain version."""

import hashlib
import math
from collections import Counter

import pytest

import corpus_pipeline
from emberstat.llm.common import stage
from emberstat.llm.mixing import mix
from emberstat.sources.tables import table
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.test_decontaminate import expected

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows that the small table lacks.
MORE = [(9001, None, "en", "src0", 0), (9002, "123 ### 456", None, "src0", 11), (None, "Thhaen ofthe that anding", "en", None, 24), (9003, "", "fr", "src1", 0)]


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SMALL, "documents")
    out = [stage(docs.unionByName(spark.createDataFrame(MORE, docs.schema)), "documents")]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], SMALL), name))
    return [o.collect() for o in out], out


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(o.columns == COLUMNS for o in steps[1][:-1]) and steps[1][-1].columns == [*COLUMNS, "shard"]


def test_language_stage_drops_what_has_no_letters_only(steps):
    before, after = steps[0][:2]
    gone = [r for r in before if r["doc_id"] not in ids(after)]
    assert {9001, 9002, 9003} <= {r["doc_id"] for r in gone}
    assert sum(any(map(str.isalpha, r["text"] or "")) for r in gone) <= 2
    rows = {r["doc_id"]: r for r in before}
    assert all(tuple(r) == tuple(rows[r["doc_id"]]) for r in after)


def test_one_document_of_each_class_stays(steps):
    before, after = steps[0][1:3]
    classes = brute.near_classes([r["text"] for r in before])
    first = {}
    for r, c in zip(before, classes):
        first[c] = min(first.get(c, math.inf), math.inf if r["doc_id"] is None else r["doc_id"])
    assert ids(after) == Counter(None if v == math.inf else v for v in first.values())


def test_contaminated_documents_go(spark, steps):
    items = [tuple(r) for r in table(spark, SMALL, "benchmark").collect()]
    before, after = steps[0][2:4]
    kept = [r["doc_id"] for r in before if not ((e := expected(r["text"], items))[1] and 20 * e[1] >= e[0])]
    assert len(kept) < len(before) and ids(after) == Counter(kept)


def test_mixing_repeats_as_often_as_the_mix_takes(steps):
    plan = {r["id"]: r for r in mix(steps[1][3]).collect()}
    copies = ids(steps[0][4])
    assert set(copies) <= set(plan) and max(copies.values()) <= 3
    for d, r in plan.items():
        share = r["taken"] / r["size"] if r["size"] else 0
        assert math.floor(share) <= copies.get(d, 0) <= math.ceil(share)


def test_shards_follow_the_tree(steps):
    def draw(key, child):
        return -math.log((int(hashlib.md5(f"{key}@{child}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52)

    for r in steps[0][5]:
        key = "" if r["doc_id"] is None else r["doc_id"]
        region = min("r0", "r1", key=lambda c: draw(key, c) / 4)
        rack = min((f"{region}/k{k}" for k in (0, 1, 2, 3) if k // 2 == int(region[1])), key=lambda c: draw(key, c) / 2)
        first = int(rack[-1]) * 2
        assert r["shard"] == min((first, first + 1), key=lambda s: draw(key, f"{rack}#{s}"))
    assert ids(steps[0][5]) == ids(steps[0][4])


def test_run_gives_the_same_rows(spark):
    docs = table(spark, SMALL, "documents")
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL), "again")
    assert sorted(map(str, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(str, docs.collect()))
