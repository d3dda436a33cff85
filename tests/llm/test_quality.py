"""Quality verdicts on prose, symbols and tables; counts against plain Python."""

import random
import re
from collections import Counter

import pyarrow.parquet as pq

from emberstat.llm.quality import judge_quality
from emberstat.llm.queries import QUERIES
from tests.conftest import SMALL


def test_base_counts(spark):
    table = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    got = {r["doc_id"]: r for r in QUERIES["op5_quality"](spark, SMALL).collect()}
    for d, t in zip(table["doc_id"], table["text"]):
        words = re.findall(r"[^\x20\x09-\x0d]+", t)
        runs = Counter(zip(words, words[1:], words[2:]))
        hit = {p for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(hit))
        assert (r["n_symbols"], r["n_dup_lines"]) == (len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(hit) > 50 * len(words)) and not (r["base_failed"] and r["kept"])


def test_clean_documents_are_kept(spark):
    folder = "/root/testdata/sf0.01"
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op5_quality"](spark, folder).collect() if r["doc_id"] in quality and not r["base_failed"]]
    clean = [r["kept"] for r in rows if quality[r["doc_id"]] == 1]
    junk = [r["kept"] for r in rows if quality[r["doc_id"]] == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.4 * len(junk)


WORDS = {
    "it": """tutti gli esseri umani nascono liberi ed eguali in dignità diritti essi sono dotati di ragione coscienza devono agire verso altri
        spirito fratellanza ogni individuo spettano tutte le libertà enunciate nella presente dichiarazione senza distinzione alcuna per ragioni""",
    "ru": """все люди рождаются свободными равными в своем достоинстве правах они наделены разумом совестью должны поступать отношении друг друга
        духе братства каждый человек должен обладать всеми правами свободами провозглашенными настоящей декларацией без какого бы то ни было различия""",
    "zh": """人人生而自由 在尊严和权利上 一律平等 他们赋有 理性和良心 并应以兄弟关系 的精神相对待 人人有资格 享有本宣言 所载的一切权利 和自由 不分种族 肤色 性别
        语言 宗教 政治 或其他见解 国籍 或社会出身 财产 出生 或其他身份 等任何区别 并且不得 因一人所属 的国家"""}


def test_scripts_do_not_spoil_each_other(spark):
    r = random.Random(5)

    def text(lang):
        return " ".join(r.choice(WORDS[lang].split()) + ("." if i % 12 == 11 else "") for i in range(120))

    # labels of their own, one label of two scripts, null labels of three
    clean = [(f"{label} {lang} {i}", label, text(lang)) for i in range(24)
             for label, lang in [("it", "it"), ("ru", "ru"), ("sr", "it"), ("sr", "ru"), (None, "it"), (None, "ru"), (None, "zh")]]
    junk = [(f"junk {label} {kind}", label, t) for label in ("it", "ru", None) for kind, t in [
        ("symbols", " ".join(f"a{r.choice('#*$%&|<>') * 9}{i}" for i in range(120))), ("digits", " ".join(str(r.randrange(10**8)) for _ in range(120)))]]
    got = {x["id"]: x for x in judge_quality(spark.createDataFrame(clean + junk, "id string, lang string, text string")).collect()}
    assert not [c[0] for c in clean if not got[c[0]]["kept"]] and not [j[0] for j in junk if got[j[0]]["kept"]]
    assert len(got) == len(clean) + len(junk) and all(x["word_distance"] is None for x in got.values())
