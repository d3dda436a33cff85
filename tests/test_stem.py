"""Stemmer goldens: the stems visible in the reference's rendered output,
plus published Snowball English examples; the column expressions and their SQL
against the plain stemmer."""

import random

import pytest

from emberstat.functions import stem as plain
from emberstat.functions.porter2 import stem_sql, with_stem
from emberstat.functions.stem import stem

VISIBLE = {"movies": "movi", "story": "stori", "family": "famili", "comedy": "comedi", "science": "scienc",
           "character": "charact", "animals": "anim"}
PUBLISHED = {"consign": "consign", "consigned": "consign", "consigning": "consign", "consignment": "consign",
             "consist": "consist", "consisted": "consist", "consistency": "consist", "consistent": "consist",
             "knack": "knack", "knackeries": "knackeri", "knaves": "knave", "generously": "generous",
             "skies": "sky", "dying": "die", "news": "news", "succeeded": "succeed", "cried": "cri",
             "ties": "tie", "hopping": "hop", "hoping": "hope", "agreed": "agre", "happy": "happi"}


@pytest.mark.parametrize("word,expected", sorted({**VISIBLE, **PUBLISHED}.items()))
def test_stem(word, expected):
    assert stem(word) == expected


def test_stems_in_spark(spark):
    from emberstat.operators.text import stem_terms

    df = spark.createDataFrame([(w,) for w in VISIBLE], "term string")
    got = {r.term: r.stem for r in stem_terms(df).collect()}
    assert got == VISIBLE


def odd_words():
    r = random.Random(11)
    ends = [s for s, _ in plain.STEP2 + plain.STEP3] + plain.STEP4 + "s ss us ied ies sses ing ed eed eedly ingly edly y e ll 's 's' '".split()
    words = {"".join(r.choice("aeiouybcdlmnstwxzgkr") for _ in range(r.randint(0, 6))) + r.choice(ends) + r.choice(["", "", "s", "ly", "e", "ing", "ed"])
             for _ in range(20_000)}
    listed = set(plain.EXCEPTIONS) | plain.INVARIANT_AFTER_1A
    return sorted(words | listed | {"'" + w for w in listed} | {"generate", "communism", "arsenal", "yyy", "ayyy", "byyy", "eyey", "\u00fcn\u00efted", "a", "", "'", "''s"})


def test_expressions_and_sql_equal_the_plain_stemmer(spark, duck):
    words = odd_words()
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "word string")
    got = {r[0]: r[1] for r in with_stem(df, "word").collect()}
    assert got.pop(None) is None
    assert got == {w: stem(w) for w in words}
    duck.execute("CREATE OR REPLACE TEMP TABLE odd_words (w VARCHAR)")
    duck.execute("INSERT INTO odd_words SELECT unnest(?)", [words])
    assert dict(duck.execute(stem_sql("odd_words", "w")).fetchall()) == got
