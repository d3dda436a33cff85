"""The Snowball English ("Porter2") stemmer as column expressions.

The published rules are one ordered table; from it come the expressions of a
Spark plan and the SQL text of the same steps for another engine. Every step
reads the columns of the steps before it, so a plan is a chain of projections
of built-in string functions over the distinct words. ``functions.stem`` is
the same algorithm in plain Python, which tests hold this one against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stem import DOUBLES, EXCEPTIONS, INVARIANT_AFTER_1A, LI_ENDINGS, R1_PREFIXES, STEP2, STEP3, STEP4, VOWELS

V, C = f"[{VOWELS}]", f"[^{VOWELS}]"
#: Ends in a short syllable.
SHORT = f"^{V}{C}$|{C}{V}[^{VOWELS}wxY]$"
#: Conditions of rules: what stays in front of the suffix (``{rest}``, of ``{n}`` characters) must meet them.
CONDITIONS = {
    "": "true",
    "R1": "{n} >= r1",
    "R2": "{n} >= r2",
    "R1 after l": "{n} >= r1 AND right({rest}, 1) = 'l'",
    "R2 after s or t": "{n} >= r2 AND right({rest}, 1) IN ('s', 't')",
    "R1 after li-ending": "{n} >= r1 AND right({rest}, 1) IN (" + ", ".join(f"'{c}'" for c in LI_ENDINGS) + ")",
    "vowel": f"regexp_extract({{rest}}, '{V}', 0) != ''",
    "vowel before the last": f"regexp_extract(left({{rest}}, greatest({{n}} - 1, 0)), '{V}', 0) != ''",
    "more than one": "{n} > 1",
}
#: Suffix, replacement and condition; the first suffix that a word has decides, whether its condition holds or not.
RULES = {
    "0": [("~s~", "", ""), ("~s", "", ""), ("~", "", "")],
    "1a": [("sses", "ss", ""), ("ied", "i", "more than one"), ("ies", "i", "more than one"), ("us", "us", ""), ("ss", "ss", ""),
           ("s", "", "vowel before the last")],
    "1b": [("eedly", "ee", "R1"), ("eed", "ee", "R1"), ("ingly", "", "vowel"), ("edly", "", "vowel"), ("ing", "", "vowel"), ("ed", "", "vowel")],
    "2": [(s, r, {"ogi": "R1 after l", "li": "R1 after li-ending"}.get(s, "R1")) for s, r in STEP2],
    "3": [(s, r, {"ative": "R2"}.get(s, "R1")) for s, r in STEP3],
    "4": [(s, "", {"ion": "R2 after s or t"}.get(s, "R2")) for s in STEP4],
}
#: Where a rule's condition fails: another replacement than the suffix itself.
ELSE = {"ied": "ie", "ies": "ie"}


def _ends(word: str, *suffixes: str) -> str:
    n = len(suffixes[0])
    return f"right({word}, {n}) IN ({', '.join(_text(s) for s in suffixes)})"


def _text(s: str) -> str:
    """A literal; ~ stands for the apostrophe, which engines escape in different ways."""
    return "concat(" + ", ".join("chr(39)" if c == "~" else f"'{c}'" for c in s) + ")" if "~" in s else f"'{s}'"


def _step(word: str, rules: list[tuple[str, str, str]]) -> str:
    out = "CASE"
    for suffix, new, condition in rules:
        n = f"(length({word}) - {len(suffix)})"
        rest = f"left({word}, {n})"
        other = f"concat({rest}, '{ELSE[suffix]}')" if suffix in ELSE else word
        holds = CONDITIONS[condition].format(n=n, rest=rest)
        out += f" WHEN {_ends(word, suffix)} THEN CASE WHEN {holds} THEN concat({rest}, '{new}') ELSE {other} END"
    return f"{out} ELSE {word} END"


def steps(word: str, mark: str) -> list[tuple[str, str]]:
    """(column, expression) in order; the last column, ``stem``, is the result. ``mark`` turns y after a vowel into Y in the
    column w0 (engines write groups in different ways)."""
    listed = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXCEPTIONS.items())
    special = " ".join(f"WHEN left(w1, {len(p)}) = '{p}' THEN {len(p)}" for p in R1_PREFIXES)
    region = f"^{C}*{V}+{C}"

    def after(text: str, at: str) -> str:
        found = f"length(regexp_extract({text}, '{region}', 0))"
        return f"CASE WHEN {found} = 0 THEN length(w1) ELSE {at} + {found} END"

    cut = f"{_ends('w3', 'ing')} OR {_ends('w3', 'ed')} OR {_ends('w3', 'ingly')} OR {_ends('w3', 'edly')} AND NOT {_ends('w3', 'eedly')}"
    return [
        ("w0", f"CASE WHEN left({word}, 1) = chr(39) AND length({word}) > 2 THEN substr({word}, 2) ELSE {word} END"),
        ("listed", f"CASE w0 {listed} END"),
        ("w1", f"CASE WHEN left(w0, 1) = 'y' THEN concat('Y', {mark.format('substr(w0, 2)')}) ELSE {mark.format('w0')} END"),
        ("r1", f"CASE {special} ELSE {after('w1', '0')} END"),
        ("r2", after("substr(w1, r1 + 1)", "r1")),
        ("w2", _step("w1", RULES["0"])),
        ("w3", _step("w2", RULES["1a"])),
        ("stays", "w3 IN (" + ", ".join(f"'{w}'" for w in sorted(INVARIANT_AFTER_1A)) + ")"),
        ("w4", _step("w3", RULES["1b"])),
        # what lost its ending is mended
        ("w5", f"CASE WHEN ({cut}) AND NOT {_ends('w3', 'eed')} AND length(w4) < length(w3) THEN CASE WHEN {_ends('w4', 'at', 'bl', 'iz')} THEN concat(w4, 'e') "
               f"WHEN {_ends('w4', *DOUBLES)} THEN left(w4, length(w4) - 1) WHEN r1 >= length(w4) AND regexp_extract(w4, '{SHORT}', 0) != '' THEN concat(w4, 'e') "
               "ELSE w4 END ELSE w4 END"),
        ("w6", f"CASE WHEN length(w5) > 2 AND right(w5, 1) IN ('y', 'Y') AND regexp_extract(left(right(w5, 2), 1), '{C}', 0) != '' "
               "THEN concat(left(w5, length(w5) - 1), 'i') ELSE w5 END"),
        ("w7", _step("w6", RULES["2"])),
        ("w8", _step("w7", RULES["3"])),
        ("w9", _step("w8", RULES["4"])),
        ("w10", f"CASE WHEN right(w9, 1) = 'e' AND (length(w9) - 1 >= r2 OR length(w9) - 1 >= r1 AND regexp_extract(left(w9, length(w9) - 1), '{SHORT}', 0) = '') "
                "OR right(w9, 2) = 'll' AND length(w9) - 1 >= r2 THEN left(w9, length(w9) - 1) ELSE w9 END"),
        ("stem", f"CASE WHEN length({word}) <= 2 THEN {word} WHEN listed IS NOT NULL THEN listed WHEN stays THEN w3 ELSE replace(w10, 'Y', 'y') END"),
    ]


def with_stem(words: DataFrame, col: str) -> DataFrame:
    """(``col``, stem) of each row; a null word has a null stem."""
    df = words.select(F.col(f"`{col}`").alias("word"))
    for name, expression in steps("word", f"regexp_replace({{}}, '({V})y', '$1Y')"):
        df = df.withColumn(name, F.expr(expression))
    return df.select(F.col("word").alias(col), "stem")


def stem_sql(relation: str, col: str) -> str:
    """The same steps as one SELECT (``col``, stem) over a relation, for engines that write groups as \\1."""
    out = f"(SELECT {col} FROM {relation})"
    for name, expression in steps(col, f"regexp_replace({{}}, '({V})y', '\\1Y', 'g')"):
        out = f"(SELECT *, {expression} AS {name} FROM {out})"
    return f"SELECT {col}, stem FROM {out}"
