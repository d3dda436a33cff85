"""Snowball English ("Porter2") stemmer, written from the published
algorithm description (snowballstem.org, English stemmer).

Plain Python on one word, with the published word lists and suffix tables.
Spark plans use the same tables as column expressions (``functions.porter2``).
"""

from __future__ import annotations

from functools import lru_cache

# fixed values of the published algorithm
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
R1_PREFIXES = ("gener", "commun", "arsen")
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias",
    "andes": "andes",
}
INVARIANT_AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
STEP2 = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"),
    ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"),
    ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"),
    ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"),
    ("ogi", "og"), ("li", ""),
]
STEP3 = [
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ative", ""),
    ("ical", "ic"), ("ness", ""), ("ful", ""),
]
STEP4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize",
         "ion", "al", "er", "ic"]


def _is_vowel(ch: str) -> bool:
    return ch in VOWELS


def _region_after(word: str, start: int) -> int:
    """Index after the first non-vowel that follows a vowel, from ``start``."""
    for i in range(start + 1, len(word)):
        if not _is_vowel(word[i]) and _is_vowel(word[i - 1]):
            return i + 1
    return len(word)


def _short_syllable_at_end(w: str) -> bool:
    if len(w) == 2:
        return _is_vowel(w[0]) and not _is_vowel(w[1])
    if len(w) >= 3:
        return (not _is_vowel(w[-3]) and _is_vowel(w[-2]) and not _is_vowel(w[-1])
                and w[-1] not in "wxY")
    return False


def _has_vowel(s: str) -> bool:
    return any(_is_vowel(c) for c in s)


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    w = word[1:] if word.startswith("'") else word
    if w in EXCEPTIONS:
        return EXCEPTIONS[w]
    # y at the start or after a vowel is a consonant
    chars = list(w)
    for i, ch in enumerate(chars):
        if ch == "y" and (i == 0 or _is_vowel(chars[i - 1])):
            chars[i] = "Y"
    w = "".join(chars)

    r1 = next((len(p) for p in R1_PREFIXES if w.startswith(p)), None)
    if r1 is None:
        r1 = _region_after(w, 0)
    r2 = _region_after(w, r1) if r1 < len(w) else len(w)

    # step 0
    for suf in ("'s'", "'s", "'"):
        if w.endswith(suf):
            w = w[: -len(suf)]
            break
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ied") or w.endswith("ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("us") or w.endswith("ss"):
        pass
    elif w.endswith("s"):
        if _has_vowel(w[:-2]):
            w = w[:-1]
    if w in INVARIANT_AFTER_1A:
        return w
    # step 1b
    done = False
    for suf in ("eedly", "eed"):
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                w = w[: -len(suf)] + "ee"
            done = True
            break
    if not done:
        for suf in ("ingly", "edly", "ing", "ed"):
            if w.endswith(suf):
                stem_part = w[: -len(suf)]
                if _has_vowel(stem_part):
                    w = stem_part
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(DOUBLES):
                        w = w[:-1]
                    elif r1 >= len(w) and _short_syllable_at_end(w):
                        w += "e"
                break
    # step 1c
    if len(w) > 2 and w[-1] in "yY" and not _is_vowel(w[-2]):
        w = w[:-1] + "i"
    # step 2
    for suf, rep in STEP2:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ogi":
                    if w[-4:-3] == "l":
                        w = w[:-3] + rep
                elif suf == "li":
                    if len(w) >= 3 and w[-3] in LI_ENDINGS:
                        w = w[:-2]
                else:
                    w = w[: -len(suf)] + rep
            break
    # step 3
    for suf, rep in STEP3:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ative":
                    if len(w) - len(suf) >= r2:
                        w = w[: -len(suf)]
                else:
                    w = w[: -len(suf)] + rep
            break
    # step 4
    for suf in STEP4:
        if w.endswith(suf):
            if len(w) - len(suf) >= r2:
                if suf == "ion":
                    if len(w) >= 4 and w[-4] in "st":
                        w = w[:-3]
                else:
                    w = w[: -len(suf)]
            break
    # step 5
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable_at_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("l"):
        if len(w) - 1 >= r2 and w.endswith("ll"):
            w = w[:-1]
    return w.replace("Y", "y")
