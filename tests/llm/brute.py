"""Plain Python versions that the operators are held against."""

import re
from collections import Counter

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def shingles(text, k=5):
    w = words(text)
    k = min(k, len(w))
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if k else []


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y):
            last, row[j + 1] = row[j + 1], last + 1 if a == b else max(row[j], row[j + 1])
    return row[-1]


def linked(x, y, least=0.8):
    need = least / (1 + least) * (len(x) + len(y)) - 1e-9
    if sum((Counter(x) & Counter(y)).values()) < need:
        return False
    return lcs(x, y) >= need


def near_classes(texts):
    """Class number of each text."""
    own = list(range(len(texts)))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    sh = [shingles(t) for t in texts]
    for i, t in enumerate(texts):
        for j in range(i):
            if t is None or texts[j] is None or root(i) == root(j):
                continue
            if (t == texts[j]) if not sh[i] or not sh[j] else linked(sh[i], sh[j]):
                own[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]
