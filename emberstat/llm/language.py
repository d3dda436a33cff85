"""Language identification by nearest centroid.

A text is a vector of byte 2- and 3-grams of its folded letters, hashed to
``DIMENSIONS`` places, weighted by log tf x idf and normalised. Each
language has several centroids (spherical k-means over its labelled sample);
a text gets the language of the centroid with the largest cosine, and is
rejected when it lies too far from it. How far is too far depends on how much
there is to compare: each centroid has a limit for each band of distinct
n-grams, from what the sample's texts and pieces cut from them reach.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checked_broadcast, pieces, small_batches, stage, utf8, with_results

DIMENSIONS = 4096
#: Bands of distinct n-grams, two for each doubling.
BANDS = 2 * DIMENSIONS.bit_length()
#: Characters of the pieces cut from sample texts.
PIECES = tuple(8 << k for k in range(10))
#: Fewest texts of a cluster, as a number and as a share of the sample; fewest texts or pieces that set a limit.
LEAST_TEXTS, LEAST_SHARE, LEAST_SEEN = 20, 0.02, 20
_CODES = np.arange(256)
# letters keep their (folded) byte, everything else is a gap
_LETTER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, np.where(((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128), _CODES, 32)).astype(np.uint32)
RESULTS = ["lang_pred", "score", "rejected"]


def ngram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed 2- and 3-grams, a row for each text; whole texts."""
    raw, offsets = utf8(texts)
    n = len(texts)
    if n == 0:
        return np.zeros((0, DIMENSIONS), np.float32)
    # a gap before and behind each text
    place = np.arange(len(raw)) + 2 * np.repeat(np.arange(n), np.diff(offsets)) + 1
    stream = np.full(len(raw) + 2 * n + 2, 32, np.uint32)
    stream[place] = _LETTER[raw]
    owner = np.repeat(np.arange(n), np.diff(offsets) + 2)
    a, b, c = stream[:-2], stream[1:-1], stream[2:]
    use = ~((a == 32) & (b == 32))
    a, b, c, owner = a[use], b[use], c[use], owner[use]
    two = ((a << np.uint32(8) | b) * np.uint32(2654435761)) >> np.uint32(20)
    three = (((a << np.uint32(16)) | (b << np.uint32(8)) | c) * np.uint32(2246822519) + np.uint32(374761393)) >> np.uint32(20)
    keys = np.concatenate([owner * DIMENSIONS + two, owner * DIMENSIONS + three])
    return np.bincount(keys, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS).astype(np.float32)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts) * idf
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(size > 0, size, 1)


def has_letters(texts: pa.Array) -> np.ndarray:
    raw, offsets = utf8(texts)
    seen = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((_LETTER[raw] < 128) & (_LETTER[raw] != 32), out=seen[1:])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for k in np.flatnonzero(~out & (offsets[1:] > offsets[:-1])):  # no letter of a-z: look at the code points
        out[k] = any(map(str.isalpha, texts[int(k)].as_py()))
    return out


def bands(counts: np.ndarray) -> np.ndarray:
    """Band of each row by its number of distinct n-grams."""
    return (2 * np.log2(np.maximum((counts > 0).sum(axis=1), 1))).astype(np.int64)


def spherical_clusters(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """At most ``k`` centroids of unit vectors by cosine, and each vector's cluster. Starts are far from each other, so
    runs agree, and in dense places; clusters of a few vectors are dropped, and theirs go to the others."""
    few = max(LEAST_TEXTS, LEAST_SHARE * len(x))
    k = max(1, min(k, int(len(x) / few)))
    near = min(LEAST_TEXTS, len(x))
    dense = np.concatenate([np.partition(x[at : at + 256] @ x.T, -near, axis=1)[:, -near:].mean(axis=1) for at in range(0, len(x), 256)])
    dense = dense >= np.quantile(dense, 0.1)
    start = [int(np.argmax(x @ x.mean(axis=0)))]
    best = x @ x[start[0]]
    for _ in range(1, k):
        start.append(int(np.argmin(np.where(dense, best, 2))))
        best = np.maximum(best, x @ x[start[-1]])
    centre = x[start].copy()
    while True:
        for _ in range(rounds):
            own = np.argmax(x @ centre.T, axis=1)
            for j in range(len(centre)):
                if (own == j).any():
                    mean = x[own == j].mean(axis=0)
                    centre[j] = mean / max(float(np.linalg.norm(mean)), 1e-12)
        own = np.argmax(x @ centre.T, axis=1)
        size = np.bincount(own, minlength=len(centre))
        if len(centre) == 1 or size.min() >= few:
            return centre, own
        centre = np.delete(centre, int(size.argmin()), axis=0)


def limits(texts: pa.Array, x: np.ndarray, idf: np.ndarray, centre: np.ndarray, own: np.ndarray, reject: float) -> np.ndarray:
    """Least cosine for each centroid and band: ``reject`` times what all but 1 % of the sample's texts, and of pieces
    cut from them, reach without their own text's part in its centroid; it doesn't fall with the band. Bands without
    enough of them lie on the line between their neighbours; beyond the last the limit stays, before the first it is 0.
    All 0 if no band has enough."""
    sums = np.stack([x[own == j].sum(axis=0) for j in range(len(centre))])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for size in (None, *PIECES):
        which = np.arange(len(texts)) if size is None else np.flatnonzero(pc.utf8_length(texts).to_numpy(zero_copy_only=False) > size)
        for at in range(0, len(which), 256):
            of = which[at : at + 256]
            cut = texts.take(pa.array(of))
            counts = ngram_counts(cut if size is None else pc.utf8_slice_codeunits(cut, 0, size))
            v = vectors(counts, idf)
            cosine = v @ centre.T
            rest = sums[own[of]] - x[of]
            cosine[np.arange(len(of)), own[of]] = (v * rest).sum(axis=1) / np.maximum(np.linalg.norm(rest, axis=1), 1e-6)
            found.append((cosine.argmax(axis=1), bands(counts), cosine.max(axis=1)))
    nearest, band, close = (np.concatenate(f) for f in zip(*found))
    out = np.zeros((len(centre), BANDS))
    for j in range(len(centre)):
        mine = nearest == j
        seen = np.flatnonzero(np.bincount(band[mine], minlength=BANDS) >= LEAST_SEEN)
        if len(seen):
            low = [float(np.quantile(close[mine & (band == b)], 0.01)) for b in seen]
            out[j] = reject * np.interp(np.arange(BANDS), seen, np.maximum.accumulate(low), left=0)
    return out


class Model(NamedTuple):
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    least: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Every fourth document by the CRC of its id never trains; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """At most ``per_language`` distinct labelled texts of each language, chosen by a hash of the text.

    The languages' counts of distinct texts (by 64-bit hash) give each a share of the hash range, so that only about
    as many texts as are wanted are sorted, however many copies there are.
    """
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    counts = rows.select("lang", "hash").distinct().groupBy("lang").count()
    counts = checked_broadcast(stage(counts, "languages"), 64)  # a row for each label; keeps texts of a common one apart
    # 100 more, so that few wanted texts are reached too
    wanted = float(1 << 32) * (2 * per_language + 100)
    near = rows.withColumn("draw", F.pmod("hash", F.lit(1 << 32))).join(counts, "lang").filter(F.col("draw") * F.col("count") < F.lit(wanted))
    near = near.dropDuplicates(["lang", "hash"]).drop("count")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "hash"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= per_language)


def fit(docs: DataFrame, clusters: int = 4, per_language: int = 1000, reject: float = 0.6, text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Fit on at most ``per_language`` labelled texts of each language. A text is rejected below ``reject`` times the
    cosine that all but 1 % of a cluster's sample reach with about as many distinct n-grams (``limits``); a cluster of too
    few texts to tell takes the smallest limits of the others. The model, ``clusters`` vectors of ``DIMENSIONS`` numbers
    and ``BANDS`` limits for each label, is what reaches the driver."""
    small_batches(docs.sparkSession)
    sample = stage(training_sample(docs, per_language, text_col, lang_col).repartition(16, "draw"), "languages")

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for piece in pieces(batch, 0):
                for at in range(0, piece.num_rows, 256):
                    texts = piece.column(0).slice(at, 256)
                    df += (ngram_counts(texts) > 0).sum(axis=0)
                    n += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1), pa.int64()), pa.array(np.append(df, n), pa.int64())], ["place", "n"])

    seen = dict(map(tuple, sample.select("text").mapInArrow(document_counts, "place long, n long").groupBy("place").agg(F.sum("n")).collect()))
    total = seen.get(DIMENSIONS, 0)
    idf = np.array([np.log((1 + total) / (1 + seen.get(k, 0))) + 0.1 for k in range(DIMENSIONS)], np.float32)

    def one_language(group: pa.Table) -> pa.Table:
        group = group.sort_by([("draw", "ascending"), ("hash", "ascending")])
        x = np.concatenate([vectors(ngram_counts(t), idf) for c in group["text"].chunks for t in [c.slice(at, 256) for at in range(0, len(c), 256)]])
        centre, own = spherical_clusters(x, clusters)
        least = limits(group["text"].combine_chunks(), x, idf, centre, own, reject)
        return pa.table({"lang": [group["lang"][0].as_py()] * len(centre), "cluster": pa.array(range(len(centre)), pa.int32()),
                         "centroid": pa.array([c.astype(np.float32) for c in centre], pa.list_(pa.float32())),
                         "least": pa.array(list(least), pa.list_(pa.float64()))})

    rows = sample.groupBy("lang").applyInArrow(one_language, "lang string, cluster int, centroid array<float>, least array<double>")
    found = sorted(rows.collect(), key=lambda r: (r["lang"], r["cluster"]))
    least = np.array([r["least"] for r in found], np.float64).reshape(-1, BANDS)
    told = least.any(axis=1)
    if told.any():
        least[~told] = least[told].min(axis=0)
    return Model(idf, np.array([r["centroid"] for r in found], np.float32).reshape(-1, DIMENSIONS), [r["lang"] for r in found],
                 least)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (all by default) with ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1) and
    ``rejected`` of each whole text; an input column of such a name is replaced.

    A null text, a text without letters, and any text when nothing could be learned give ``und``, score 0, rejected.
    Ties go to the first language by name. Repeated rows each give a row; an empty table none.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.langs, "und"], object)
        for batch in batches:
            for piece in pieces(batch, 1):
                for at in range(0, piece.num_rows, 256):
                    part = piece.slice(at, 256)
                    texts = part.column(1)
                    known = has_letters(texts)
                    if len(m.langs):
                        counts = ngram_counts(texts)
                        cosine = vectors(counts, m.idf) @ m.centroids.T
                        nearest = cosine.argmax(axis=1)
                        best = np.where(known, nearest, len(m.langs))
                        score = np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0.0).astype(np.float64)
                        out = ~known | (score < m.least[nearest, bands(counts)])
                    else:
                        best, score, out = np.zeros(len(texts), int), np.zeros(len(texts)), np.ones(len(texts), bool)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(out)], ["row", *RESULTS])

    schema = T.StructType([df.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])
    return with_results(df.mapInArrow(run, schema), "row", RESULTS)
