"""Language identification by the nearest of several centroids per language (operator 11).

A text's vector counts its character n-grams of 1 to ``ORDER`` letters, hashed
into ``BUCKETS`` entries (lower-cased; what is no letter is one blank, and an
n-gram may begin or end with a blank but not cross it).  An entry is (1 + log
count) times its inverse document frequency, and vectors have length one.

Document frequencies are counted over all training documents.  Centroids come
from spherical k-means, one task for each language, on the ``SAMPLE`` documents
of smallest hash (whole texts): a documented bound of this classifier's
training.  Each centroid keeps a radius, the cosine that all but ``OUTLIERS`` of
its members reach.  A text gets the language of the centroid of greatest cosine
(ties: the language first in code-point order), that cosine as its score, and is
``rejected`` if it lies outside that centroid's radius.

Centroids are broadcast in blocks of ``MODEL_BYTES``; with more languages than a
block holds, texts meet the blocks one after another.

Edge cases: a null text, or one without a letter, is ``und`` with score 0 and
rejected, as all are where nothing could be learned; a null doc_id is not held
out and not learned from; null languages are not learned from; repeated rows are
answered each (one of equal rows is learned from); an empty table gives no rows;
other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quillstat.session import ship_package

from .shared import stash
from .textscan import column, slices

BUCKETS = 1 << 13
ORDER = 3
CENTROIDS = 4
ROUNDS = 12
#: bound on the documents of each language that the centroids are fitted on
SAMPLE = 1000
OUTLIERS = 0.005
MODEL_BYTES = 64 << 20
BROADCAST_BYTES = 8 << 20
#: code points of one scan; a longer text is scanned in pieces
PIECE = 1 << 18
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _grams(code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all n-grams of some code points (blanks are 32) and where they start."""
    letter = code != 32
    h = np.zeros(len(code), np.uint32)
    inner = np.ones(len(code), bool)  # no blank strictly inside
    for n in range(1, ORDER + 1):
        m = len(code) - n + 1
        if m <= 0:
            return
        h = h[:m] * np.uint32(0x9E3779B1) + code[n - 1:]
        if n > 2:
            inner = inner[:m] & letter[n - 2:-1]
        any_letter = letter[:m] | letter[n - 1:]
        at = np.flatnonzero(inner[:m] & any_letter)
        x = h[at] + np.uint32(n)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        yield x & np.uint32(BUCKETS - 1), at


def _code(text: str) -> np.ndarray:
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    return np.where(_is_letter()[code], code, np.uint32(32))


def _long_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(BUCKETS, np.int64)
    code = np.concatenate([[np.uint32(32)], _code(text), [np.uint32(32)]])
    for lo in range(0, len(code), PIECE):
        for bucket, at in _grams(code[lo:lo + PIECE + ORDER - 1]):
            total += np.bincount(bucket[at < PIECE], minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs, sorted, and their counts."""
    if len(texts) == 1 and len(texts[0]) > PIECE:
        found, n = _long_counts(texts[0])
        return np.zeros(len(found), np.int64), found, n
    lowered = [t.lower() for t in texts]
    code = _code(" " + " ".join(lowered) + " ")
    offset = np.cumsum(np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered)))
    row_of = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(np.concatenate([[0], offset])))
    parts = [row_of[np.minimum(at, len(row_of) - 1)] * BUCKETS + bucket for bucket, at in _grams(code)]
    key, n = np.unique(np.concatenate(parts), return_counts=True)
    return key // BUCKETS, key % BUCKETS, n


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (text, bucket, value) of the texts' vectors of length one."""
    row, bucket, n = counts(texts)
    value = (1 + np.log(n)) * idf[bucket]
    norm = np.sqrt(np.bincount(row, value * value, len(texts)))
    return row, bucket, value / np.maximum(norm[row], 1e-300)


def _texts(batch: pa.RecordBatch) -> Iterator[list[str]]:
    """A batch's texts (null: empty) in slices; a text longer than a piece is a slice of its own."""
    texts = [v or "" for v in column(batch, "text").to_pylist()]
    for lo, hi in slices(texts, PIECE):
        yield texts[lo:hi]


# --- training --------------------------------------------------------------

_PARTS = 16


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    total, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for texts in _texts(batch):
            total += np.bincount(counts(texts)[1], minlength=BUCKETS)
        n += batch.num_rows
    if n:
        parts = [x.tobytes() for x in total.reshape(_PARTS, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(_PARTS), pa.int32()), pa.array([TaskContext.get().partitionId() % 64] * _PARTS, pa.int32()),
                                          pa.array([n] * _PARTS, pa.int64()), pa.array(parts, pa.binary())], names=["part", "salt", "n", "counts"])


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b, np.int64) for b in table.column("counts").to_pylist())
    n = sum(table.column("n").to_pylist())
    return pa.table({"part": table.column("part")[:1], "salt": pa.array([0], pa.int32()), "n": pa.array([n], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})


def inverse_frequencies(training: DataFrame) -> np.ndarray:
    """log((1 + documents) / (1 + documents with the bucket)) + 1, over all rows of ``training``; sums are merged in two steps."""
    kind = "part int, salt int, n long, counts binary"
    rows = (training.select("text").mapInArrow(_document_counts, kind).groupBy("part", "salt").applyInArrow(_summed, kind)
            .groupBy("part").applyInArrow(_summed, kind).orderBy("part").collect())  # _PARTS rows of BUCKETS / _PARTS counts
    if not rows:
        return np.ones(BUCKETS)
    return np.log((1 + rows[0].n) / (1 + np.concatenate([np.frombuffer(r.counts, np.int64) for r in rows]))) + 1


def cluster(points: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit rows: centroids of length one, and each one's radius.

    Starts from the row nearest to the mean and then, again and again, the row farthest from those chosen.
    """
    def unit(x):
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    chosen = [int(np.argmax(points @ points.mean(0)))]
    near = points @ points[chosen[0]]
    while len(chosen) < min(k, len(points)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, points @ points[chosen[-1]])
    centres = points[chosen]
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, axis=1)
        sums = np.stack([points[own == c].sum(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = unit(sums)
    cosine = points @ centres.T
    own = np.argmax(cosine, axis=1)
    keep = [c for c in range(len(centres)) if (own == c).any()]
    return centres[keep].astype(np.float32), np.array([np.quantile(cosine[own == c, c], OUTLIERS, method="lower") for c in keep])


def _fitter(idf):
    def fit(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("h").to_numpy(), kind="stable")
        texts = [t or "" for t in table.column("text").take(pa.array(order)).to_pylist()]
        points = []
        for lo, hi in slices(texts, PIECE):
            dense = np.zeros((hi - lo, BUCKETS), np.float32)
            row, bucket, value = vectors(texts[lo:hi], idf.value)
            dense[row, bucket] = value
            points.append(dense[dense.any(1)])
        points = np.concatenate(points)
        centres, radius = cluster(points) if len(points) else (np.zeros((0, BUCKETS), np.float32), np.zeros(0))
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(centres), pa.string()), "centre": pa.array([c.tobytes() for c in centres], pa.binary()),
                         "radius": pa.array(radius, pa.float64())})
    return fit


def sample(training: DataFrame, size: int = SAMPLE) -> DataFrame:
    """lang, h, text of at most ``size`` different documents of each language, those of smallest hash."""
    hashed = training.select("lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    cut = (hashed.select("lang", "h").distinct().withColumn("rank", rank).where(F.col("rank") <= size)
           .groupBy("lang").agg(F.max("h").alias("cut")))
    cut = stash(cut, "language-cuts")
    if (cut.agg(F.sum(F.octet_length("lang") + 16)).first()[0] or 0) <= BROADCAST_BYTES:
        cut = F.broadcast(cut)  # of checked size; else texts are shuffled by language
    picked = hashed.join(cut, "lang").where("h <= cut")  # equal rows meet before the shuffle
    return picked.groupBy("lang", "h").agg(F.min("text").alias("text"))


class Model:
    """Inverse frequencies, and centroids in the shared folder: lang, centre, radius."""

    def __init__(self, idf: np.ndarray, table: DataFrame):
        self.idf, self.table = idf, table

    def blocks(self) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Centroids by language, at most MODEL_BYTES at once."""
        numbered = self.table.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang")
        room, langs = max(1, MODEL_BYTES // (4 * BUCKETS)), []
        held = 0
        for row in [*numbered.toLocalIterator(), None]:
            if langs and (row is None or held + row.n > room):
                rows = self.table.where(F.col("lang").between(langs[0], langs[-1])).collect()  # MODEL_BYTES
                rows.sort(key=lambda r: (r.lang.encode(), r.centre))
                yield [r.lang for r in rows], np.stack([np.frombuffer(r.centre, np.float32) for r in rows]), np.array([r.radius for r in rows])
                langs, held = [], 0
            if row is not None:
                langs.append(row.lang)
                held += row.n


def train(documents: DataFrame) -> Model:
    """Fit on all rows with a language."""
    spark = documents.sparkSession
    ship_package(spark)
    training = documents.where("lang is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    idf = inverse_frequencies(training)
    state = spark.sparkContext.broadcast(idf)
    table = sample(training).groupBy("lang").applyInArrow(_fitter(state), "lang string, centre binary, radius double")
    return Model(idf, stash(table, "language-centroids"))


# --- answers ---------------------------------------------------------------

def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and lang_pred, score, rejected."""
    spark = docs.sparkSession
    ship_package(spark)
    mine = ["lang_pred", "score", "rejected"]
    kept = [c for c in docs.columns if c not in mine]
    # a struct keeps the input's columns apart from those worked on
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("text"), F.lit(None).cast("string").alias("lang_pred"),
                       F.lit(-1.0).alias("score"), F.lit(True).alias("rejected"))
    idf = spark.sparkContext.broadcast(model.idf)
    for k, (names, centres, radius) in enumerate(model.blocks()):
        if k:
            rows = stash(rows, "language-so-far")
        rows = rows.mapInArrow(_scorer(idf, spark.sparkContext.broadcast((names, centres.T.astype(np.float64), radius))), rows.schema)
    none = F.col("lang_pred").isNull()
    return rows.select("row.*", F.when(none, UNKNOWN).otherwise(F.col("lang_pred")).alias("lang_pred"),
                       F.when(none, 0.0).otherwise(F.least(F.lit(1.0), F.col("score"))).alias("score"), "rejected")


def _scorer(idf, state):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, centres, radius = state.value
        for batch in batches:
            lang, best, out = column(batch, "lang_pred").to_pylist(), column(batch, "score").to_numpy(zero_copy_only=False).copy(), column(batch, "rejected").to_pylist()
            at = 0
            for texts in _texts(batch):
                row, bucket, value = vectors(texts, idf.value)
                start = np.flatnonzero(np.diff(row, prepend=-1))
                if len(start):
                    cosine = _sums(value, bucket, start, centres)
                    top = np.argmax(cosine, axis=1)
                    for r, c, v in zip(row[start].tolist(), top.tolist(), cosine[np.arange(len(top)), top].tolist()):
                        if v > best[at + r]:
                            best[at + r], lang[at + r], out[at + r] = v, names[c], bool(v < radius[c])
                at += len(texts)
            yield pa.RecordBatch.from_arrays([column(batch, "row"), column(batch, "text"), pa.array(lang, pa.string()), pa.array(best, pa.float64()), pa.array(out, pa.bool_())],
                                             names=["row", "text", "lang_pred", "score", "rejected"])
    return scored


def _sums(value: np.ndarray, bucket: np.ndarray, start: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Sum of value * centres[bucket] over each run of entries, a column of centres at a time."""
    return np.stack([np.add.reduceat(value * centres[:, c][bucket], start) for c in range(centres.shape[1])], axis=1)


def held_out(fold: int = 1, folds: int = 3) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document; learns only from rows that are not held out."""
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
