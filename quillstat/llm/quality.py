"""Quality classifier: supervised subword embeddings (operator 1).

A text's vector is the mean of the learned vectors of its words and of its
character 3- and 5-grams (both hashed into ``BUCKETS`` rows; an n-gram does not
cross a word bound, but may include the white space beside it, which marks word
starts and ends).  Of the longer word n-grams only those that end with the word
they began with are kept; each distance is one feature, whatever the word.  A softmax over two classes follows.  Training is plain numpy
SGD in tasks: the bounded sample of labelled rows is dealt into ``SHARDS``
shards, each task trains on its shard from the common weights, and the weights
(a few MB, whatever the input) are averaged after each round.

Edge cases: a null or empty text has no features and gets the bias alone; a row
with a null doc_id is scored and never held out; repeated rows are scored each;
an empty table gives no rows; labels that are null are not learned from; of
several labels for one doc_id the smallest counts; without labels of both
classes every text scores 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.session import ship_package

from .shared import stash
from .textscan import column, slices

BUCKETS = 1 << 16
DIM = 8
SHARDS = 4
ROUNDS = 4
RATE = 0.5
#: bound on the labelled rows of each class that training reads (whole texts)
SAMPLE_PER_CLASS = 3000
KEEP_AT = 0.3
ORDERS = (3, 5)
#: word n-grams that begin and end with the same word share one feature for each distance up to this
ECHOES = 4

_A = np.uint32(0x9E3779B1)
_WHITE = np.array([9, 10, 11, 12, 13, 32], np.uint32)


def _mix32(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint32(16))
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h & np.uint32(BUCKETS - 1)


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature buckets of some texts with the text each belongs to, one array per kind of feature."""
    joined = " " + " ".join(texts) + " "
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offset = np.concatenate([[1], 1 + np.cumsum(lengths + 1)])[:-1]
    white = (code == 32) | ((code >= 9) & (code <= 13))
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return
    row_of = np.zeros(len(code), np.int32)
    row_of[offset[1:]] = 1
    row_of = np.cumsum(row_of, dtype=np.int32) if len(texts) > 1 else row_of
    power = np.cumprod(np.concatenate([[np.uint32(1)], np.full(int((end - start).max()), _A, np.uint32)]))
    step = np.arange(len(code), dtype=np.int64)
    begin = np.repeat(start, np.append(np.diff(start), len(code) - start[-1]))
    inside = step[start[0]:] - begin
    value = np.where(white[start[0]:], np.uint32(0), (code[start[0]:] + np.uint32(7)) * power[np.minimum(inside, len(power) - 1)])
    word, row = np.add.reduceat(value, start - start[0], dtype=np.uint32) + np.uint32(1), row_of[start]
    yield _mix32(word), row
    for back in range(1, ECHOES + 1):
        same = np.flatnonzero((word[back:] == word[:-back]) & (row[back:] == row[:-back])) + back
        yield np.full(len(same), _mix32(np.full(1, back, np.uint32) * _A)[0]), row[same]
    for n in ORDERS:
        m = len(code) - n + 1
        if m <= 0:
            continue
        g = code[:m].copy()
        crosses = np.zeros(m, bool)
        for j in range(1, n):
            g = g * _A + code[j:j + m]
            if j < n - 1:
                crosses |= white[j:j + m]
        at = np.flatnonzero(~crosses)
        yield _mix32(g[at] * _A + np.uint32(n)), row_of[at + 1]


def _strings(col: pa.Array) -> list[str]:
    return [v or "" for v in col.to_pylist()]


def _str_slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    return slices(texts, 1 << 18)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training rows: distinct buckets and their share of the text's features."""
    for batch in batches:
        texts, out = _strings(column(batch, "text")), []
        for lo, hi in _str_slices(texts):
            parts = list(features(texts[lo:hi]))
            key = np.concatenate([r.astype(np.int64) * BUCKETS + b for b, r in parts]) if parts else np.zeros(0, np.int64)
            key, n = np.unique(key, return_counts=True)
            row, bounds = key // BUCKETS, np.searchsorted(key // BUCKETS, np.arange(hi - lo + 1))
            total = np.maximum(1, np.bincount(row, n, hi - lo))
            share = (n / total[row]).astype(np.float32)
            ids = (key % BUCKETS).astype(np.uint32)
            out += [(ids[a:b].tobytes(), share[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [column(batch, "shard"), column(batch, "y"), pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())],
            names=["shard", "y", "ids", "share"])


def _sgd(emb: np.ndarray, out: np.ndarray, rows: list[tuple[int, bytes, bytes]], rate: float, seed: int) -> None:
    """One pass of SGD over the rows, in place.  ``out`` has a last row of biases."""
    for i in np.random.default_rng(seed).permutation(len(rows)):
        y, ids, share = rows[i]
        ids, share = np.frombuffer(ids, np.uint32), np.frombuffer(share, np.float32)
        if not len(ids):
            continue
        hidden = share @ emb[ids]
        z = hidden @ out[:-1] + out[-1]
        p = np.exp(z - z.max())
        p /= p.sum()
        p[y] -= 1
        back = out[:-1] @ p
        out[:-1] -= rate * np.outer(hidden, p)
        out[-1] -= rate * p
        emb[ids] -= np.outer(share, rate * back) * np.float32(20)


def _fitter(state, rate: float, k: int):
    """Task of one shard: three passes of SGD from the common weights of round ``k``."""
    def fit(pdf):
        import pandas as pd
        emb, out = (x.copy() for x in state.value)
        rows = sorted(zip(pdf["y"].astype(int), pdf["ids"], pdf["share"]))
        for epoch in range(3):
            _sgd(emb, out, rows, rate, 31 * k + epoch)
        return pd.DataFrame({"n": [len(pdf)], "emb": [emb.astype(np.float32).tobytes()], "out": [out.astype(np.float32).tobytes()]})
    return fit


def train(docs: DataFrame, labels: DataFrame, label: str, sample_per_class: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, float]:
    """Fit on at most ``sample_per_class`` labelled rows of each class; gives each bucket's log-odds and the bias.

    ``labels`` has doc_id and the 0/1 column ``label``; the rows of smallest
    hash of doc_id are taken, so the sample does not depend on partitioning.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min(label).cast("int").alias("y")))
    pick = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class)
        pick = part if pick is None else pick.union(part)
    rows = (docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id")
            .withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(SHARDS)).cast("int")))
    rows = stash(rows.select("shard", "y", "text").mapInArrow(_counted, "shard int, y int, ids binary, share binary"), "quality-rows")
    if rows.select("y").distinct().count() < 2:
        return np.zeros(BUCKETS, np.float32), 0.0
    rng = np.random.default_rng(17)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM + 1, 2), np.float32)
    for k in range(ROUNDS):
        state = spark.sparkContext.broadcast((emb, out))
        rate = RATE * (1 - k / ROUNDS)

        fit = _fitter(state, rate, k)
        got = rows.groupBy("shard").applyInPandas(fit, "n long, emb binary, out binary").collect()  # SHARDS rows of 2 MB
        got.sort(key=lambda r: (r.n, bytes(r.out)))
        weight = np.array([r.n for r in got], np.float32) / sum(r.n for r in got)
        emb = sum(w * np.frombuffer(r.emb, np.float32).reshape(BUCKETS, DIM) for w, r in zip(weight, got))
        out = sum(w * np.frombuffer(r.out, np.float32).reshape(DIM + 1, 2) for w, r in zip(weight, got))
        state.unpersist()
    turn = out[:, 1] - out[:, 0]
    return (emb @ turn[:-1]).astype(np.float32), float(turn[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """All columns of ``docs`` and ``score``, the probability of class 1, from the whole ``text``."""
    odds, bias = model
    ship_package(docs.sparkSession)
    state = docs.sparkSession.sparkContext.broadcast(odds)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = state.value
        for batch in batches:
            texts, result = _strings(column(batch, "text")), []
            for lo, hi in _str_slices(texts):
                total, n = np.zeros(hi - lo), np.zeros(hi - lo)
                for bucket, row in features(texts[lo:hi]):
                    total += np.bincount(row, table[bucket], hi - lo)
                    n += np.bincount(row, minlength=hi - lo)
                result.append(1 / (1 + np.exp(-(total / np.maximum(n, 1) + bias))))
            value = np.concatenate(result) if result else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value, pa.float64())], names=[*batch.schema.names, "_score"])

    keep = docs.drop("score", "_score")
    return keep.mapInArrow(scored, T.StructType([*keep.schema.fields, T.StructField("_score", T.DoubleType())])).withColumnRenamed("_score", "score")


def held_out(fold: int, folds: int):
    """The contract's fold test: crc32 of the decimal doc_id, modulo ``folds``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; learns only from rows that are not held out."""
    model = train(docs, labels.where(~held_out(0, 5)), "quality", sample_per_class)
    return (score(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(0, 5).alias("held_out"), "score", (F.col("score") >= KEEP_AT).cast("int").alias("predicted")))


