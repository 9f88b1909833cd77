"""Documents in buckets, and fingerprints dealt into shards: what both repeat finders share.

Documents are written once to the shared folder as a table bucketed by a hash of
doc_id.  Later passes over a bucket (``by_bucket``, ``with_answers``) read that
table without another shuffle of texts.  A pass sends packed fingerprints to
shards, a shard compares the buckets' fingerprints, and its answers go back to
the buckets.  A bucket sends each distinct fingerprint once, so a passage that
stands in a third of all documents costs a shard one entry per bucket.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.session import ship_package

from .shared import input_bytes, one_text, shared_path

#: aims for the compressed size of a bucket and for the raw texts whose fingerprints meet in a shard
BUCKET_BYTES = 3 << 20
SHARD_BYTES = 4 << 20
LOW = 40
UNKNOWN = 1 << 58
MOST_FILES = 100_000  # Spark's own bound on the buckets of a table


class Buckets:
    """The documents (one text per doc_id) in buckets; ``bits`` is the logarithm of the number of shards."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        ship_package(spark)
        size = input_bytes(docs)
        docs = one_text(docs)
        if size > UNKNOWN:  # not files: texts are counted, and compress to about a half
            size = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2
        files = min(MOST_FILES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (4 * BUCKET_BYTES))))
        n = max(4 * files, math.ceil(size / BUCKET_BYTES))
        self.bits = min(24, max(4, math.ceil(math.log2(max(1, size / SHARD_BYTES)))))
        name = f"quillstat_buckets_{uuid.uuid4().hex}"
        (docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("bucket"), "doc_id", "text")
         .write.bucketBy(files, "bucket").option("path", shared_path(spark, "buckets")).option("compression", "zstd").saveAsTable(name))
        self.table = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # the files stay and are read as bucketed; only the catalogue's entry goes

    def by_bucket(self, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
        return self.table.groupBy("bucket").applyInArrow(fn, schema)

    def with_answers(self, answers: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        return self.table.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(fn, schema)


def by_shard(df: DataFrame, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return df.groupBy("shard").applyInArrow(fn, schema)


def texts_of(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """doc_ids and texts of a bucket, in order of doc_id."""
    ids = table.column("doc_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    texts = table.column("text").cast(pa.large_binary()).to_pylist()
    return ids[order], [texts[i] or b"" for i in order.tolist()]


def pack(values: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of 64-bit values."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unpack(blob: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(blob) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(blob, np.uint8).reshape(-1, size)
    return out.reshape(-1).view(np.uint64)


def pack_planes(values: np.ndarray) -> bytes:
    """64-bit values byte plane by byte plane: equal high bytes then cost the shuffle's compression nothing."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64)


def shard_slices(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of a sorted shard column."""
    if len(shard):
        cut = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]])
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            yield int(shard[a]), slice(a, b)


def first_of(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal sorted keys begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def member(values: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values


OFFER = "shard int, bucket int, plain binary, marked binary, several binary, both binary"
_KINDS = ("plain", "marked", "several", "both")


def offer(bucket: int, fps: np.ndarray, doc: np.ndarray, mark: np.ndarray | None) -> pa.Table:
    """Rows for the shards: the bucket's distinct fingerprints (LOW + bits wide), in four kinds.

    marked: some occurrence has its mark; several: occurs in more than one document of the bucket.
    """
    order = np.lexsort((doc, fps))
    fps, doc = fps[order], doc[order]
    first = first_of(fps)
    last = np.append(first[1:], len(fps)) - 1
    several = doc[first] != doc[last] if len(fps) else np.zeros(0, bool)
    marked = np.logical_or.reduceat(mark[order], first) if mark is not None and len(fps) else np.zeros(len(first), bool)
    key, kind = fps[first], marked.astype(np.int8) + 2 * several
    rows = []
    for shard, at in shard_slices((key >> np.uint64(LOW)).astype(np.int64)):
        rows.append((shard, bucket, *(pack(key[at][kind[at] == k], LOW // 8) for k in range(4))))
    return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(zip(("shard", "bucket", *_KINDS), (pa.int32(),) * 2 + (pa.binary(),) * 4))})


ANSWER = "bucket int, shard int, found binary"


def common(need_mark: bool) -> Callable[[pa.Table], pa.Table]:
    """Shard task: to each bucket those of its fingerprints that occur in two documents anywhere (and are marked anywhere)."""
    def answer(table: pa.Table) -> pa.Table:
        parts, kinds, rows = [], [], []
        for k, name in enumerate(_KINDS):
            for r, blob in enumerate(table.column(name).to_pylist()):
                if blob:
                    parts.append(unpack(blob, LOW // 8))
                    kinds.append(np.full(len(parts[-1]), k, np.int8))
                    rows.append(np.full(len(parts[-1]), r, np.int32))
        bucket, shard = table.column("bucket").to_numpy(), table.column("shard")[0].as_py()
        out = []
        if parts:
            key, kind, row = np.concatenate(parts), np.concatenate(kinds), np.concatenate(rows)
            order = np.argsort(key, kind="stable")
            key, kind, row = key[order], kind[order], row[order]
            first = first_of(key)
            n = np.diff(np.append(first, len(key)))
            good = (n > 1) | (np.maximum.reduceat(kind, first) >= 2)
            if need_mark:
                good &= np.bitwise_or.reduceat(kind & 1, first) == 1
            keep = np.repeat(good, n)
            key, row = key[keep], row[keep]
            order = np.argsort(row, kind="stable")
            for r, at in shard_slices(row[order]):
                out.append((int(bucket[r]), shard, pack(key[order][at], LOW // 8)))
        return pa.table({"bucket": pa.array([x[0] for x in out], pa.int32()), "shard": pa.array([x[1] for x in out], pa.int32()),
                         "found": pa.array([x[2] for x in out], pa.binary())})
    return answer


def found_keys(answers: pa.Table) -> np.ndarray:
    """All fingerprints that the shards found for a bucket, sorted."""
    parts = [unpack(b, LOW // 8) | np.uint64(s << LOW) for s, b in zip(answers.column("shard").to_pylist(), answers.column("found").to_pylist())]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
