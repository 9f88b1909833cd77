"""Substring dedup by fixed-block anchors (operator 8).

A word goes if a window of ``WINDOW`` consecutive words that covers it also
starts in a document of smaller doc_id.

1. Index and probe.  Each document's non-overlapping blocks of ``BLOCK`` words are
   the index; every rolling ``BLOCK``-word window of every document probes it.
   As WINDOW = 2 BLOCK - 1, each window of WINDOW words holds one whole block of
   its own document, so a repeated window is always found by a probe, whichever
   of the two documents is the reference.
2. Extension.  The WINDOW-word windows around the hits are compared, by 64-bit
   fingerprints within a shard (chosen by other bits); each bucket learns which
   of its windows stand in a smaller document elsewhere.  The union of
   the repeated windows of a document are its maximal exact repeats.
3. The words covered are removed.

A window is compared with the smallest document that has it, never with all of a
group, so a passage of any frequency costs each bucket one entry.

Edge cases: a null or empty text has no words, and the hash of no bytes; a text
of fewer than WINDOW words loses nothing; rows of null doc_id are not returned;
of repeated rows of one doc_id the smallest text stands; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .exchange import ANSWER, LOW, OFFER, Buckets, by_shard, common, first_of, found_keys, member, offer, pack_planes, shard_slices, texts_of, unpack_planes
from .textscan import U, Words, slices

BLOCK = 7
WINDOW = 2 * BLOCK - 1
_WINDOW_BASE = 0xA0761D6478BD642F

WINDOWS = "shard int, bucket int, fps binary, docs binary"
ELSEWHERE = "bucket int, fps binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _probe(bits: int):
    mask = U((1 << (LOW + bits)) - 1)

    def probe(table: pa.Table) -> pa.Table:
        ids, texts = texts_of(table)
        fps, doc, mark = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, bool)]
        for lo, hi in slices(texts):
            w = Words(texts[lo:hi])
            g, at = w.grams(BLOCK)
            fps.append(g & mask)
            doc.append((w.row[at] + lo).astype(np.int32))
            mark.append((at - w.first[w.row[at]]) % BLOCK == 0)
        return offer(table.column("bucket")[0].as_py(), np.concatenate(fps), np.concatenate(doc), np.concatenate(mark))
    return probe


def _around_hits(bits: int):
    mask = U((1 << (LOW + bits)) - 1)

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        keys = found_keys(answers)
        if len(keys) and table.num_rows:
            ids, texts = texts_of(table)
            fps, doc = [], []
            for lo, hi in slices(texts):
                w = Words(texts[lo:hi])
                g, at = w.grams(BLOCK)
                hits = np.zeros(len(w.hash) + 1, np.int32)
                hits[at[member(g & mask, keys)] + 1] = 1
                hits = np.cumsum(hits)
                f, start = w.grams(WINDOW, _WINDOW_BASE)
                near = hits[start + BLOCK] > hits[start]
                fps.append(f[near])
                doc.append(ids[lo + w.row[start[near]]])
            fps, doc = np.concatenate(fps), np.concatenate(doc)
            order = np.lexsort((doc, fps))
            fps, doc = fps[order], doc[order]
            first = first_of(fps)
            fps, doc = fps[first], doc[first]
            bucket = table.column("bucket")[0].as_py()
            for shard, at in shard_slices((fps >> U(64 - bits)).astype(np.int64)):
                rows.append((shard, bucket, fps[at].tobytes(), pack_planes(doc[at])))
        return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(
            (("shard", pa.int32()), ("bucket", pa.int32()), ("fps", pa.binary()), ("docs", pa.binary())))})
    return extend


def _elsewhere(table: pa.Table) -> pa.Table:
    """Shard task: to each bucket its windows that a smaller document of another bucket has."""
    fps = [np.frombuffer(b, np.uint64) for b in table.column("fps").to_pylist()]
    row = np.repeat(np.arange(len(fps)), [len(f) for f in fps])
    fps = np.concatenate(fps)
    doc = np.concatenate([unpack_planes(b) for b in table.column("docs").to_pylist()])
    order = np.argsort(fps, kind="stable")
    fps, doc, row = fps[order], doc[order], row[order]
    first = first_of(fps)
    low = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(fps))))
    late = doc > low
    fps, row = fps[late], row[late]
    order = np.argsort(row, kind="stable")
    bucket = table.column("bucket").to_numpy()
    out = [(int(bucket[r]), fps[order][at].tobytes()) for r, at in shard_slices(row[order])]
    return pa.table({"bucket": pa.array([x[0] for x in out], pa.int32()), "fps": pa.array([x[1] for x in out], pa.binary())})


def _removed(table: pa.Table, answers: pa.Table) -> pa.Table:
    out = []
    if table.num_rows:
        keys = [np.frombuffer(b, np.uint64) for b in answers.column("fps").to_pylist()]
        keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
        ids, texts = texts_of(table)
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for lo, hi in slices(texts):
            w = Words(texts[lo:hi])
            f, start = w.grams(WINDOW, _WINDOW_BASE)
            parts.append((f, ids[lo + w.row[start]]))
        fps, doc = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((doc, fps))
        sorted_doc = doc[order]
        first = first_of(fps[order])
        late = np.zeros(len(fps), bool)  # a smaller document of this bucket has it
        if len(fps):
            late[order] = sorted_doc > np.repeat(sorted_doc[first], np.diff(np.append(first, len(fps))))
        late |= member(fps, keys)
        done = 0
        for lo, hi in slices(texts):
            w = Words(texts[lo:hi])
            _, start = w.grams(WINDOW, _WINDOW_BASE)
            gone = start[late[done:done + len(start)]]
            done += len(start)
            cover = np.zeros(len(w.hash) + 1, np.int32)
            np.add.at(cover, gone, 1)
            np.add.at(cover, gone + WINDOW, -1)
            keep = np.cumsum(cover[:-1]) == 0
            for r in range(hi - lo):
                a, b = w.first[r], w.first[r + 1]
                words = texts[lo + r].split()
                left = int(keep[a:b].sum())
                kept = words if left == len(words) else compress(words, keep[a:b])
                out.append((int(ids[lo + r]), len(words), len(words) - left, hashlib.sha256(b" ".join(kept)).hexdigest()))
    return pa.table({c: pa.array([x[i] for x in out], t) for i, (c, t) in enumerate(
        (("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())))})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the words kept, per document."""
    b = Buckets(docs)
    hits = by_shard(b.by_bucket(_probe(b.bits), OFFER), common(need_mark=True), ANSWER)
    windows = b.with_answers(hits, _around_hits(b.bits), WINDOWS)
    return b.with_answers(by_shard(windows, _elsewhere, ELSEWHERE), _removed, RESULT)
