"""Suffix-array dedup with a logarithmic index family (operator 5).

A byte goes if a ``WINDOW``-byte string that covers it also starts in a document
of smaller doc_id.

Sampled suffixes.  Of each window the leftmost of its ``MER``-byte substrings
with the smallest hash is its anchor (a minimiser); consecutive windows mostly
share one.  Equal windows have their anchors at the same offset, so only anchors
whose substring occurs in two documents can belong to repeats; fingerprints
dealt into shards tell which.  For these the span of the anchor's windows (at
most 75 bytes) goes to the shard of the anchor's fingerprint.

Index family.  A shard takes its spans in order of doc_id, ``BATCH`` at a time.
A new batch gets its suffix array (the spans, each a suffix cut at the span's
end, in lexicographic order), which is merge-scanned against the suffix arrays
of the existing levels: a span found there is a repeat as a whole.  What is new
is scanned window by window against a second family, of window fingerprints.
Then the batch becomes a level, and levels of about equal size are merged, so
that there are never more than a logarithm of the batches.

A window is judged by the smallest document that has it; no pairs are formed.
A bucket sends each distinct span once, with its smallest document, and gets the
repeated windows of that document's span back; the span's other documents in the
bucket are later, so there the span is a repeat as a whole.  A passage of any
frequency thus costs a shard one entry per bucket.  Spans of a bucket are told
apart by 64-bit fingerprints.

Edge cases: a null or empty text has no bytes; a text under WINDOW bytes loses
nothing; a run of one byte makes every position an anchor, which costs space but
no results; rows of null doc_id are not returned; of repeated rows of one doc_id
the smallest text stands; an empty table gives no rows.  Texts of any length are
cut into pieces that overlap by WINDOW - 1 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .exchange import ANSWER, LOW, OFFER, Buckets, by_shard, common, first_of, found_keys, member, offer, pack_planes, shard_slices, texts_of, unpack_planes
from .textscan import U, mix, powers, slices

WINDOW = 50
MER = 25
PER_WINDOW = WINDOW - MER + 1
SPAN = WINDOW + PER_WINDOW - 1
BATCH = 1 << 15
PIECE = 1 << 19
_AT = U((1 << 20) - 1)
_CODE = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)

SPANS = "shard int, bucket int, spans binary, windows binary, docs binary, keys binary"
REPEATS = "bucket int, keys binary, masks binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _sums(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(buf))
    return np.concatenate([[U(0)], np.cumsum(_CODE[buf] * up)]), down


def pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in portions of bounded bytes, as (row, offset in the text, bytes); long texts in overlapping pieces."""
    rows, offs, parts = [], [], []
    for r, t in enumerate(texts):
        for o in range(0, max(1, len(t) - WINDOW + 1), PIECE):
            rows.append(r)
            offs.append(o)
            parts.append(t[o:o + PIECE + WINDOW - 1])
    for lo, hi in slices(parts, PIECE):
        yield rows[lo:hi], offs[lo:hi], parts[lo:hi]


def anchors(parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """buf, piece offsets in it, and per run of windows with one anchor: fingerprint, first window, windows."""
    buf = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    offset = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    none = np.zeros(0, np.int64)
    if len(buf) < WINDOW:
        return buf, offset, none.astype(np.uint64), none, none
    total, down = _sums(buf)
    m = len(buf) - MER + 1
    h = mix((total[MER:MER + m] - total[:m]) * down[:m])
    low = (h & ~_AT) | np.arange(m, dtype=np.uint64)
    width = 1
    while width * 2 <= PER_WINDOW:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = PER_WINDOW - width
    low = np.minimum(low[:len(low) - rest], low[rest:])
    inside = np.zeros(len(low) + 1, np.int32)
    full = lengths >= WINDOW
    inside[offset[full]] += 1
    inside[(offset + lengths - WINDOW + 1)[full]] -= 1
    start = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    at = (low[start] & _AT).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])) if len(at) else none
    count = np.diff(np.append(first, len(at)))
    return buf, offset, mix(h[at[first]] * U(0xE7037ED1A0B428DB) + U(1)), start[first], count


def _sampled(bits: int):
    mask = U((1 << (LOW + bits)) - 1)

    def sample(table: pa.Table) -> pa.Table:
        _, texts = texts_of(table)
        fps, doc = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for rows, _, parts in pieces(texts):
            _, offset, f, start, _ = anchors(parts)
            fps.append(f & mask)
            doc.append(np.array(rows, np.int32)[np.searchsorted(offset, start, "right") - 1])
        return offer(table.column("bucket")[0].as_py(), np.concatenate(fps), np.concatenate(doc), None)
    return sample


def gather(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of many slices, one after another."""
    step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    return buf[np.repeat(start, length) + step]


def span_keys(buf: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the spans of ``count`` windows from ``start``, which tell lengths apart."""
    if not len(start):
        return np.zeros(0, np.uint64)
    total, down = _sums(buf)
    return mix(mix((total[start + count + WINDOW - 1] - total[start]) * down[start]) + count.astype(np.uint64))


def _spans(bits: int):
    mask = U((1 << (LOW + bits)) - 1)

    def spans(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows, keys = [], found_keys(answers)
        if len(keys) and table.num_rows:
            ids, texts = texts_of(table)
            bucket = table.column("bucket")[0].as_py()
            sent = np.zeros(0, np.uint64)
            for at_row, _, parts in pieces(texts):  # in order of doc_id: the first of equal spans is the smallest document's
                buf, offset, f, start, count = anchors(parts)
                f = f & mask
                hit = member(f, keys)
                f, start, count = f[hit], start[hit], count[hit]
                key = span_keys(buf, start, count)
                key, new = np.unique(key, return_index=True)
                fresh = ~member(key, sent)
                key, new = key[fresh], new[fresh]
                sent = np.sort(np.concatenate([sent, key]))
                f, start, count = f[new], start[new], count[new]
                order = np.argsort(f, kind="stable")
                f, start, count, key = f[order], start[order], count[order], key[order]
                piece = np.searchsorted(offset, start, "right") - 1
                doc = ids[np.array(at_row)[piece]] if len(piece) else np.zeros(0, np.int64)
                for shard, at in shard_slices((f >> U(LOW)).astype(np.int64)):
                    rows.append((shard, bucket, gather(buf, start[at], count[at] + WINDOW - 1).tobytes(), count[at].astype(np.uint8).tobytes(),
                                 pack_planes(doc[at]), key[at].tobytes()))
        return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(zip(
            ("shard", "bucket", "spans", "windows", "docs", "keys"), (pa.int32(),) * 2 + (pa.binary(),) * 4))})
    return spans


class LogFamily:
    """Levels of sorted keys, each with the smallest document that has it (Bentley & Saxe, 1980)."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def array(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys and their smallest documents."""
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        first = first_of(keys)
        return keys[first], np.minimum.reduceat(docs, first) if len(first) else docs

    def scan(self, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The smallest document of each of the sorted keys, here or in a level."""
        best = docs.copy()
        for have, low in self.levels:
            at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
            same = have[at] == keys
            best[same] = np.minimum(best[same], low[at[same]])
        return best

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None:
        if not len(keys):
            return
        self.levels.append((keys, docs))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (k2, d2), (k1, d1) = self.levels.pop(), self.levels.pop()
            self.levels.append(self.array(np.concatenate([k1, k2]), np.concatenate([d1, d2])))

    def judge(self, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Which keys a smaller document has, in the levels or in this batch; the batch then joins the family."""
        own, low = self.array(keys, docs)
        best = self.scan(own, low)
        late = best[np.searchsorted(own, keys)] < docs
        self.add(own, low)
        return late


def repeated_windows(spans: np.ndarray, count: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each span (its bytes follow one another in ``spans``) a bit mask of its windows that a smaller document has."""
    length = count + WINDOW - 1
    begin = np.cumsum(length) - length
    masks = np.zeros(len(count), np.int64)
    suffixes, windows = LogFamily(), LogFamily()
    order = np.argsort(docs, kind="stable")
    for lo in range(0, len(order), BATCH):
        b = order[lo:lo + BATCH]
        text = np.zeros((len(b), SPAN + 1), np.uint8)
        step = np.arange(int(length[b].sum())) - np.repeat(np.cumsum(length[b]) - length[b], length[b])
        text[np.repeat(np.arange(len(b)), length[b]), step] = spans[np.repeat(begin[b], length[b]) + step]
        text[:, SPAN] = count[b]  # never 0: ends are told apart
        late = suffixes.judge(text.reshape(-1).view(f"S{SPAN + 1}"), docs[b])
        masks[b[late]] = (1 << count[b[late]].astype(np.int64)) - 1
        new = b[~late]
        n = count[new]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        total, down = _sums(gather(spans, begin[new], length[new]))
        at = np.repeat(np.cumsum(length[new]) - length[new], n) + step
        fp = mix((total[at + WINDOW] - total[at]) * down[at])
        seen = windows.judge(fp, np.repeat(docs[new], n))
        np.bitwise_or.at(masks, np.repeat(new, n)[seen], np.int64(1) << step[seen])
    return masks


def _judged(table: pa.Table) -> pa.Table:
    """Shard task: to each bucket its repeated windows."""
    count = [np.frombuffer(b, np.uint8) for b in table.column("windows").to_pylist()]
    row = np.repeat(np.arange(len(count)), [len(c) for c in count])
    spans = np.concatenate([np.frombuffer(b, np.uint8) for b in table.column("spans").to_pylist()])
    docs = np.concatenate([unpack_planes(b) for b in table.column("docs").to_pylist()])
    keys = np.concatenate([np.frombuffer(b, np.uint64) for b in table.column("keys").to_pylist()])
    masks = repeated_windows(spans, np.concatenate(count).astype(np.int64), docs)
    keep = masks != 0
    row, keys, masks = row[keep], keys[keep], masks[keep]
    bucket = table.column("bucket").to_numpy()[row]
    order = np.argsort(bucket, kind="stable")
    out = [(b, keys[order][at].tobytes(), pack_planes(masks[order][at])) for b, at in shard_slices(bucket[order])]
    return pa.table({c: pa.array([x[i] for x in out], t) for i, (c, t) in enumerate(
        (("bucket", pa.int32()), ("keys", pa.binary()), ("masks", pa.binary())))})


def _all_spans(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of all spans of a bucket, in order of row: key, row, start in the text, windows."""
    out = [(np.zeros(0, np.uint64), *(np.zeros(0, t) for t in (np.int32, np.int64, np.uint8)))]
    for rows, offs, parts in pieces(texts):
        buf, offset, _, start, count = anchors(parts)
        piece = np.searchsorted(offset, start, "right") - 1
        out.append((span_keys(buf, start, count), np.array(rows, np.int32)[piece], start - offset[piece] + np.array(offs, np.int64)[piece], count.astype(np.uint8)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _removed(table: pa.Table, answers: pa.Table) -> pa.Table:
    out = []
    if table.num_rows:
        ids, texts = texts_of(table)
        key, row, starts, count = _all_spans(texts)
        order = np.argsort(key, kind="stable")  # of equal spans the smallest document first
        first = first_of(key[order])
        low = np.empty_like(row)
        low[order] = np.repeat(row[order][first], np.diff(np.append(first, len(key))))
        masks = np.where(row > low, (np.int64(1) << count.astype(np.int64)) - 1, 0)  # a smaller document of this bucket has the whole span
        if answers.num_rows:
            have = np.concatenate([np.frombuffer(b, np.uint64) for b in answers.column("keys").to_pylist()])
            found = np.concatenate([unpack_planes(b) for b in answers.column("masks").to_pylist()])
            order = np.argsort(have)
            have, found = have[order], found[order]
            hit = member(key, have)
            masks[hit] |= found[np.searchsorted(have, key[hit])]
        late = masks != 0
        row, starts, masks = row[late], starts[late], masks[late]
        bound = np.searchsorted(row, np.arange(len(texts) + 1))
        for r, text in enumerate(texts):
            a, b = bound[r], bound[r + 1]
            if a == b:
                out.append((int(ids[r]), len(text), 0, 0, hashlib.sha256(text).hexdigest()))
                continue
            bit = (masks[a:b, None] >> np.arange(PER_WINDOW)) & 1
            k, j = np.nonzero(bit)
            at = starts[a:b][k] + j
            cover = np.zeros(len(text) + 1, np.int32)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + WINDOW, -1)
            gone = np.cumsum(cover[:-1]) > 0
            runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            out.append((int(ids[r]), len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return pa.table({c: pa.array([x[i] for x in out], t) for i, (c, t) in enumerate(
        (("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())))})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the hash of the bytes kept, per document."""
    b = Buckets(docs)
    found = by_shard(b.by_bucket(_sampled(b.bits), OFFER), common(need_mark=False), ANSWER)
    spans = b.with_answers(found, _spans(b.bits), SPANS)
    return b.with_answers(by_shard(spans, _judged, REPEATS), _removed, RESULT)
