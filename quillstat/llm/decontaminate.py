"""Benchmark decontamination: size-partitioned MinHash containment search (operator 4).

Which documents hold at least ``THRESHOLD`` of the distinct five-word shingles of
a benchmark item?  Words are lower-cased runs of letters and digits (any other
ASCII character separates; other characters are word material).  An item of one
to four words has one shingle, its whole word sequence, which is looked for
among the documents' runs of as many words.

Items are partitioned by size: by the length of their shingles (five words, or
all of a shorter item) and by the number n of their shingles.  An item's sketch
is its MinHash bottom-k sketch, the k shingles of smallest hash, where the size
sets k = n - ceil(THRESHOLD n) + 1: a document with the wanted containment lacks
fewer than k shingles, so it holds at least one of the sketch, and the search
misses nothing, however long the document (a Jaccard estimate of a short item
against a long document would be near zero).  A document is only looked up in
the partitions of items that are small enough for it.  Candidates are verified
by exact containment of the shingle words, not of their hashes.

Items are broadcast in blocks of at most ``BLOCK_BYTES`` of text, each block
against all documents; a larger benchmark takes more scans, not more memory.
The documents are not shuffled.

Edge cases: a null or empty text, or one without words, holds and is nothing;
items with null item_id are skipped; of repeated item_id the smallest text
stands; each row of a repeated document is answered; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.session import ship_package

from .shared import numbered
from .textscan import Words, as_bytes, column, slices

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_BYTES = 8 << 20

#: ASCII: letters lower-cased, digits kept, all else a space
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def normal(text: bytes) -> bytes:
    """Lower-cased text with spaces for separators."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(_FOLD)


def _shingle_words(w: Words, row: int, length: int) -> set[tuple[bytes, ...]]:
    words = [w.word(i) for i in range(w.first[row], w.first[row + 1])]
    return {tuple(words[i:i + length]) for i in range(len(words) - length + 1)}


class SizePartition:
    """Sketches of the items with shingles of one length: sorted sketch hashes with the items that each stands for."""

    def __init__(self, sketches: list[tuple[int, np.ndarray]]):
        key = np.concatenate([k for _, k in sketches])
        owner = np.repeat([i for i, _ in sketches], [len(k) for _, k in sketches])
        order = np.argsort(key, kind="stable")
        self.key, self.owner = key[order], owner[order]
        #: a bit for each value of 20 bits of a sketch hash: most shingles stop here
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.key & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def candidates(self, g: np.ndarray, row: np.ndarray, size: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Distinct (row, item) that share a sketch hash, where the row has enough shingles for the item."""
        maybe = np.flatnonzero(self.seen[(g & np.uint64(0xFFFFF)).astype(np.int64)])
        g, row = g[maybe], row[maybe]
        lo, hi = np.searchsorted(self.key, g, "left"), np.searchsorted(self.key, g, "right")
        n = hi - lo
        found = np.repeat(np.arange(len(g)), n)
        item = self.owner[np.repeat(lo, n) + np.arange(len(found)) - np.repeat(np.cumsum(n) - n, n)]
        row = row[found]
        fits = size[row] >= need[item]
        return np.unique(np.stack([row[fits], item[fits]], 1), axis=0) if fits.any() else np.zeros((0, 2), np.int64)


class ItemBlock:
    """A block of items in size partitions."""

    def __init__(self, ids: list[int], texts: list[bytes], threshold: float):
        w = Words([normal(t) for t in texts])
        self.ids, sketches = ids, {}
        self.length = np.minimum(w.count, SHINGLE)
        self.words = [_shingle_words(w, r, int(n)) if n else set() for r, n in enumerate(self.length)]
        self.need = np.ceil(np.array([threshold * len(s) for s in self.words]) - 1e-9)
        for length in np.unique(self.length[self.length > 0]).tolist():
            g, at = w.grams(length)
            row = w.row[at]
            for r in np.flatnonzero(self.length == length).tolist():
                own = np.unique(g[np.searchsorted(row, r):np.searchsorted(row, r + 1)])  # sorted: its head is the bottom-k sketch
                sketches.setdefault(length, []).append((r, own[:max(1, len(own) - int(self.need[r]) + 1)]))
        self.parts = {length: SizePartition(x) for length, x in sketches.items()}

    def hits(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, shingles, shared) of the verified pairs."""
        w = Words([normal(t) for t in texts])
        for length, part in self.parts.items():
            g, at = w.grams(length)
            row = w.row[at]
            last, own = -1, set()
            for r, i in part.candidates(g, row, np.bincount(row, minlength=len(texts)), self.need):
                if r != last:
                    last, own = r, _shingle_words(w, r, length)
                shared = len(self.words[i] & own)
                if shared >= self.need[i]:
                    yield int(r), int(i), len(self.words[i]), shared


def _item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """The items in order of item_id, read in blocks of bounded bytes."""
    block, size = [], 0
    clean = items.where("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    for r in clean.orderBy("item_id").toLocalIterator():
        b = r.text.encode()
        if block and size + len(b) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r.item_id, b))
        size += len(b)
    if block:
        yield block


SCHEMA = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared, containment for each pair that reaches the threshold."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select("doc_id", "text")
    out = spark.createDataFrame([], SCHEMA)
    for block in _item_blocks(items, block_bytes):
        state = spark.sparkContext.broadcast(block)
        out = out.union(docs.mapInArrow(_searcher(state, threshold), SCHEMA))
    return out


def _searcher(state, threshold: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = ItemBlock([i for i, _ in state.value], [t for _, t in state.value], threshold)
        for batch in batches:
            ids, texts, out = column(batch, "doc_id"), as_bytes(column(batch, "text")), []
            for lo, hi in slices(texts):
                out += [(ids[lo + r].as_py(), block.ids[i], n, k, k / n) for r, i, n, k in block.hits(texts[lo:hi])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(),) * 4 + (pa.float64(),))],
                names=["doc_id", "item_id", "n_shingles", "n_shared", "containment"])
    return search


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no benchmark item; each row is judged by its own text, whatever its doc_id."""
    rows = numbered(docs)
    found = contaminated(rows.select("doc_id", "row.text"), items, threshold).select("doc_id").distinct()
    return rows.join(found, "doc_id", "left_anti").select("row.*")
