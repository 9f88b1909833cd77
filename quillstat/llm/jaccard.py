"""N-gram Jaccard join with Bayesian candidate pruning (operator 6).

Sets are the distinct five-word shingles of a text (a text of one to four words
has its whole word sequence as its only shingle); two texts link when the
Jaccard similarity of their sets is at least ``THRESHOLD``.

1. Texts of equal shingle sets are one representative (smallest doc_id) with a count.
2. Representatives that agree in one of ``BANDS`` bands of ``ROWS`` MinHash values are candidates.
3. Candidates are compared value by value, ``STEP`` values at a time (Satuluri &
   Parthasarathy, BayesLSH, 2012): a pair goes as soon as the posterior
   probability that its similarity reaches the threshold is below ``TOLERANCE``.
   Values are compared by their lowest byte; the posterior allows for chance agreement.
4. Survivors form clusters, and inside a cluster all pairs of representatives are
   compared exactly, by shingle sets.

Large buckets and clusters are split into pairs of blocks, so no task holds a
group; pairs are never given out as rows, only link counts and the edges of
spanning forests (at most one row per member and block pair).  Buckets and
clusters have no cap.  The expected share of lost links at exactly the threshold
is (1 - 0.8**4)**32 = 5e-8 from bands and about ``TOLERANCE`` per step from pruning.

Edge cases: a null or empty text has no shingle, links with nothing and is its
own class; rows with a null doc_id take no part (and are not returned); of
repeated rows of one doc_id the smallest text stands; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.session import ship_package

from .shared import components, in_blocks, numbered, one_text, stash
from .textscan import Words, as_bytes, column, mix, shingle_sets, slices

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-6
BLOCK = 256

_rng = np.random.default_rng(5)
_MUL = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def min_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """For n = STEP, 2 STEP, ...: the fewest agreeing values at which a pair is kept.

    Posterior of the similarity s under a uniform prior, an agreement having the
    probability s + (1 - s) / 256.
    """
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        need = n + 1
        for m in range(n, -1, -1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            w = np.exp(log - log.max())
            if w[s >= threshold].sum() / w.sum() < tolerance:
                break
            need = m
        out.append(need)
    return np.array(out)


def signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values, one row of HASHES per non-empty set (empty sets give the largest value)."""
    n = len(bounds) - 1
    out = np.full((n, HASHES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        x = (sets >> np.uint64(32)).astype(np.uint32)
        for k in range(HASHES):
            v = x * _MUL[k] + _ADD[k]
            v ^= v >> np.uint32(15)
            out[full, k] = np.minimum.reduceat(v * np.uint32(0x2C1B3C6D), bounds[full])
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = column(batch, "doc_id"), as_bytes(column(batch, "text"))
        for lo, hi in slices(texts):
            g, bounds = shingle_sets(Words(texts[lo:hi]), SHINGLE)
            n = np.diff(bounds)
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix(g))])
            d1 = total[bounds[1:]] - total[bounds[:-1]]
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix(g ^ np.uint64(0x5851F42D4C957F2D)))])
            d2 = total[bounds[1:]] - total[bounds[:-1]]
            sig = signatures(g, bounds)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 pa.array([r.tobytes() for r in band_keys(sig)], pa.binary()),
                 pa.array([r.tobytes() for r in sig.astype(np.uint8)], pa.binary())], names=["doc_id", "n", "d1", "d2", "keys", "low"])


def band_keys(sig: np.ndarray) -> np.ndarray:
    key = np.zeros((len(sig), BANDS), np.uint64)
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS] + np.uint64(1))
    return mix(key + np.arange(BANDS, dtype=np.uint64)[None, :])


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = np.frombuffer(b"".join(column(batch, "keys").to_pylist()), np.int64)
        rep = column(batch, "rep").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(rep, BANDS))], names=["bucket", "rep"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the pairs: (smallest node, other node)."""
    node, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = inverse[:len(a)], inverse[len(a):]
    low = np.arange(len(node))
    while True:
        new = low.copy()
        np.minimum.at(new, ia, low[ib])
        np.minimum.at(new, ib, low[ia])
        new = new[new]
        if (new == low).all():
            break
        low = new
    other = np.flatnonzero(low != np.arange(len(node)))
    return node[low[other]], node[other]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Re-cut batches sorted by ``keys`` so that a group is never split over two tables."""
    held: list[pa.RecordBatch] = []

    def key(batch, i):
        return tuple(column(batch, k)[i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        last = key(batch, batch.num_rows - 1)
        lo, hi = 0, batch.num_rows  # first row of the batch's last group
        if key(batch, 0) != last:
            while lo < hi:
                mid = (lo + hi) // 2
                if _group_equal(batch, mid, keys, last):
                    hi = mid
                else:
                    lo = mid + 1
        cut = lo if key(batch, 0) != last else 0
        if cut:
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = [batch.slice(cut)]
        elif held and key(held[-1], held[-1].num_rows - 1) != last:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _group_equal(batch, i, keys, want) -> bool:
    return tuple(column(batch, k)[i].as_py() for k in keys) == want


def group_bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    cols = [table.column(k).to_numpy() for k in keys]
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def pair_indices(bounds: np.ndarray, side: np.ndarray, same: np.ndarray, limit: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j inside the groups, in portions; between sides only where a group is of two blocks."""
    size = np.diff(bounds)
    cost = size * (size - 1) // 2
    g = 0
    while g < len(size):
        h, total = g, 0
        while h < len(size) and (h == g or total + cost[h] <= limit):
            total += cost[h]
            h += 1
        item = np.arange(bounds[g], bounds[h])
        later = np.repeat(bounds[g + 1:h + 1], size[g:h]) - item - 1
        left = np.repeat(item, later)
        right = np.arange(len(left)) - np.repeat(np.cumsum(later) - later, later) + left + 1
        ok = same[left] | (side[left] != side[right])
        yield left[ok], right[ok]
        g = h


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a bucket that BayesLSH keeps, as a spanning forest."""
    need = min_matches()
    keys = ["bucket", "bi", "bj"]
    for table in runs(batches, keys):
        bounds = group_bounds(table, keys)
        rep = table.column("rep").to_numpy()
        sig = np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint8).reshape(-1, HASHES)
        same = table.column("bi").to_numpy() == table.column("bj").to_numpy()
        for a, b in pair_indices(bounds, table.column("side").to_numpy(), same):
            match = np.zeros(len(a), np.int32)
            for k, least in enumerate(need):
                cut = slice(k * STEP, (k + 1) * STEP)
                match += (sig[a, cut] == sig[b, cut]).sum(1, dtype=np.int32)
                ok = match >= least
                a, b, match = a[ok], b[ok], match[ok]
            if len(a):
                low, other = _forest(rep[a], rep[b])
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(other)], names=["a", "b"])


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(column(batch, "text"))
        for lo, hi in slices(texts):
            g, bounds = shingle_sets(Words(texts[lo:hi]), SHINGLE)
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [column(part, "component"), column(part, "rep"), column(part, "copies"), column(part, "members"),
                 pa.array([g[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])], pa.binary())],
                names=["component", "rep", "copies", "members", "shingles"])


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over slabs of shingles."""
    n = len(sets)
    out = np.zeros((n, n), np.float64)
    item = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    _, inverse, count = np.unique(item, return_inverse=True, return_counts=True)
    out[np.arange(n), np.arange(n)] = [len(x) for x in sets]
    shared = count > 1
    new = np.cumsum(shared) - 1
    keep = shared[inverse]
    owner, inverse = owner[keep], new[inverse[keep]]
    order = np.argsort(inverse, kind="stable")
    owner, inverse = owner[order], inverse[order]
    width = 2048
    total = np.zeros((n, n), np.float32)
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(inverse, [lo, lo + width])
        m = np.zeros((n, width), np.float32)
        m[owner[a:b], inverse[a:b] - lo] = 1
        total += m @ m.T
    np.fill_diagonal(total, 0)
    return out + total


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links inside one pair of blocks of a cluster: a link count per member, and a spanning forest."""
    keys = ["component", "bi", "bj"]
    for table in runs(batches, keys):
        bounds = group_bounds(table, keys)
        reps, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        side, bi, bj = (table.column(k).to_numpy() for k in ("side", "bi", "bj"))
        out: list[tuple] = []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")[lo:hi]]
            both = _intersections(sets)
            size = np.diag(both)
            linked = both >= THRESHOLD * (size[:, None] + size[None, :] - both) - 1e-9
            np.fill_diagonal(linked, False)
            if bi[lo] != bj[lo]:
                linked &= side[lo:hi][:, None] != side[lo:hi][None, :]
            rep = reps[lo:hi]
            for r, n in zip(rep, linked @ copies[lo:hi]):
                out.append((int(r), int(n), None))
            x, y = np.nonzero(np.triu(linked))
            if len(x):
                out += [(int(o), 0, int(a)) for a, o in zip(*_forest(rep[x], rep[y]))]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["rep", "links", "to"]).astype({"to": "Int64"}),
                                         schema=pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("to", pa.int64())]), preserve_index=False)


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id reachable by links), n_links (other documents linked directly)."""
    ship_package(docs.sparkSession)
    docs = one_text(docs)
    described = stash(docs.mapInArrow(_describe, "doc_id long, n long, d1 long, d2 long, keys binary, low binary"), "jaccard-signatures")
    sets = stash(described.where("n > 0").groupBy("n", "d1", "d2")
                 .agg(F.min_by(F.struct("doc_id", "keys", "low"), "doc_id").alias("s"), F.count("*").alias("copies"))
                 .select("n", "d1", "d2", "copies", F.col("s.doc_id").alias("rep"), "s.keys", "s.low"), "jaccard-sets")
    bands = sets.select("rep", "keys").mapInArrow(_banded, "bucket long, rep long")
    counted = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = bands.join(counted, "bucket").join(sets.select("rep", "low"), "rep")
    edges = (in_blocks(members, "bucket", "rep", "size", BLOCK).select("bucket", "bi", "bj", "side", "rep", "low")
             .repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj")
             .mapInArrow(_survivors, "a long, b long"))
    cluster = components(edges)
    cluster = (cluster.join(cluster.groupBy("component").agg(F.count("*").alias("members")), "component")
               .join(sets.select(F.col("rep").alias("node"), "copies"), "node").withColumnRenamed("node", "rep"))
    inside = (docs.join(cluster, docs.doc_id == cluster.rep).select("component", "rep", "copies", "members", "text")
              .mapInArrow(_sets_of, "component long, rep long, copies long, members long, shingles binary"))
    found = stash(in_blocks(inside, "component", "rep", "members", BLOCK)
                  .repartition("component", "bi", "bj").sortWithinPartitions("component", "bi", "bj")
                  .mapInArrow(_verified, "rep long, links long, to long"), "jaccard-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.where("to is not null").select(F.col("to").alias("a"), F.col("rep").alias("b")))
    sets = (sets.select("n", "d1", "d2", "rep", "copies").join(links, "rep", "left")
            .join(classes.withColumnRenamed("node", "rep"), "rep", "left"))
    return (described.select("doc_id", "n", "d1", "d2").join(sets, ["n", "d1", "d2"], "left")
            .select("doc_id", F.coalesce("component", "rep", "doc_id").alias("class_id"),
                    (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without near copies: of each class one row stays, that of the smallest doc_id.

    Rows whose doc_id is null or repeated come after all others, and one row of
    them stays if their class has no other.
    """
    rows = numbered(docs)
    gone = jaccard_classes(rows.select("doc_id", "row.text")).where("class_id <> doc_id").select("doc_id")
    return rows.join(gone, "doc_id", "left_anti").select("row.*")
