"""Embedding near-dedup by a subspace pigeonhole join (operator 7).

Vectors of equal, non-null label link when their cosine, in double precision, is
at least ``THRESHOLD``.

1. Equal vectors of a label are one representative with a count.
2. Unit vectors are rotated (one random orthogonal matrix, the same everywhere) and split
   into blocks of ``BLOCK_DIMS`` dimensions.  A linked pair has a squared distance
   of at most 2 (1 - THRESHOLD); in at least one block it has no more than the
   block's share of that, in proportion to its dimensions (pigeonhole).
3. Per block a range join: vectors meet in cells of the block's first coordinate, as wide
   as the block's radius, each in its own cell and the next; inside a cell they
   are sorted by the second coordinate and compared, by matrix products, with those in
   reach.  A pair stays if its squared distance in the whole block is in budget;
   a pair in budget in several blocks counts in the first.
4. The task that holds a candidate verifies it by the cosine of the original vectors.
   Links are counted there: a task gives each vector's number of links and a spanning
   forest, so output grows with the vectors, not with the pairs of a large group.

Large cells are split into pairs of blocks of ``ROWS`` rows, so none is one task.  No
candidate is dropped; the only losses are of floating point, and the budgets
leave room for these.

Edge cases: vectors that are null, zero or hold null or non-finite components,
and rows of null label, link with nothing; vectors of different length do not
link; rows of null vec_id are not returned; of repeated rows of one vec_id the
least (label, vector) stands; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.session import ship_package

from .jaccard import _forest, group_bounds, runs
from .shared import components, in_blocks, stash
from .textscan import column

THRESHOLD = 0.93
BLOCK_DIMS = 16
#: rows of a block of a large cell; rows and pairs that a task compares at a time
ROWS = 8192
STRIP = 512
PAIRS = 50_000
FOREST = 1_000_000

CELL = ["label", "dims", "block", "cell"]
GROUP = [*CELL, "bi", "bj"]


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix that depends on the dimension alone."""
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int) -> list[tuple[int, int]]:
    return [(a, min(dims, a + BLOCK_DIMS)) for a in range(0, dims, BLOCK_DIMS)]


def budget(a: int, b: int, dims: int) -> float:
    return 2 * (1 - THRESHOLD) * (b - a) / dims * (1 + 1e-6) + 1e-6


def reach(a: int, b: int, dims: int) -> float:
    return budget(a, b, dims) ** 0.5 * (1 + 1e-4)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows in double precision, divided by their largest component, so that squares neither overflow nor vanish."""
    x = x.astype(np.float64)
    return x / np.abs(x).max(1, keepdims=True)


CELLS = "label long, dims int, block int, cell long, home boolean, rep long, copies long, vector binary, unit binary"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector in its cell of each block (home) and in the next cell."""
    names = [c.split()[0] for c in CELLS.split(", ")]
    for batch in batches:
        length = pc.list_value_length(column(batch, "embedding")).to_numpy(zero_copy_only=False)
        for dims in np.unique(length).tolist():
            part = batch.filter(pa.array(length == dims))
            x = column(part, "embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            unit = scaled(x) @ rotation(dims).T
            unit = (unit / np.sqrt((unit * unit).sum(1, keepdims=True))).astype(np.float32)
            n = len(x)
            row = [column(part, c) for c in ("rep", "copies")] + [pa.array([v.tobytes() for v in m], pa.binary()) for m in (x, unit)]
            for k, (a, b) in enumerate(blocks(dims)):
                home = np.floor(unit[:, a].astype(np.float64) / reach(a, b, dims)).astype(np.int64)
                for step in (0, 1):
                    yield pa.RecordBatch.from_arrays(
                        [column(part, "label"), pa.array(np.full(n, dims, np.int32)), pa.array(np.full(n, k, np.int32)), pa.array(home + step),
                         pa.array(np.full(n, step == 0)), *row], names=names)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each vector with links in a group: their number, and the smallest vector it reaches by them."""
    for table in runs(batches, GROUP):
        bounds = group_bounds(table, GROUP)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi - lo > 1:
                yield _links_of(table.slice(lo, hi - lo))


def _links_of(group: pa.Table) -> pa.RecordBatch:
    dims, k, bi, bj = (group.column(c)[0].as_py() for c in ("dims", "block", "bi", "bj"))
    a, b = blocks(dims)[k]
    unit = np.frombuffer(b"".join(group.column("unit").to_pylist()), np.float32).reshape(-1, dims)
    vector = b"".join(group.column("vector").to_pylist())
    vector = scaled(np.frombuffer(vector, np.float32 if len(vector) == unit.nbytes else np.float64).reshape(-1, dims))
    order = np.argsort(unit[:, min(a + 1, b - 1)], kind="stable")
    unit, vector = unit[order], vector[order]
    rep, copies, home, side = (group.column(c).to_numpy()[order] for c in ("rep", "copies", "home", "side"))
    key, near = unit[:, min(a + 1, b - 1)], np.ascontiguousarray(unit[:, a:b])
    square, norm = (near * near).sum(1), np.sqrt((vector * vector).sum(1))
    links, low, other = np.zeros(len(rep), np.int64), [], []
    for s in range(0, len(rep), STRIP):
        strip = slice(s, min(s + STRIP, len(rep)))
        within = slice(s, int(np.searchsorted(key, float(key[strip][-1]) + reach(a, b, dims), "right")))
        gap = square[strip, None] + square[None, within] - 2 * (near[strip] @ near[within].T)
        i, j = (x + s for x in np.nonzero(gap <= budget(a, b, dims) + 1e-5))
        ok = (i < j) & (home[i] | home[j]) & (rep[i] != rep[j])
        if bi != bj:
            ok &= side[i] != side[j]
        i, j = i[ok], j[ok]
        for c in range(0, len(i), PAIRS):
            p, q = _verified(unit, vector, norm, i[c:c + PAIRS], j[c:c + PAIRS], k, dims)
            if len(p):
                links += np.bincount(p, copies[q], len(rep)).astype(np.int64) + np.bincount(q, copies[p], len(rep)).astype(np.int64)
                star = _forest(rep[p], rep[q])
                low.append(star[0])
                other.append(star[1])
                if sum(map(len, low)) > FOREST:
                    low, other = ([x] for x in _forest(np.concatenate(low), np.concatenate(other)))
    root = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if low:
        root = _forest(np.concatenate(low), np.concatenate(other))
    some = links > 0
    found = rep[some]
    to = found.copy()
    at = np.argsort(root[1])
    hit = np.isin(found, root[1])
    to[hit] = root[0][at][np.searchsorted(root[1][at], found[hit])]
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(to), pa.array(links[some])], names=["rep", "low", "n"])


def _verified(unit, vector, norm, p, q, k, dims):
    """Of these pairs those in budget in block k and in no earlier one, with a cosine of the threshold."""
    for block, (a, b) in reversed(list(enumerate(blocks(dims)[:k + 1]))):
        gap = unit[p][:, a:b].astype(np.float64) - unit[q][:, a:b]
        ok = (np.ascontiguousarray(gap * gap).sum(1) <= budget(a, b, dims)) == (block == k)
        p, q = p[ok], q[ok]
    ok = (vector[p] * vector[q]).sum(1) / (norm[p] * norm[q]) >= THRESHOLD
    return p[ok], q[ok]


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for each vector."""
    ship_package(vectors.sparkSession)
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = (vectors.where("vec_id is not null").select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast(kind).alias("embedding"))
            .groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.*"))
    fine = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
            & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0))
    rows = stash(rows.withColumn("fine", F.coalesce(fine, F.lit(False))), "vectors")
    usable = rows.where("fine")
    copies = stash(usable.groupBy("label", "embedding").agg(F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("copies")), "vector-copies")
    cells = copies.select("label", "rep", "copies", "embedding").mapInArrow(_cells, CELLS)
    sizes = cells.groupBy(*CELL).agg(F.count("*").alias("size"), F.max("home").alias("any_home")).where("size > 1 and any_home")
    links = stash(in_blocks(cells.join(sizes, CELL), "cell", "rep", "size", ROWS)
                  .select(*GROUP, "side", "home", "rep", "copies", "vector", "unit")
                  .repartition(*GROUP).sortWithinPartitions(*GROUP)
                  .mapInArrow(_links, "rep long, low long, n long"), "vector-links")
    degree = links.groupBy("rep").agg(F.sum("n").alias("n"))
    found = (copies.join(degree, "rep", "left")
             .join(components(links.select(F.col("rep").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "rep"), "rep", "left")
             .select("label", "embedding", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = usable.join(found, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(rest).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
