"""Second-order gradient boosting over binned rows.

Rows are binned once: a block holds some rows as one code per row and group of
features (``Layout``), with labels, weights, folds, a hash of the key and the margins so far.  A
level of all trees that grow side by side is one job: each task sums gradients,
hessians and counts by (tree, node, feature, bin) over its blocks, the sums are
merged, and the driver, which holds sums and never rows, picks the splits.  Of
two siblings only the smaller is summed; the other is its parent less it.
Blocks are objects of an RDD: a job on them has no query to plan.

In a table of at most ``LOCAL_TABLE_ROWS`` rows, a node of at most ``LOCAL_ROWS`` is set aside (in a symmetric tree only the
root can be), and at the end of the round the rows of each such node meet in a
task of their own, which grows the rest of its branch by the same sums and
splits.  So large nodes cost a job a level, and all small ones a job together.

Several models train in the same jobs (candidates, and their folds, which are
weights of zero on the held-out rows of one table); a model of K classes grows K
trees a round from one pass, by the gradients of the softmax.

Growth policies:

* ``level``: every node of a level is split where that gains;
* ``leaf``: best first by gain, until ``max_leaves`` (a split's gain depends on
  its node's rows alone, so levels are summed first and the queue then chooses);
* ``symmetric``: one (feature, cut) for a whole level, so a tree is d cuts and
  2^d values and is scored by a native expression.

Gain: (S(GL) + S(GR) - S(G)) / 2 - gamma with S(G) = t(G)^2 / (H + l2), where
t(G) shrinks G by l1 towards zero; a leaf is worth -rate * t(G) / (H + l2).  Ties
go to the first feature and the lowest cut.  Rows are drawn by a hash of key and
round, so trees do not depend on partitions or cores.

The updated blocks are cached, and checkpointed into the shared folder every
``checkpoint_interval`` rounds: a lost executor redoes some rounds' updates.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.session import checkpoint_dir, ship_package

#: merged on the driver below this size, else by a shuffle
DRIVER_BYTES = 64 << 20
#: nodes of at most so many rows are finished in one task each
LOCAL_ROWS = 50_000
#: ... in tables of at most so many rows; sending rows of larger ones costs more than the sums of the last levels
LOCAL_TABLE_ROWS = 100_000
#: rows of a block
BLOCK_ROWS = 32_768
#: trees of at most so many leaves find a row's leaf by masks
MASKED_LEAVES = 256
#: codes of a group of features, and of all groups where features are many
GROUP_CODES, ALL_CODES = 4_096, 49_152
#: sums by code that a task holds at once; what is above is summed feature by feature
JOINT_BYTES = 64 << 20
#: rows scored at once
SCORED_ROWS = 8_192

_OPEN, _ONE = np.uint64(2**64 - 1), np.uint64(1)


def tasks_for(rows: int) -> int:
    """Partitions of the training rows, by their number alone: some 12,000 rows a task at first, 1,000,000 in the long run.

    A task reads one block after the other, so what it holds does not grow with its rows, and each
    job pays for starting every task.
    """
    return max(1, min(math.ceil(rows / 12_000), 8 + math.ceil(rows / 1_000_000)))


@dataclass
class Spec:
    """One model to train.  ``fold``: rows of this fold are left out."""
    name: str
    objective: str                      # logistic, softmax or squared
    classes: int = 1                    # trees a round
    policy: str = "level"
    rounds: int = 100
    max_depth: int = 7
    max_leaves: int = 31
    rate: float = 0.03
    l1: float = 0.0
    l2: float = 1.0
    gamma: float = 0.0
    min_child_hessian: float = 0.0
    min_child_rows: int = 1
    row_share: float = 1.0
    column_share: float = 1.0
    weighted: bool = False
    fold: int | None = None
    seed: int = 42


class Layout:
    """Features in groups: the bins of a group's features are one code, so a row is looked up, or added to a sum, once for a group instead of once for each feature."""

    def __init__(self, widths: list[int]):
        self.widths = [int(w) for w in widths]
        most = max(256, min(GROUP_CODES, ALL_CODES // max(1, len(widths))))
        wide_first = sorted(range(len(widths)), key=lambda f: -self.widths[f])
        few = math.ceil(sum(math.log(w) for w in self.widths) / math.log(most) - 1e-9)
        for k in range(max(1, min(few, len(widths))), max(1, len(widths)) + 1):   # as few groups as do, of about equal size
            heap = [(1, i, []) for i in range(k)]
            for f in wide_first:
                size, i, fs = heapq.heappop(heap)
                heapq.heappush(heap, (size * self.widths[f], i, [*fs, f]))
            if all(size <= most or len(fs) == 1 for size, _, fs in heap):
                break
        self.groups = [sorted(fs) for _, _, fs in sorted(heap, key=lambda g: g[1]) if fs]
        self._look_up()

    def __getstate__(self) -> tuple:
        return self.widths, self.groups

    def __setstate__(self, state: tuple) -> None:
        self.widths, self.groups = state
        self._look_up()

    def _look_up(self) -> None:
        self.sizes = [math.prod(self.widths[f] for f in fs) for fs in self.groups]
        self.dtype = np.uint16 if max(self.sizes, default=1) <= 1 << 16 else np.uint32
        #: feature -> its group, and the bin that each code of the group stands for
        self.place = {f: i for i, fs in enumerate(self.groups) for f in fs}
        self.bin_of = {}
        for fs, size in zip(self.groups, self.sizes):
            after = size
            for f in fs:
                after //= self.widths[f]
                self.bin_of[f] = np.arange(size) // after % self.widths[f]

    def codes(self, bins: np.ndarray) -> np.ndarray:
        """groups x rows, of features x rows."""
        out = np.zeros((len(self.groups), bins.shape[1]), self.dtype)
        for code, fs in zip(out, self.groups):
            for f in fs:
                code *= self.dtype(self.widths[f])
                code += bins[f].astype(self.dtype)
        return out

    def bins(self, codes: np.ndarray) -> np.ndarray:
        """features x rows, of groups x rows."""
        return np.stack([self.bin_of[f].take(codes[self.place[f]]) for f in range(len(self.widths))]) if self.widths else np.zeros((0, codes.shape[1]), np.intp)


@dataclass
class Tree:
    """Nodes as arrays; feature -1 is a leaf; a row goes left if its value is at most the threshold (its bin at most the cut)."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    threshold: np.ndarray | None = None
    levels: list = field(default_factory=list)   # symmetric: (feature, cut) of each level
    _masks: tuple | None = field(default=None, repr=False, compare=False)
    _tables: tuple | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_masks": None, "_tables": None}   # worked out where they are used

    def leaf_of(self, goes_left) -> np.ndarray:
        """Node of each row; ``goes_left(rows, feature, node)`` tells for rows at inner nodes."""
        node = None
        for _ in range(64):
            if node is None:
                node = goes_left(None, None, None)
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            node[inner] = np.where(goes_left(inner, self.feature[at], at), self.left[at], self.right[at])
        return node

    def depth(self) -> int:
        deep, at = 0, np.flatnonzero(self.feature[:1] >= 0)
        while len(at):
            at = np.concatenate([self.left[at], self.right[at]])
            deep, at = deep + 1, at[self.feature[at] >= 0]
        return deep

    def masks(self, widths: list[int]) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Leaves from left to right, and for each feature (words x bins) the leaves that its cuts leave open, as bits: a cut shuts its left branch to the bins above it."""
        leaves, before, stack = [], [0] * len(self.feature), [0]
        while stack:
            i = stack.pop()
            before[i] = len(leaves)
            if self.feature[i] < 0:
                leaves.append(i)
            else:
                stack += [int(self.right[i]), int(self.left[i])]
        words, tables = -(-len(leaves) // 64), {}
        for i in np.flatnonzero(self.feature >= 0).tolist():
            f, cut = int(self.feature[i]), int(self.cut[i])
            shut = (1 << before[self.right[i]]) - (1 << before[self.left[i]])
            table = tables.setdefault(f, np.full((words, widths[f]), _OPEN))
            for w in range(words):
                table[w, cut + 1:] &= np.uint64(~(shut >> 64 * w) & int(_OPEN))
        return np.array(leaves), sorted(tables.items())

    def of_bins(self, bins: np.ndarray, widths: list[int] | None = None) -> np.ndarray:
        """Leaf of each row.  A symmetric tree asks its rows one question a level; of another each feature tells which leaves it leaves open, and the
        first that all leave open is the row's; in a tree of very many leaves all rows step down together, a leaf being its own child.

        ``bins``: features x rows; quickest as ``np.intp``, which tables are read by.  ``widths``: bins of each feature, 256 if not told.
        """
        if self.levels and len(self.feature) == 2 ** (len(self.levels) + 1) - 1:
            node = np.zeros(bins.shape[1], np.int64)
            for f, cut in self.levels:
                node += node
                node += 2
                node -= bins[f] <= cut
            return node
        if len(self.feature) <= 2 * MASKED_LEAVES:
            if self._masks is None:
                self._masks = self.masks(widths or [256] * len(bins))
            leaves, tables = self._masks
            found = None
            for w in reversed(range(-(-len(leaves) // 64))) if tables else ():
                left = tables[0][1][w].take(bins[tables[0][0]])
                for f, table in tables[1:]:
                    left &= table[w].take(bins[f])
                first = np.bitwise_count(~left & (left - _ONE)).astype(np.intp)  # zeros below the lowest bit; 64 if there is none
                found = first if found is None else np.where(first == 64, found + 64, first)
            return np.full(bins.shape[1], leaves[0]) if found is None else leaves.take(found)
        n, self_ = bins.shape[1], np.arange(len(self.feature))
        leaf = self.feature < 0
        start = np.where(leaf, 0, self.feature) * n
        child = np.stack([np.where(leaf, self_, self.right), np.where(leaf, self_, self.left)], axis=1).ravel()
        flat, row, node = bins.ravel(), np.arange(n), np.zeros(n, np.int64)
        for _ in range(self.depth()):
            goes_left = flat.take(start.take(node) + row) <= self.cut.take(node)
            node = child.take(2 * node + goes_left)
        return node

    def tables(self, layout: Layout) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """What ``found`` reads: nodes by number, and for each group of features a table over its codes."""
        d = len(self.levels)
        out: dict[int, np.ndarray] = {}
        if d and len(self.feature) == 2 ** (d + 1) - 1:   # symmetric: the number's bits, each from one level
            for level, (f, cut) in enumerate(self.levels):
                bit = (layout.bin_of[f] > cut).astype(np.intp) << (d - 1 - level)
                out[layout.place[f]] = out[layout.place[f]] + bit if layout.place[f] in out else bit
            return np.arange(2 ** d - 1, 2 ** (d + 1) - 1), sorted(out.items())
        leaves, masks = self.masks(layout.widths)
        for f, table in masks:
            wide = table.take(layout.bin_of[f], axis=1)
            out[layout.place[f]] = out[layout.place[f]] & wide if layout.place[f] in out else wide
        return leaves, sorted(out.items())

    def found(self, codes: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
        """The leaves' nodes and, of each row, which of them is its own, by number.  ``codes``: groups x rows as ``np.intp``."""
        if len(self.feature) > 2 * MASKED_LEAVES and not self.levels:
            return np.arange(len(self.feature)), self.of_bins(layout.bins(codes), layout.widths)
        if self._tables is None:
            self._tables = self.tables(layout)
        leaves, tables = self._tables
        found = None
        if tables and tables[0][1].ndim == 1:
            found = tables[0][1].take(codes[tables[0][0]])
            for g, table in tables[1:]:
                found += table.take(codes[g])
        elif tables:
            for w in reversed(range(-(-len(leaves) // 64))):
                left = tables[0][1][w].take(codes[tables[0][0]])
                for g, table in tables[1:]:
                    left &= table[w].take(codes[g])
                first = np.bitwise_count(~left & (left - _ONE)).astype(np.intp)  # as in ``of_bins``
                found = first if found is None else np.where(first == 64, found + 64, first)
        return leaves, np.zeros(codes.shape[1], np.intp) if found is None else found

    def of_values(self, x: np.ndarray) -> np.ndarray:
        def step(rows, feature, at):
            return np.zeros(len(x), np.int64) if rows is None else x[rows, feature] <= self.threshold[at]
        return self.leaf_of(step)


# --- binning ---------------------------------------------------------------

def cut_points(df: DataFrame, n_features: int, max_bins: int = 64, vector: str = "features") -> list[np.ndarray]:
    """At most ``max_bins`` - 1 cuts a feature, at distinct quantiles below the largest value; one scan."""
    x = vector_to_array(vector)
    share = [k / max_bins for k in range(1, max_bins + 1)]
    rows = df.select(x.alias("x"))
    ask = [F.percentile_approx(F.nanvl(F.col("x")[i], F.lit(None).cast("double")), share, 10_000).alias(f"q{i}") for i in range(n_features)]
    got = rows.agg(*ask).first() if ask else []
    return [np.unique(np.array(q or [], float))[:-1] for q in got]


_BLOCK = "n long, codes binary, y binary, w binary, fold binary, id binary, margin binary"
_BLOCK_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


def _binner(cuts: list[np.ndarray], base: np.ndarray, layout: Layout):
    def block_of(table: pa.Table) -> pa.RecordBatch:
        table, n = table.combine_chunks(), table.num_rows
        x = pc.list_flatten(table.column(0)).to_numpy(zero_copy_only=False).reshape(n, -1)
        bins = np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)]).astype(np.uint8) if cuts else np.zeros((0, n), np.uint8)
        codes = layout.codes(bins)
        y, w = (table.column(i).to_numpy().astype(np.float64) for i in (1, 2))
        fold, key = table.column(3).to_numpy().astype(np.int16), table.column(4).to_numpy().astype(np.int64)
        parts = (codes, y, w, fold, key, np.repeat(base[:, None], n, 1))
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], names=_BLOCK_NAMES)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield block_of(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield block_of(pa.Table.from_batches(held))
    return binned


@dataclass
class _Numbers:
    """A number for each row; if they have few values, as a byte for each row and the values."""
    codes: np.ndarray
    values: np.ndarray | None

    @classmethod
    def of(cls, v: np.ndarray) -> _Numbers:
        values, codes = np.unique(v, return_inverse=True)
        return cls(codes.astype(np.uint8), values) if len(values) <= 256 else cls(v, None)

    def take(self, rows: np.ndarray) -> np.ndarray:
        return self.codes.take(rows) if self.values is None else self.values.take(self.codes.take(rows))


@dataclass
class _Block:
    n: int
    codes: np.ndarray
    y: _Numbers
    w: _Numbers
    fold: np.ndarray
    id: np.ndarray
    margin: np.ndarray


def _blocks(layout: Layout):
    kinds = (layout.dtype, float, float, np.int16, np.int64, float)

    def block(row) -> _Block:
        n = row[0]
        codes, y, w, fold, key, margin = (np.frombuffer(b, t) for b, t in zip(row[1:], kinds))
        return _Block(n, codes.reshape(-1, n), _Numbers.of(y), _Numbers.of(w), fold, key, margin.reshape(-1, n))
    return block


def _drawn(key: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Whether a row is drawn: a hash of key and seed falls into the share."""
    if share >= 1:
        return np.ones(len(key), bool)
    h = key.view(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(31))) < np.uint64(min(int(share * 2.0**64), 2**64 - 1))


def _gradients(spec: Spec, block: _Block, lo: int, k: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Gradient and hessian of some rows for the model's k-th tree; no hessian: ones."""
    y = block.y.take(rows)
    if spec.objective == "squared":
        g, h = block.margin[lo].take(rows) - y, None
    elif spec.objective == "logistic":
        p = 1 / (1 + np.exp(-block.margin[lo].take(rows)))
        g, h = p - y, np.maximum(p * (1 - p), 1e-16)
    else:
        margin = block.margin[lo:lo + spec.classes].take(rows, axis=1)
        e = np.exp(margin - margin.max(0))
        p = e[k] / e.sum(0)
        g, h = p - (y == k), np.maximum(2 * p * (1 - p), 1e-16)
    if spec.weighted:
        w = block.w.take(rows)
        g, h = w * g, w if h is None else w * h
    return g, h


# --- a level ---------------------------------------------------------------

@dataclass
class Growing:
    """A tree under construction: its nodes so far, and which of them are summed in this job."""
    tree: Tree
    slot: np.ndarray                    # node -> place among the sums, or -1
    allowed: np.ndarray                 # features that it may split by
    joint: bool = False                 # whether rows are summed by groups of features


def _placed(block: _Block, specs: list[Spec], starts: list[int], grown: list[Growing | None], round_: int, layout: Layout) -> Iterator[tuple]:
    """For each growing tree: the slots, row numbers, gradients and hessians of the drawn rows in its asked nodes."""
    drawn, codes = {}, block.codes.astype(np.intp)
    for spec, lo in zip(specs, starts):
        for k in range(spec.classes):
            if (growing := grown[lo + k]) is None:
                continue
            draw = (spec.row_share, spec.seed, spec.fold)  # candidates and their folds draw alike
            if draw[:2] not in drawn:
                drawn[draw[:2]] = _drawn(block.id, spec.row_share, spec.seed * 100_003 + round_)
            if spec.fold is not None and draw not in drawn:
                drawn[draw] = drawn[draw[:2]] & (block.fold != spec.fold)
            leaves, found = growing.tree.found(codes, layout)
            slot = growing.slot[leaves]
            rows = np.flatnonzero((slot >= 0).take(found) & drawn[draw if spec.fold is not None else draw[:2]])
            yield lo + k, slot.take(found.take(rows)), rows, *_gradients(spec, block, lo, k, rows)


def _add_sums(total: np.ndarray, bins: np.ndarray, rows: np.ndarray, place: np.ndarray, g: np.ndarray, h: np.ndarray | None, count: int, widths: list[int], allowed: np.ndarray) -> None:
    """Add sums of gradient, hessian and rows to ``total``: of each feature that the tree may split by, 3 x slots x its bins."""
    at = 0
    for f in np.flatnonzero(allowed).tolist():
        size = count * widths[f]
        key = place * widths[f]
        key += bins[f].take(rows)
        n = np.bincount(key, None, size)
        total[at:at + size] += np.bincount(key, g, size)
        total[at + size:at + 2 * size] += n if h is None else np.bincount(key, h, size)
        total[at + 2 * size:at + 3 * size] += n
        at += 3 * size


def _size(count: int, widths: list[int], allowed: np.ndarray) -> int:
    return 3 * count * sum(w for w, a in zip(widths, allowed) if a)


def _spread(total: np.ndarray, count: int, widths: list[int], allowed: np.ndarray) -> np.ndarray:
    """The sums as slots x features x bins x 3; zero for bins that a feature has not and features that the tree may not split by."""
    out, at = np.zeros((count, len(widths), max(widths, default=1), 3)), 0
    for f in np.flatnonzero(allowed).tolist():
        size = 3 * count * widths[f]
        out[:, f, :widths[f]] = total[at:at + size].reshape(3, count, widths[f]).transpose(1, 2, 0)
        at += size
    return out


class _Joint:
    """Sums by node and code of a group of features; those of one feature are sums over the others' bins."""

    def __init__(self, count: int, layout: Layout, allowed: np.ndarray):
        self.count, self.layout, self.allowed = count, layout, allowed
        self.pairs = {i: np.zeros(count * layout.sizes[i], complex) for i in _groups(layout, allowed)}   # gradient and hessian
        self.rows: dict[int, np.ndarray] = {}   # number of rows, where that is not the hessian

    def add(self, codes: np.ndarray, rows: np.ndarray, place: np.ndarray, g: np.ndarray, h: np.ndarray | None) -> None:
        pair = np.empty(len(rows), complex)
        pair.real, pair.imag = g, 1.0 if h is None else h
        for i, total in self.pairs.items():
            key = place * self.layout.sizes[i]
            key += codes[i].take(rows)
            np.add.at(total, key, pair)
            if h is not None:
                if i not in self.rows:
                    self.rows[i] = np.zeros(len(total))
                np.add.at(self.rows[i], key, 1.0)

    def total(self) -> np.ndarray:
        """As ``_add_sums`` lays them out."""
        out = []
        for f in np.flatnonzero(self.allowed).tolist():
            i = self.layout.place[f]
            fs = self.layout.groups[i]
            others = tuple(1 + k for k, other in enumerate(fs) if other != f)

            def one(v: np.ndarray) -> np.ndarray:
                v = v.reshape(self.count, *(self.layout.widths[k] for k in fs))  # noqa: B023
                for axis in reversed(others):  # noqa: B023
                    v = v.sum(axis=axis)   # axis by axis: in one order, however many nodes there are
                return v.ravel()
            pair = one(self.pairs[i])
            out += [pair.real, pair.imag, one(self.rows[i]) if i in self.rows else pair.imag]
        return np.concatenate(out) if out else np.zeros(0)


def _groups(layout: Layout, allowed: np.ndarray) -> list[int]:
    """The groups that hold a feature which the tree may split by."""
    return sorted({layout.place[f] for f in np.flatnonzero(allowed).tolist()})


def _summer(specs: list[Spec], starts: list[int], grown: list[Growing | None], round_: int, layout: Layout):
    """Task: sums of (gradient, hessian, rows) by node, feature and bin, one array for each tree."""
    widths = layout.widths

    def sums(blocks: Iterator[_Block]) -> Iterator[tuple[int, np.ndarray]]:
        total: dict[int, np.ndarray] = {}
        joint: dict[int, _Joint] = {}
        for block in blocks:
            bins = None
            for u, place, rows, g, h in _placed(block, specs, starts, grown, round_, layout):
                count, allowed = int(grown[u].slot.max()) + 1, grown[u].allowed
                if grown[u].joint:
                    if u not in joint:
                        joint[u] = _Joint(count, layout, allowed)
                    joint[u].add(block.codes, rows, place, g, h)
                    continue
                if u not in total:
                    total[u] = np.zeros(_size(count, widths, allowed))
                bins = layout.bins(block.codes) if bins is None else bins
                _add_sums(total[u], bins, rows, place, g, h, count, widths, allowed)
        yield from total.items()
        for u in list(joint):
            yield u, joint.pop(u).total()
    return sums


def _joined(builders: list[_Builder | None], layout: Layout, rows_a_task: float) -> None:
    """Mark the trees whose rows are summed by groups of features: where a task has rows enough for it, within its memory.

    This holds for all levels of a tree: of bins whose rows all go to one child nothing is left for the other, as
    both are sums of the same numbers in the same order.
    """
    held = 0
    for b in builders:
        if b is not None:
            codes = 2 ** max(0, b.spec.max_depth - 2) * sum(layout.sizes[i] for i in _groups(layout, b.allowed))   # of the last level's nodes every other one is asked
            b.joint = codes <= 2 * rows_a_task and held + 24 * codes <= JOINT_BYTES
            held += 24 * codes * b.joint


def _sums_of(state: RDD, specs, starts, grown, round_: int, layout: Layout, tasks: int) -> dict[int, np.ndarray]:
    widths = layout.widths
    counts = {u: int(g.slot.max()) + 1 for u, g in enumerate(grown) if g is not None}
    sizes = {u: _size(c, widths, grown[u].allowed) for u, c in counts.items()}
    total = {u: np.zeros(n) for u, n in sizes.items()}
    if widths and counts:
        sums = state.mapPartitions(_summer(specs, starts, grown, round_, layout))
        if tasks * sum(sizes.values()) * 8 > DRIVER_BYTES:  # those of one tree are merged, in the order of their coming, in one task
            sums = sums.reduceByKey(np.add, min(tasks, len(counts)))
        for u, t in sums.collect():
            total[u] += t
    return {u: _spread(total[u], c, widths, grown[u].allowed) for u, c in counts.items()}


def _updater(trees: list[Tree | None], layout: Layout):
    """Task: margins with the new trees added."""
    def update(block: _Block) -> _Block:
        margin, codes = block.margin.copy(), block.codes.astype(np.intp)
        for u, tree in enumerate(trees):
            if tree is not None:
                leaves, found = tree.found(codes, layout)
                margin[u] += tree.value[leaves].take(found)
        return replace(block, margin=margin)
    return update


# --- splits ----------------------------------------------------------------

def shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def gains(spec: Spec, sums: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Gain of a cut after each (node, feature, bin); -inf where the cut is not allowed.  ``sums``: nodes x features x bins x 3."""
    left = np.cumsum(sums, axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left

    def score(s):
        return shrunk(s[..., 0], spec.l1) ** 2 / (s[..., 1] + spec.l2 + 1e-300)

    gain = (score(left) + score(right) - score(whole)) / 2
    if spec.policy != "symmetric":
        gain -= spec.gamma
        bad = np.minimum(left[..., 1], right[..., 1]) < max(spec.min_child_hessian, 1e-12)
        if spec.min_child_rows > 1:
            bad |= np.minimum(left[..., 2], right[..., 2]) < spec.min_child_rows - 0.5
        gain = np.where(bad, -np.inf, gain)
    gain[:, ~allowed] = -np.inf
    gain[:, :, -1] = -np.inf
    return gain


def _node(total, depth: int, **more) -> dict:
    return {"feature": -1, "cut": 0, "left": -1, "right": -1, "gain": 0.0, "total": total, "sums": None, "depth": depth, **more}


def _allowed(spec: Spec, round_: int, unit: int, features: int) -> np.ndarray:
    """The features that a round's tree may split by."""
    out = np.zeros(features, bool)
    out[np.random.default_rng([spec.seed, round_, unit]).permutation(features)[:max(1, math.ceil(spec.column_share * features - 1e-9))]] = True
    return out


class _Builder:
    """Grows one tree, or a branch of one, level by level from merged sums."""

    def __init__(self, spec: Spec, allowed: np.ndarray, rows: int, local_rows: int, depth: int = 0):
        self.spec, self.allowed, self.features, self.local_rows = spec, allowed, len(allowed), local_rows
        self.nodes = [_node(None, depth)]
        self.depth, self.levels, self.joint = depth, [], False
        #: nodes of this level, those whose sums are wanted, and those set aside for a task of their own
        self.frontier, self.ask, self.local = ([], [], [0]) if rows <= local_rows else ([0], [0], [])

    def tree(self) -> Tree:
        get = lambda k, t: np.array([n[k] for n in self.nodes], t)
        total = np.array([n["total"] if n["total"] is not None else np.zeros(3) for n in self.nodes])
        spec = self.spec
        value = -spec.rate * shrunk(total[:, 0], spec.l1) / np.maximum(total[:, 1] + spec.l2, 1e-300)
        return Tree(get("feature", np.int64), get("cut", np.int64), get("left", np.int64), get("right", np.int64), value, total[:, 2], levels=self.levels)

    def growing(self, nodes: list[int] | None = None) -> Growing | None:
        nodes = self.ask if nodes is None else nodes
        if not nodes:
            return None
        slot = np.full(len(self.nodes), -1, np.int64)
        slot[nodes] = np.arange(len(nodes))
        return Growing(self.tree(), slot, self.allowed, self.joint)

    def take(self, sums: np.ndarray) -> None:
        """Sums of the asked nodes: fill in the siblings, then split the level."""
        for i, s in zip(self.ask, sums):
            self.nodes[i]["sums"] = s
        for i in self.frontier:
            n = self.nodes[i]
            if n["sums"] is None:
                n["sums"] = self.nodes[n["parent"]]["sums"] - self.nodes[n["sibling"]]["sums"]
        for i in self.frontier:
            if self.nodes[i]["total"] is None:
                self.nodes[i]["total"] = self.nodes[i]["sums"][self.allowed.argmax()].sum(0) if self.features else np.zeros(3)
        self._split()
        front = {n["parent"] for n in map(self.nodes.__getitem__, self.frontier)}
        for i, n in enumerate(self.nodes):
            if i not in front:
                n["sums"] = None  # only a parent's sums are needed again

    def _split(self) -> None:
        spec, new = self.spec, []
        if self.depth < spec.max_depth and self.frontier and self.features:
            gain = gains(spec, np.stack([self.nodes[i]["sums"] for i in self.frontier]), self.allowed)
            if spec.policy == "symmetric":
                gain = np.repeat(gain.sum(0, keepdims=True), len(self.frontier), 0)
            flat = gain.reshape(len(self.frontier), -1)
            best = flat.argmax(1)
            for i, b, top in zip(self.frontier, best.tolist(), flat.max(1).tolist()):
                if not top > 1e-12:
                    continue
                f, cut = divmod(b, gain.shape[2])
                node, left = self.nodes[i], self.nodes[i]["sums"][f, :cut + 1].sum(0)
                node |= {"feature": f, "cut": cut, "left": len(self.nodes), "right": len(self.nodes) + 1, "gain": top}
                for k, total in enumerate((left, node["total"] - left)):
                    self.nodes.append(_node(total, self.depth + 1, parent=i, sibling=node["right" if k == 0 else "left"]))
                new += [node["left"], node["right"]]
            if spec.policy == "symmetric" and new:
                self.levels.append(divmod(int(best[0]), gain.shape[2]))
        self.depth += 1
        self.ask, self.frontier = [], []
        if self.depth < spec.max_depth:  # the last level's totals are known
            for pair in zip(new[0::2], new[1::2]):
                size = [self.nodes[i]["total"][2] for i in pair]
                large = [i for i, n in zip(pair, size) if spec.policy == "symmetric" or n > self.local_rows]
                self.local += [i for i in pair if i not in large]
                self.frontier += large
                self.ask += [pair[int(size[1] < size[0])]] if len(large) == 2 else large

    def graft(self, at: int, branch: list[dict], levels: list) -> None:
        """Put a branch, grown elsewhere, in the place of a node set aside."""
        number = [at, *range(len(self.nodes), len(self.nodes) + len(branch) - 1)]
        for k, n in enumerate(branch):
            n = n | {"left": number[n["left"]] if n["left"] >= 0 else -1, "right": number[n["right"]] if n["right"] >= 0 else -1, "total": np.array(n["total"], float)}
            if k:
                self.nodes.append(n)
            else:
                self.nodes[at] = self.nodes[at] | n
        self.levels += [tuple(x) for x in levels]

    def finished(self) -> Tree:
        return _best_first(self.tree(), [n["gain"] for n in self.nodes], self.spec.max_leaves) if self.spec.policy == "leaf" else self.tree()


def _rows_of(specs: list[Spec], starts: list[int], grown: list[Growing | None], round_: int, layout: Layout):
    """Task: codes, gradients and hessians of the rows of nodes set aside, by tree and node, an item for each block."""
    def rows_of(block: _Block) -> Iterator[tuple]:
        for u, place, rows, g, h in _placed(block, specs, starts, grown, round_, layout):
            for s in np.unique(place).tolist():
                at = np.flatnonzero(place == s)
                yield (u, s), (int(block.id[0]), len(at), block.codes.take(rows.take(at), axis=1), g.take(at), None if h is None else h.take(at))
    return rows_of


def _branches(plan: dict[tuple[int, int], tuple[Spec, np.ndarray, int]], layout: Layout):
    """Task of one node set aside: its branch, grown to the end."""
    widths = layout.widths

    def grow(node_rows) -> tuple:
        (unit, slot), items = node_rows
        items = sorted(items, key=lambda item: item[:2])
        spec, allowed, depth = plan[unit, slot]
        bins, g = layout.bins(np.concatenate([x[2] for x in items], axis=1)), np.concatenate([x[3] for x in items])
        h = None if items[0][4] is None else np.concatenate([x[4] for x in items])
        builder = _Builder(spec, allowed, 1, 0, depth)
        node = np.zeros(len(g), np.int64)
        while (grown := builder.growing()) is not None:
            inner = np.flatnonzero(grown.tree.feature[node] >= 0)  # one step down
            at = node[inner]
            node[inner] = np.where(bins[grown.tree.feature[at], inner] <= grown.tree.cut[at], grown.tree.left[at], grown.tree.right[at])
            place = grown.slot[node]
            rows, count = np.flatnonzero(place >= 0), int(grown.slot.max()) + 1
            total = np.zeros(_size(count, widths, allowed))
            _add_sums(total, bins, rows, place[rows], g[rows], None if h is None else h[rows], count, widths, allowed)
            builder.take(_spread(total, count, widths, allowed))
        body = [{k: n[k].tolist() if k == "total" else n[k] for k in ("feature", "cut", "left", "right", "gain", "total", "depth")} for n in builder.nodes]
        return (unit, slot), body, builder.levels
    return grow


def _best_first(tree: Tree, gain: list[float], max_leaves: int) -> Tree:
    """The part of a tree that best-first growth reaches within ``max_leaves``."""
    queue, kept, leaves = [], set(), 1
    if tree.feature[0] >= 0:
        heapq.heappush(queue, (-gain[0], 0))
    while queue and leaves < max_leaves:
        _, i = heapq.heappop(queue)
        kept.add(i)
        leaves += 1
        for child in (int(tree.left[i]), int(tree.right[i])):
            if tree.feature[child] >= 0:
                heapq.heappush(queue, (-gain[child], child))
    order, number = [0], {0: 0}
    for i in order:
        for child in (int(tree.left[i]), int(tree.right[i])) if i in kept else ():
            number[child] = len(order)
            order.append(child)
    at = np.array(order)
    inner = np.array([i in kept for i in order])
    pick = lambda a, none: np.where(inner, a[at], none)
    link = lambda a: np.array([number[int(a[i])] if i in kept else -1 for i in order])
    return Tree(pick(tree.feature, -1), pick(tree.cut, 0), link(tree.left), link(tree.right), tree.value[at], tree.cover[at])


# --- training --------------------------------------------------------------

def _base_margins(df: DataFrame, specs: list[Spec]) -> tuple[np.ndarray, int]:
    """Starting margins, and the number of rows: the (weighted) mean or its log-odds, one aggregate; with several classes zero, so that few rounds already decide by the features."""
    ask = []
    for i, s in enumerate(specs):
        w = F.col("weight") if s.weighted else F.lit(1.0)
        if s.fold is not None:
            w = F.when(F.col("fold") != s.fold, w)
        ask.append((F.sum(w * F.col("label")) / F.sum(w)).alias(f"b{i}"))
    out = []
    *means, rows = df.agg(*ask, F.count(F.lit(1)).alias("n")).first()
    for s, mean in zip(specs, means):
        share = min(max(float(mean or 0.0), 1e-6), 1 - 1e-6)
        out += [float(mean or 0.0)] if s.objective == "squared" else [math.log(share / (1 - share))] if s.objective == "logistic" else [0.0] * s.classes
    return np.array(out), rows


def fit(df: DataFrame, specs: list[Spec], n_features: int, max_bins: int = 64, checkpoint_interval: int = 10, vector: str = "features",
        local_rows: int = LOCAL_ROWS) -> dict[str, Booster]:
    """Train the models side by side on rows of row_key, label, weight, fold and a feature vector; one model for each spec's name."""
    spark = df.sparkSession
    ship_package(spark)
    cuts = cut_points(df, n_features, max_bins, vector)
    layout = Layout([len(c) + 1 for c in cuts])
    starts = np.cumsum([0, *(s.classes for s in specs)]).tolist()
    base, rows = _base_margins(df, specs)
    key = F.xxhash64("row_key") if "row_key" in df.columns else F.xxhash64(vector_to_array(vector))
    fold = F.col("fold").cast("int") if "fold" in df.columns else F.lit(0)
    state = (df.select(vector_to_array(vector).alias("x"), F.col("label").cast("double"), F.col("weight").cast("double"), fold.alias("fold"), key.alias("id"))
             .mapInArrow(_binner(cuts, base, layout), _BLOCK).rdd)
    if state.getNumPartitions() > 2 * tasks_for(rows):
        state = state.coalesce(tasks_for(rows))
    state = state.map(_blocks(layout)).persist(StorageLevel.MEMORY_AND_DISK_DESER)  # as bytes: read by every job, so not compressed
    checkpoint_dir(spark)  # set, if the cluster's configuration has not set it yet
    state.checkpoint()
    older = None
    tasks = state.getNumPartitions()
    state.map(attrgetter("n")).sum()   # one job bins all rows, and keeps them
    local_rows = local_rows if rows <= max(LOCAL_TABLE_ROWS, local_rows) else 0
    trees: list[list[Tree]] = [[] for _ in range(starts[-1])]
    for round_ in range(max((s.rounds for s in specs), default=0)):
        builders = [_Builder(s, _allowed(s, round_, u, n_features), rows, local_rows) if round_ < s.rounds else None for s, lo in zip(specs, starts) for u in range(lo, lo + s.classes)]
        _joined(builders, layout, rows / max(1, tasks))
        while any(b and b.ask for b in builders):
            grown = [b.growing() if b else None for b in builders]
            got = _sums_of(state, specs, starts, grown, round_, layout, tasks)
            for u, g in enumerate(grown):
                if g is not None:
                    builders[u].take(got[u])
        apart = {(u, k): i for u, b in enumerate(builders) if b for k, i in enumerate(b.local)}
        if apart and n_features:
            grown = [b.growing(b.local) if b else None for b in builders]
            plan = {(u, k): (builders[u].spec, builders[u].allowed, builders[u].nodes[i]["depth"]) for (u, k), i in apart.items()}
            got = (state.flatMap(_rows_of(specs, starts, grown, round_, layout)).groupByKey(min(len(apart), 4 * tasks))
                   .map(_branches(plan, layout)).collect())  # nodes of branches, no rows
            for (u, k), body, levels in sorted(got, key=lambda g: g[0]):
                builders[u].graft(apart[u, k], body, levels)
        done = [b.finished() if b else None for b in builders]
        for u, t in enumerate(done):
            if t is not None:
                trees[u].append(t)
        added = state.map(_updater(done, layout)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        if (round_ + 1) % checkpoint_interval == 0:
            added.checkpoint()
        if older is not None:  # ``state`` was filled from it by this round's first job
            older.unpersist()
        state, older = added, state
    for last in (state, older):
        if last is not None:
            last.unpersist()
    for forest in trees:
        for t in forest:
            t.threshold = np.array([cuts[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature.tolist(), t.cut.tolist())])
    return {s.name: Booster(s, n_features, base[lo:lo + s.classes], trees[lo:lo + s.classes]) for s, lo in zip(specs, starts)}


# --- models ----------------------------------------------------------------

def _double(v: float) -> str:
    """A number as a literal of SQL."""
    return f"{float(v)!r}D" if math.isfinite(v) else f"double('{float(v)}')"


def scorer_of(models: list[Booster]):
    """Margins (rows x outputs, model after model) of a matrix of values: they are binned once, by all thresholds of the models, and every tree is told of bins."""
    n_features, base = models[0].n_features, np.concatenate([m.base for m in models])
    trees = [forest for m in models for forest in m.trees]
    known = [[t.threshold[t.feature == f] for forest in trees for t in forest] for f in range(n_features)]
    cuts = [np.unique(np.concatenate([np.zeros(0), *k])) for k in known]
    layout = Layout([len(c) + 1 for c in cuts])

    def of_bins(t: Tree) -> Tree:
        cut = np.array([np.searchsorted(cuts[f], v) if f >= 0 else 0 for f, v in zip(t.feature.tolist(), t.threshold.tolist())], np.int64)
        at, levels = 0, []
        for _ in t.levels:
            levels.append((int(t.feature[at]), int(cut[at])))
            at = int(t.left[at])
        return Tree(t.feature, cut, t.left, t.right, t.value, t.cover, levels=levels)
    forests = [[of_bins(t) for t in forest] for forest in trees]

    def margins(x: np.ndarray) -> np.ndarray:
        out = np.repeat(base[None, :], len(x), 0)
        for lo in range(0, len(x), SCORED_ROWS):
            part = x[lo:lo + SCORED_ROWS]
            bins = np.stack([np.searchsorted(c, part[:, f]) for f, c in enumerate(cuts)]) if cuts else np.zeros((0, len(part)), np.intp)   # nan: above every cut
            codes = layout.codes(bins).astype(np.intp)
            for k, forest in enumerate(forests):
                total = out[lo:lo + SCORED_ROWS, k]
                for t in forest:
                    leaves, found = t.found(codes, layout)
                    total += t.value[leaves].take(found)
        return out
    return margins


def margins_of(models: list[Booster], x: str) -> Column:
    """Margins of some models, one after the other in one array, of rows whose values are the array column ``x``: each batch goes to Python once."""
    @F.arrow_udf("array<double>")
    def margin(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = scorer_of(models)
        for rows in batches:
            v = pc.list_flatten(rows).to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), models[0].n_features)
            out = score(v)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))
    return margin(x)


def together(models: list) -> bool:
    """Whether these are boosted models that read the same feature vector, and so can be scored by ``with_outputs``."""
    return bool(models) and all(isinstance(m, Booster) and (m.n_features, m.vector) == (models[0].n_features, models[0].vector) for m in models)


def with_outputs(models: dict[str, Booster], df: DataFrame) -> DataFrame:
    """``df`` with an array column of each model's name: a classifier's probabilities, or the value alone; all models read a batch of rows together."""
    every = list(models.values())
    ship_package(df.sparkSession)
    out = df.withColumn("__values", vector_to_array(every[0].vector)).withColumn("__margins", margins_of(every, "__values")).drop("__values")
    at = 1
    for name, m in models.items():
        out = out.withColumn("__margin", F.slice("__margins", at, len(m.trees)))
        out = out.withColumnRenamed("__margin", name) if m.spec.objective == "squared" else m.with_shares(out, "__margin", name).drop("__margin")
        at += len(m.trees)
    return out.drop("__margins")


class Booster:
    """A fitted model: starting margins and a list of trees for each output."""

    def __init__(self, spec: Spec, n_features: int, base: np.ndarray, trees: list[list[Tree]], vector: str = "features"):
        self.spec, self.n_features, self.base, self.trees, self.vector = spec, n_features, np.asarray(base, float), trees, vector

    def margins(self, x: np.ndarray) -> np.ndarray:
        """rows x outputs."""
        return self.scorer()(x)

    def scorer(self):
        """Margins (rows x outputs) of a matrix of values."""
        return scorer_of([self])

    def _margin_column(self, x: str) -> Column:
        """Margins of the rows whose values are the array column ``x``."""
        if self.spec.policy == "symmetric":
            return F.array(*[F.expr(self._symmetric_margin(x, k)) for k in range(len(self.trees))])
        return margins_of([self], x)

    def _symmetric_margin(self, x: str, k: int) -> str:
        """Native: each tree's value at the bits that its levels' comparisons write.

        Plain comparisons and literal tables, as SQL: they are compiled once, where functions over arrays would be walked for each row.
        """
        terms = [_double(self.base[k])]
        for t in self.trees[k]:
            depth, at, nodes, bits = len(t.levels), 0, [0], ["0"]
            for _ in range(depth):
                nodes = [c for i in nodes for c in (int(t.left[i]), int(t.right[i]))]
            for level, (f, _) in enumerate(t.levels):
                bits.append(f"if({x}[{f}] <= {_double(t.threshold[at])}, 0, {2 ** (depth - 1 - level)})")
                at = int(t.left[at])
            terms.append(f"array({', '.join(_double(t.value[i]) for i in nodes)})[{' + '.join(bits)}]")
        while len(terms) > 1:  # no sum is nested deeper than this
            terms = [f"({' + '.join(terms[i:i + 128])})" for i in range(0, len(terms), 128)]
        return terms[0]

    def transform(self, df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
        """``df`` with the prediction, and for classifiers the probabilities of the classes as a vector."""
        ship_package(df.sparkSession)
        out = df.withColumn("__values", vector_to_array(self.vector)).withColumn("__margin", self._margin_column("__values")).drop("__values")
        if self.spec.objective == "squared":
            return out.withColumn(prediction, F.col("__margin")[0]).drop("__margin")
        out = self.with_shares(out, "__margin", "__p")
        out = out.withColumn(probability, array_to_vector("__p")).withColumn(prediction, self.prediction("__p"))
        return out.drop("__margin", "__p")

    def prediction(self, outputs: str) -> Column:
        """The class of the highest probability, or the value alone, from the array column of ``with_outputs``."""
        return F.col(outputs)[0] if self.spec.objective == "squared" else (F.array_position(outputs, F.array_max(outputs)) - 1).cast("double")

    def with_shares(self, df: DataFrame, margin: str, name: str) -> DataFrame:
        """Adds the classes' probabilities as an array, from the array column of margins."""
        m = F.col(margin)
        if self.spec.objective == "logistic":
            p = 1 / (1 + F.exp(-m[0]))
            return df.withColumn(name, F.array(1 - p, p))
        e = F.transform(m, lambda v: F.exp(v - F.array_max(m)))
        return df.withColumn("__e", e).withColumn(name, F.transform("__e", lambda v: v / F.aggregate("__e", F.lit(0.0), lambda a, b: a + b))).drop("__e")

    def arrays(self) -> list[dict]:
        """Node arrays of every tree, for tree SHAP; the starting margin is spread evenly over an output's trees."""
        out = []
        for k, forest in enumerate(self.trees):
            name = [None] if len(self.trees) == 1 else [str(k)]
            if not forest:
                forest = [Tree(*(np.array([v]) for v in (-1, 0, -1, -1)), np.zeros(1), np.ones(1), np.zeros(1))]
            for t in forest:
                out.append({"feature": t.feature, "threshold": t.threshold, "left": t.left, "right": t.right, "value": (t.value + self.base[k] / len(forest))[:, None],
                            "cover": np.maximum(t.cover, 1e-9), "weight": 1.0, "outputs": name})
        return out

    def save(self, path: str, spark) -> None:
        """One row for each tree, and one for the model itself."""
        rows = [(-1, -1, json.dumps(self.spec.__dict__ | {"n_features": self.n_features, "base": self.base.tolist(), "vector": self.vector}))]
        rows += [(k, i, json.dumps({c: getattr(t, c).tolist() for c in _ARRAYS} | {"levels": t.levels})) for k, forest in enumerate(self.trees) for i, t in enumerate(forest)]
        spark.createDataFrame(rows, "output int, tree int, body string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark) -> Booster:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r.output, r.tree))  # the trees of one model
        about = json.loads(rows[0].body)
        extra = {c: about.pop(c) for c in ("n_features", "base", "vector")}
        spec = Spec(**about)
        trees: list[list[Tree]] = [[] for _ in range(spec.classes)]
        for r in rows[1:]:
            body = json.loads(r.body)
            trees[r.output].append(Tree(**{c: np.array(body[c]) for c in _ARRAYS}, levels=[tuple(x) for x in body["levels"]]))
        return cls(spec, extra["n_features"], np.array(extra["base"]), trees, extra["vector"])


_ARRAYS = ("feature", "cut", "left", "right", "value", "cover", "threshold")
