"""Advertised data protocol without code in the reference.

* K1 ``cap_per_dataset``: at most n rows per dataset, chosen by hash order; a
  hash bound from the dataset's count cuts it down to about n before the rank.
* K2 ``drop_rare_classes``: classes under 50 rows are removed (semi-join on
  the class-count table).
* K3 ``rebalance``: synthetic minority rows between a row and one of its
  nearest neighbours of the same class; ``nearest_in_class`` finds them in
  blocks of bounded size along several locality-preserving orders.
* K4 ``clusters``: MLlib k-means on the assembled features.
* K5 ``isolation_scores``: isolation forest; each tree is grown with
  ``groupBy(tree).applyInPandas`` on a hash sample of at most ``sample_size``
  rows (bounded groups), and rows are scored with ``mapInPandas``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.functions.exprs import md5_key
from quillstat.operators.ranking import global_rank
from quillstat.session import cut_lineage, ship_package

MIN_CLASS_ROWS = 50
NEIGHBOURS = 5
BLOCK_ROWS = 512      # rows compared with each other in one task
ORDERS = 8            # locality-preserving orders that a row is looked up in
MAX_DIRECTIONS = 8    # random directions that an order interleaves
CLASS_TABLE_BROADCAST_LIMIT = 1_000_000


def cap_per_dataset(df: DataFrame, dataset: str, keys: list[str], n: int) -> DataFrame:
    """K1: the first ``n`` rows of each dataset in md5(key) order.

    Rows are counted per dataset first.  Of a dataset larger than 2n only rows
    whose hash is under (n + 10 sqrt(n) + 50) / count go to the rank, ten
    standard deviations above the n rows wanted, so whatever the number of scan
    tasks a dataset ships little more than n rows.
    """
    h = md5_key(*keys)
    share = F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / float(1 << 48)
    bound = F.when(F.col("__count") <= 2 * n, F.lit(2.0)).otherwise(F.lit(n + 10 * math.sqrt(n) + 50) / F.col("__count"))
    counts = df.groupBy(F.col(dataset).alias("__dataset")).agg(F.count(F.lit(1)).alias("__count"))
    near = df.join(counts, F.col(dataset).eqNullSafe(F.col("__dataset"))).where(share < bound)
    w = Window.partitionBy(dataset).orderBy(h, *keys)
    return (near.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
            .drop("__rn", "__dataset", "__count"))


def drop_rare_classes(df: DataFrame, label: str, min_rows: int = MIN_CLASS_ROWS,
                      n_classes_hint: int | None = None) -> DataFrame:
    """K2: keep rows whose class has at least ``min_rows`` rows.

    The class table is broadcast only when its size is known to be small
    (``n_classes_hint`` from the profile); otherwise the semi-join shuffles.
    """
    keep = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_rows).select(label)
    if n_classes_hint is not None and n_classes_hint <= CLASS_TABLE_BROADCAST_LIMIT:
        keep = F.broadcast(keep)
    return df.join(keep, label, "left_semi")


def _unit_hash(*cols: Column) -> Column:
    """A deterministic number in [0, 1) from the given columns, in steps of 2**-62."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 62)).cast("double") / float(1 << 62)


def _zorder(orders: int, width: int, seed: int = 42):
    """For every order: a random rotation, shift and the interleaved bits of the turned coordinates (a Z-curve)."""
    rng = np.random.default_rng(seed)
    p = min(width, MAX_DIRECTIONS)
    bits = min(16, 62 // max(1, p))
    turns = [np.linalg.qr(rng.standard_normal((width, width)))[0][:, :p] for _ in range(orders)]
    shifts = rng.random((orders, p))

    def codes(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), orders), np.int64)
        for o in range(orders):
            place = np.clip((x @ turns[o] + 8) / 18 + shifts[o] / 9, 0, 1 - 1e-9)   # deviations of -8 to 8, shifted by up to 2
            cell = (place * (1 << bits)).astype(np.int64)
            for b in range(bits):
                for j in range(p):
                    out[:, o] |= ((cell[:, j] >> b) & 1) << (b * p + j)
        return out
    return codes


def nearest_in_class(df: DataFrame, label: str, row: str, features: str, k: int = NEIGHBOURS,
                     orders: int = ORDERS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """K3: (row, near): up to ``k`` nearest rows of the same class, as structs (distance, row, x), nearest first.

    ``row`` is a unique number and ``features`` an array of finite, standardised
    doubles.  In each of several randomly turned and shifted Z-orders, rows are
    ranked by (class, code, row) and cut into blocks of exactly ``block_rows``
    rows; a block's rows are compared with each other in one task and the
    nearest over all orders stay.  Blocks are cut by rank, so a class of a
    billion identical rows is as many bounded blocks, and no row is left out.
    Work grows with rows x orders x block_rows.  A row alone in its class has no
    entry.  The search is approximate: neighbours that no order brings into one
    block are missed (the tests measure the share found).
    """
    ship_package(df.sparkSession)
    width = df.select(F.size(features)).first()
    width = width[0] if width else 1

    def coded(batches):
        codes = _zorder(orders, width)
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, width))
            z = codes(x)
            for o in range(orders):
                yield pdf.assign(which=np.int32(o), code=z[:, o])

    def compared(block: pd.DataFrame) -> pd.DataFrame:
        ids, x = block["row"].to_numpy(), np.stack(block["x"].to_numpy())
        rows, near = [], []
        for _, own in block.groupby("class", sort=False, dropna=False).indices.items():
            if len(own) < 2:
                continue
            take = min(k, len(own) - 1)
            z = x[own] - x[own].mean(axis=0)
            square = (z * z).sum(axis=1)
            d = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * z @ z.T, 0))
            np.fill_diagonal(d, np.inf)
            best = np.argpartition(d, take - 1, axis=1)[:, :take]
            for i, js in enumerate(best):
                rows.append(ids[own[i]])
                near.append([{"distance": float(d[i, j]), "row": int(ids[own[j]]), "x": x[own[j]].tolist()} for j in js])
        return pd.DataFrame({"row": np.array(rows, np.int64), "near": near})

    base = df.select(F.col(label).cast("string").alias("class"), F.col(row).cast("long").alias("row"), F.col(features).alias("x"))
    placed = base.mapInPandas(coded, "class string, row long, x array<double>, which int, code long")
    ranked = global_rank(placed, [F.col("which"), F.col("class"), F.col("code"), F.col("row")], "rank0")
    found = (ranked.withColumn("block", F.floor(F.col("rank0") / block_rows)).groupBy("which", "block")
             .applyInPandas(compared, "row long, near array<struct<distance:double,row:long,x:array<double>>>"))
    # a pair met in several orders may differ in its last digits: the row says what is one neighbour
    each = (found.select("row", F.explode("near").alias("e"))
            .groupBy("row", F.col("e.row").alias("other")).agg(F.min("e.distance").alias("distance"), F.first("e.x").alias("x")))
    sorted_near = F.array_sort(F.collect_list(F.struct("distance", F.col("other").alias("row"), "x")))   # at most k x orders a row
    return each.groupBy("row").agg(F.slice(sorted_near, 1, k).alias("near"))


def rebalance(df: DataFrame, label: str, key: str, features: list[str], total: int | None = None,
              neighbours: int = NEIGHBOURS) -> DataFrame:
    """K3: synthetic rows bring every class up to the largest.

    A class of n rows that lacks m gets exactly m: every row is replicated
    m // n times, and the first m % n rows in hash order once more.  Each copy
    moves by a hash weight towards one of the row's ``neighbours`` nearest rows
    of its class (drawn by hash; a row alone in its class is copied; a null
    feature stays null).  ``total`` bounds all rows of the result, if given: the
    classes then share what is left in proportion to what they lack.  The class
    table is joined, never collected, so the number of classes is not bounded.
    Synthetic rows are marked ``synthetic = true``.
    """
    originals = df.select(key, label, *features).withColumn("synthetic", F.lit(False))
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    whole = counts.agg(F.max("__n").alias("top"), F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    if not whole["k"] or whole["top"] * whole["k"] == whole["n"]:
        return originals
    share = 1.0 if total is None else min(1.0, max(0, total - whole["n"]) / (whole["top"] * whole["k"] - whole["n"]))
    plan = counts.withColumn("__need", F.floor((F.lit(whole["top"]) - F.col("__n")) * F.lit(share))).where("__need > 0")
    few = whole["k"] <= CLASS_TABLE_BROADCAST_LIMIT   # else the class tables are left to a shuffle join
    minority = df.select(key, label, *features).join(F.broadcast(plan) if few else plan, label)
    order = [F.col(label), _unit_hash(F.col(key).cast("string"), F.lit("rest")), F.col(key), *[F.col(f) for f in features]]
    ranked = cut_lineage(global_rank(minority, order, "__g"))
    st = ranked.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)],
                    *[F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(features)]).first()
    if st is None or st["m0"] is None and ranked.isEmpty():
        return originals
    z = [F.coalesce((F.col(f) - F.lit(st[f"m{i}"] or 0.0)) / F.lit(st[f"s{i}"] or 1.0), F.lit(0.0)).cast("double") for i, f in enumerate(features)]
    near = nearest_in_class(ranked.select(label, "__g", F.array(*z).alias("__x")), label, "__g", "__x", neighbours)
    near = near.select(F.col("row").alias("__g"), F.transform("near", lambda e: e["x"]).alias("__near"))
    first = ranked.groupBy(label).agg(F.min("__g").alias("__first"))
    extra = F.when(F.col("__g") - F.col("__first") < F.pmod(F.col("__need"), F.col("__n")), 1).otherwise(0)
    copies = (ranked.join(F.broadcast(first) if few else first, label).withColumn("__copies", (F.floor(F.col("__need") / F.col("__n")) + extra).cast("int")).where("__copies > 0")
              .join(near, "__g", "left").withColumn("__rep", F.explode(F.sequence(F.lit(1), F.col("__copies")))))
    drawn = F.pmod(F.xxhash64(F.col("__g"), F.col("__rep"), F.lit("partner")), F.size("__near"))
    partner = F.when(F.size("__near") > 0, F.try_element_at("__near", (drawn + 1).cast("int")))
    u = _unit_hash(F.col(key), F.col("__rep"))
    synth = copies.withColumn("__to", partner).select(
        F.concat_ws("#", F.col(key).cast("string"), F.lit("syn"), F.col("__rep").cast("string")).alias(key),
        label,
        *[(F.col(f) + u * F.coalesce(F.col("__to")[i] * F.lit(st[f"s{i}"] or 1.0) + F.lit(st[f"m{i}"] or 0.0) - F.col(f), F.lit(0.0))).alias(f)
          for i, f in enumerate(features)])
    return originals.unionByName(synth.withColumn("synthetic", F.lit(True)))


def clusters(df: DataFrame, k: int = 3, features: str = "features", seed: int = 42) -> tuple[object, DataFrame]:
    """K4: k-means clusters of the assembled feature vectors."""
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)
    return model, model.transform(df)


# ---------------------------------------------------------------------------
# K5 isolation forest
# ---------------------------------------------------------------------------

def _c(n: float) -> float:
    """Average path length of an unsuccessful search in a binary search tree."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, depth: int, limit: int, nodes: list) -> int:
    idx = len(nodes)
    nodes.append([-1, 0.0, -1, -1, float(len(x))])
    if depth >= limit or len(x) <= 1:
        return idx
    lo, hi = x.min(axis=0), x.max(axis=0)
    choices = np.flatnonzero(hi > lo)
    if len(choices) == 0:
        return idx
    f = int(rng.choice(choices))
    t = float(rng.uniform(lo[f], hi[f]))
    mask = x[:, f] < t
    nodes[idx][0], nodes[idx][1] = f, t
    nodes[idx][2] = _grow(x[mask], rng, depth + 1, limit, nodes)
    nodes[idx][3] = _grow(x[~mask], rng, depth + 1, limit, nodes)
    return idx


def isolation_forest(df: DataFrame, key: str, features: str = "features", n_trees: int = 100,
                     sample_size: int = 256, seed: int = 42) -> list[np.ndarray]:
    """K5 fit: each tree sees a hash sample of about ``sample_size`` rows.

    A row joins tree t when hash(key, t) falls below sample_size / n, so the
    exploded relation has about n_trees * sample_size rows and each
    ``applyInPandas`` group is bounded by the sample size.
    """
    n = df.count()
    if n == 0:
        return []
    frac = min(1.0, sample_size / n)
    limit = int(math.ceil(math.log2(max(sample_size, 2))))
    trees_col = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                         lambda t: _unit_hash(F.col(key), t, F.lit(seed)) < F.lit(frac))
    sampled = df.select(F.explode(trees_col).alias("tree"), vector_to_array(F.col(features)).alias("x"))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.vstack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, 1))
        nodes: list = []
        _grow(x, np.random.default_rng(seed + tree), 0, limit, nodes)
        a = np.array(nodes, dtype=float)
        return pd.DataFrame({"tree": [tree], "nodes": [a.ravel().tolist()]})

    rows = sampled.groupBy("tree").applyInPandas(grow, "tree int, nodes array<double>").collect()
    return [np.array(r["nodes"]).reshape(-1, 5) for r in rows]


def isolation_scores(df: DataFrame, key: str, trees: list[np.ndarray], features: str = "features",
                     sample_size: int = 256) -> DataFrame:
    """K5 score: 2^(-mean path length / c(sample_size)); higher is more anomalous."""
    norm = _c(sample_size)

    ends = [np.array([_c(size) for size in t[:, 4]]) for t in trees]

    def path(x: np.ndarray, t: np.ndarray, end: np.ndarray) -> np.ndarray:
        at, depth = np.zeros(len(x), int), np.zeros(len(x))
        inner = np.flatnonzero(t[at, 0] >= 0)
        while len(inner):
            node = t[at[inner]]
            left = x[inner, node[:, 0].astype(int)] < node[:, 1]
            at[inner] = np.where(left, node[:, 2], node[:, 3]).astype(int)
            depth[inner] += 1
            inner = inner[t[at[inner], 0] >= 0]
        return depth + end[at]

    def run(batches):
        for pdf in batches:
            x = np.vstack(pdf["x"].to_numpy()).astype(float) if len(pdf) else np.zeros((0, 1))
            mean = sum((path(x, t, end) for t, end in zip(trees, ends)), np.zeros(len(x))) / max(len(trees), 1)
            scores = 2.0 ** (-mean / norm) if norm > 0 else np.zeros(len(x))
            yield pd.DataFrame({"row_key": pdf["row_key"].astype(str), "anomaly_score": scores})

    src = df.select(F.col(key).cast("string").alias("row_key"), vector_to_array(F.col(features)).alias("x"))
    return src.mapInPandas(run, "row_key string, anomaly_score double")
