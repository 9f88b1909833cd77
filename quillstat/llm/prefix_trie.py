"""Conversation prefix trie over padded turn-id matrices (operator 12).

Conversations are range-partitioned by their sequence of turns, so a shard holds
a stretch of the sorted order and equal beginnings stand together, over as many
shards as they need.  A shard numbers its turns, puts the numbers into matrices
padded with zero (bands of ``BAND`` columns, so that one long conversation does
not widen all rows) and sorts them by numpy lexsort.  Masks of changed columns,
OR-accumulated along a row, mark where the node of each depth starts; reduceat
aggregates every depth; sums over subtrees run from the deepest column to the
root.

Only the nodes on the path of a shard's first and of its last conversation can
go on in a neighbouring shard.  They leave the shard as partial rows, and are
put together in rounds of ``FAN`` neighbouring shards: what is no longer on the
first or last path of the stretch is complete.  All other nodes are complete in
their shard, but for the name of a parent on those paths, which is joined by
(shard, node).  A task thus holds a shard, or the two paths of ``FAN`` shards.

The list of conversations that end at a node may be of any length (a common
conversation); its digest is taken from a sorted stream of pieces, never from
the whole list in memory.

Turns are compared by two 64-bit hashes of role and text.  Turns of one
conversation are ordered by number (null first), then role, then the first 60
bits of the MD5 of the text; null role and text are empty strings; repeated
turns are turns of their own.  Rows with a null conv_id are left out; a table
without conversations has no nodes; other columns are ignored.  One
conversation's turns are held in memory together.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstat.session import ship_package

from .shared import stash

#: conversations take up to HEADS - 1 turns of the first of their FAMILY
FAMILY = 5
HEADS = 9
BAND = 16
SHARD_TURNS = 200_000
FAN = 64
PIECE = 1 << 13

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# --- rebuilt conversations -------------------------------------------------

def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and ``turns``, an array of (a, b, n_bytes): each conversation after its family's beginning.

    ``a`` and ``b`` are hashes of role and text.  Texts are hashed before the only shuffle.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    family = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")
    rows = (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
            .select(family, "conv_id", F.struct(
                "turn", "role", F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long").alias("order"),
                F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(12), "text", "role").alias("b"),
                F.octet_length("text").cast("long").alias("n_bytes")).alias("t")))
    # one exchange by family serves the grouping by conversation and the window over the family
    own = (rows.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
           .select("family", "conv_id", F.transform("t", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["n_bytes"].alias("n_bytes"))).alias("own")))
    head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("own", 1, HEADS - 1))).over(Window.partitionBy("family"))
    own = own.withColumn("head", head).withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int"))
    return own.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("own", 1, 0)),
                                          F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1)))).alias("turns"))


# --- a shard ---------------------------------------------------------------

#: node: a complete node; open: its parent is on an edge; edge: a partial node; end: a piece of an edge's list of endings
ROWS = ("kind string, shard int, key binary, parent binary, on_first boolean, on_last boolean, depth long, conv_id long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved long, n_bytes long, ends_sha256 string, piece binary, number long")
_TYPES = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "long": pa.int64()}
_FIELDS = {x.split()[0]: _TYPES[x.split()[1]] for x in ROWS.split(", ")}


def _rows(kind: str, n: int, **columns) -> pa.RecordBatch:
    arrays = []
    for name, t in _FIELDS.items():
        v = kind if name == "kind" else columns.get(name)
        arrays.append(pa.array([v] * n if not hasattr(v, "__len__") or isinstance(v, str | bytes) else v, t, from_pandas=False))
    return pa.RecordBatch.from_arrays(arrays, names=list(_FIELDS))


def _turn_numbers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1, 2, ... for the distinct pairs, in their order."""
    order = np.lexsort((b, a))
    new = np.ones(len(a), np.int64)
    new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    out = np.empty(len(a), np.int64)
    out[order] = np.cumsum(new)
    return out


def _band(ids: np.ndarray, start: np.ndarray, length: np.ndarray, lo: int) -> np.ndarray:
    """Columns lo .. lo + BAND - 1 of the turn-id matrix of some conversations, padded with 0."""
    at = np.arange(lo, lo + BAND)
    inside = at < length[:, None]
    return np.where(inside, ids[np.where(inside, start[:, None] + at, 0)], 0)


def sorted_prefixes(ids: np.ndarray, start: np.ndarray, length: np.ndarray, conv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the conversations by turns, then conv_id, and how many first turns each shares with the one before it."""
    n, deepest = len(conv), int(length.max(initial=0))
    rank = np.zeros(n, np.int64)  # of the turns compared so far
    for lo in range(0, deepest, BAND):
        rows = np.flatnonzero(length > lo)
        matrix = _band(ids, start[rows], length[rows], lo)
        keys = (*matrix.T[::-1], rank[rows])
        order = np.lexsort(keys)
        change = np.ones(len(rows), bool)
        change[1:] = (matrix[order[1:]] != matrix[order[:-1]]).any(1) | (rank[rows][order[1:]] != rank[rows][order[:-1]])
        local = np.zeros(n, np.int64)
        local[rows[order]] = np.cumsum(change)
        rank = np.unique(rank * (len(rows) + 1) + local, return_inverse=True)[1]  # shorter ones (local 0) come first
    order = np.lexsort((conv, rank))
    shared, going = np.zeros(n, np.int64), np.ones(n, bool)
    going[:1] = False
    ordered_start, ordered_length = start[order], length[order]
    for lo in range(0, deepest, BAND):
        rows = np.flatnonzero(going & (ordered_length > lo))
        if not len(rows):
            break
        mine, other = (_band(ids, ordered_start[r], ordered_length[r], lo) for r in (rows, rows - 1))
        changed = np.logical_or.accumulate((mine != other) | (mine == 0), axis=1)
        shared[rows] += (~changed).sum(1)
        going[:] = False
        going[rows] = ~changed[:, -1]
    return order, shared


def _path_keys(a: np.ndarray, b: np.ndarray) -> list[bytes]:
    """Names of the nodes on one conversation's path, the root first."""
    digest = hashlib.blake2b(digest_size=16)
    out = [digest.digest()]
    for x in np.stack([a, b], 1):
        digest.update(x.tobytes())
        out.append(digest.digest())
    return out


def _pieces(ids: np.ndarray) -> list[bytes]:
    step = PIECE // 20
    return [",".join(map(str, ids[k:k + step].tolist())).encode() for k in range(0, len(ids), step)]


def shard_nodes(shard: int, conv: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray, n_bytes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """All nodes of a shard: complete ones, and partial ones for the paths of its first and last conversation."""
    n, start = len(conv), np.concatenate([[0], np.cumsum(length)[:-1]])
    order, shared = sorted_prefixes(_turn_numbers(a, b), start, length, conv)
    conv, length, start = conv[order], length[order], start[order]
    depths, active = [], np.arange(n)
    place = np.zeros(n, np.int64)  # the node of the depth before that holds a conversation
    for depth in range(int(length.max()) + 1):
        active = active[length[active] >= depth]
        first = (shared[active] < depth) | (active == 0) if depth else active == 0
        at = np.flatnonzero(first)
        top = active[at]
        ended = length[active] == depth
        depths.append({
            "start": top, "parent": place[top] if depth else None,
            "conv_id": np.minimum.reduceat(conv[active], at), "n_convs": np.diff(np.append(at, len(active))),
            "n_bytes": n_bytes[start[top] + depth - 1] if depth else np.zeros(1, np.int64),
            "ended": np.add.reduceat(ended.astype(np.int64), at),  # they stand first in their node
            "on_first": np.arange(len(at)) == 0 if active[0] == 0 else np.zeros(len(at), bool),
            "on_last": np.arange(len(at)) == len(at) - 1 if active[-1] == n - 1 else np.zeros(len(at), bool)})
        place = np.zeros(n, np.int64)
        place[active] = np.cumsum(first) - 1
    below = None
    for d in reversed(depths):
        edge = d["on_first"] | d["on_last"]
        children, leaves, saved = (np.zeros(len(edge), np.int64) for _ in range(3))
        if below is not None:
            whole = ~below["edge"]
            np.add.at(children, below["parent"][whole], 1)
            np.add.at(leaves, below["parent"][whole], below["n_leaves"][whole])
            np.add.at(saved, below["parent"][whole], below["saved"][whole])
        d |= {"edge": edge, "n_children": children, "n_leaves": np.where(edge, leaves, leaves + (children == 0)),
              "saved": np.where(edge, saved, saved + (d["n_convs"] - 1) * d["n_bytes"])}
        below = d
    keys = [_path_keys(*(x[start[r]:start[r] + length[r]] for x in (a, b))) for r in (0, n - 1)]
    for depth, d in enumerate(depths):
        key_of = {**({int(np.flatnonzero(d["on_last"])[0]): keys[1][depth]} if d["on_last"].any() else {}),
                  **({0: keys[0][depth]} if d["on_first"].any() else {})}
        at = np.array(sorted(key_of), np.int64)
        if len(at):
            up = [None if not depth else keys[0][depth - 1] if d["on_first"][i] else keys[1][depth - 1] for i in at.tolist()]
            yield _rows("edge", len(at), shard=shard, key=[key_of[i] for i in at.tolist()], parent=up, depth=depth,
                        **{c: d[c][at] for c in ("on_first", "on_last", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "n_bytes")})
            for i in at.tolist():
                pieces = _pieces(conv[d["start"][i]:d["start"][i] + d["ended"][i]])
                if pieces:
                    yield _rows("end", len(pieces), shard=shard, key=key_of[i], piece=pieces, number=np.arange(len(pieces)))
        rest = np.flatnonzero(~d["edge"])
        if len(rest):
            before = depths[depth - 1]
            parent, edges = d["parent"][rest], before["edge"]
            names = {i: (keys[0] if before["on_first"][i] else keys[1])[depth - 1] for i in np.flatnonzero(edges).tolist()}
            ends = [EMPTY_SHA if not e else hashlib.sha256(",".join(map(str, conv[s:s + e].tolist())).encode()).hexdigest()
                    for s, e in zip(d["start"][rest].tolist(), d["ended"][rest].tolist())]
            for kind, pick in (("open", edges[parent]), ("node", ~edges[parent])):
                at = rest[pick]
                if len(at):
                    up = d["parent"][at]
                    yield _rows(kind, len(at), shard=shard, depth=depth, ends_sha256=[e for e, p in zip(ends, pick.tolist()) if p],
                                parent=[names[i] for i in up.tolist()] if kind == "open" else None,
                                parent_conv_id=before["conv_id"][up] if kind == "node" else None,
                                **{c: d[c][at] for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved")})


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [x for x in batches if x.num_rows]
    if parts:
        table = pa.Table.from_batches(parts)
        columns = [table.column(c).combine_chunks() for c in ("a", "b", "n_bytes")]
        length = np.diff(columns[0].offsets.to_numpy())
        flat = [c.flatten().to_numpy() for c in columns]
        yield from shard_nodes(TaskContext.get().partitionId(), table.column("conv_id").to_numpy(), length, *flat)


# --- neighbouring shards ---------------------------------------------------

def _joined(last_round: bool):
    """Task over some neighbouring shards' partial nodes: those that no neighbour can hold become complete ("done")."""
    def join(table: pa.Table) -> pa.Table:
        shard, depth = table.column("shard").to_numpy(), table.column("depth").to_numpy()
        keys = table.column("key").to_pylist()
        names = sorted(set(zip(depth.tolist(), keys)), reverse=True)  # the deepest first
        index = {k: i for i, (_, k) in enumerate(names)}
        node = np.array([index[k] for k in keys])
        count = len(names)
        total = {c: np.zeros(count, np.int64) for c in ("n_convs", "n_children", "n_leaves", "saved")}
        for c, v in total.items():
            np.add.at(v, node, table.column(c).to_numpy())
        least = np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(least, node, table.column("conv_id").to_numpy())
        size, parent = np.zeros(count, np.int64), [None] * count
        size[node] = table.column("n_bytes").to_numpy()
        for i, up in zip(node.tolist(), table.column("parent").to_pylist()):
            parent[i] = up
        first, last = np.zeros(count, bool), np.zeros(count, bool)
        if not last_round:
            first[node[(shard == shard.min()) & table.column("on_first").to_numpy(zero_copy_only=False)]] = True
            last[node[(shard == shard.max()) & table.column("on_last").to_numpy(zero_copy_only=False)]] = True
        edge = first | last
        for i in range(count):  # the paths of FAN shards
            if not edge[i]:
                total["n_leaves"][i] += total["n_children"][i] == 0
                total["saved"][i] += (total["n_convs"][i] - 1) * size[i]
                if parent[i] is not None:
                    up = index[parent[i]]
                    total["n_children"][up] += 1
                    total["n_leaves"][up] += total["n_leaves"][i]
                    total["saved"][up] += total["saved"][i]
        out = _rows("", count, shard=int(shard.min()), key=[k for _, k in names], parent=parent, on_first=first, on_last=last,
                    depth=np.array([d for d, _ in names]), conv_id=least, n_bytes=size, **total)
        return pa.Table.from_batches([out.set_column(0, "kind", pa.array(np.where(edge, "edge", "done").tolist(), pa.string()))])
    return join


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces in, one digest for each key out; a list may go on over any number of batches."""
    schema = pa.schema([("key", pa.binary()), ("ends", pa.string())])
    key, digest = None, None
    for batch in batches:
        done = []
        for k, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(piece)
            else:
                digest.update(b"," + piece)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t.type) for i, t in enumerate(schema)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], schema=schema)


OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(sequences: DataFrame, shards: int | None = None, fan: int = FAN) -> DataFrame:
    """The nodes of the trie of ``sequences`` (conv_id, turns array of (a, b, n_bytes)), columns ``OUT``."""
    spark = sequences.sparkSession
    ship_package(spark)
    rows = stash(sequences, "trie-conversations")
    if shards is None:
        turns = rows.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(turns / SHARD_TURNS))
    names = F.transform("turns", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
    dealt = (rows.withColumn("names", names).repartitionByRange(shards, "names", "conv_id")
             .select("conv_id", "turns.a", "turns.b", "turns.n_bytes"))
    nodes = stash(dealt.mapInArrow(_shard, ROWS), "trie-nodes")

    edges, done, stretch = nodes.where("kind = 'edge'"), None, 1
    most = max(shards, (edges.agg(F.max("shard")).first()[0] or 0) + 1)
    while True:
        stretch *= fan
        put = stash(edges.groupBy(F.floor(F.col("shard") / stretch).alias("stretch")).applyInArrow(_joined(stretch >= most), ROWS), "trie-edges")
        now = put.where("kind = 'done'")
        done = now if done is None else done.unionByName(now)
        if stretch >= most:
            break
        edges = put.where("kind = 'edge'")
    pieces = (nodes.where("kind = 'end'").select("key", "piece", "shard", "number").repartition("key")
              .sortWithinPartitions("key", "shard", "number").select("key", "piece"))
    ends = pieces.mapInArrow(_digests, "key binary, ends string")
    up = done.select(F.col("key").alias("parent"), F.col("conv_id").alias("up"))
    edge_nodes = (done.drop("parent_conv_id", "ends_sha256").join(up, "parent", "left").join(ends, "key", "left")
                  .withColumn("parent_conv_id", F.col("up")).withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY_SHA))))
    # a shard's open nodes get the names of its own edges: the root is many nodes' parent, but of one shard's only so many
    named = nodes.where("kind = 'edge'").select("shard", F.col("key").alias("parent")).join(up, "parent").select("shard", "parent", "up")
    opened = (nodes.where("kind = 'open'").drop("parent_conv_id").join(named, ["shard", "parent"]).withColumn("parent_conv_id", F.col("up")))
    pick = [F.col("saved").alias(c) if c == "saved_tokens" else F.col(c) for c in OUT]
    return nodes.where("kind = 'node'").select(*pick).unionByName(opened.select(*pick)).unionByName(edge_nodes.select(*pick))


def prefix_nodes(conversations: DataFrame, shards: int | None = None, fan: int = FAN) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations."""
    return trie(rebuilt(conversations), shards, fan)


ORACLE_SQL = f"""
WITH crc AS (SELECT [list_reduce([b::UBIGINT] || [0::UBIGINT for z in range(8)], lambda a, z: xor(a >> 1, 3988292384::UBIGINT * (a & 1::UBIGINT))) for b in range(256)] AS t),
own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''),
   ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT conv_id, own, (xor(list_reduce([4294967295::UBIGINT] || [ascii(x)::UBIGINT for x in string_split(conv_id::VARCHAR, '')],
   lambda a, b: xor(a >> 8, t[1 + xor(a & 255::UBIGINT, b)::INT])), 4294967295::UBIGINT) % {HEADS})::INT AS h FROM own, crc),
seqs AS (SELECT c.conv_id, coalesce(f.own[1:c.h], []) || c.own[c.h + 1:] AS s FROM hashed c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % {FAMILY}),
parts AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM seqs),
nodes AS (SELECT d AS depth, s[1:d] AS k, min(conv_id) AS conv_id, count(*) AS n_convs,
   sha256(coalesce(string_agg(CASE WHEN len(s) = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM parts GROUP BY d, s[1:d]),
kids AS (SELECT k[1:depth - 1] AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.k[n.depth].x) END AS own_saved FROM nodes n LEFT JOIN kids c ON n.k = c.k),
ups AS (SELECT k, n_children, own_saved, unnest(range(depth + 1)) AS d FROM full_nodes),
sums AS (SELECT k[1:d] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum(own_saved)::BIGINT AS saved_tokens FROM ups GROUP BY k[1:d])
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON n.k = s.k LEFT JOIN nodes p ON n.depth > 0 AND p.k = n.k[1:n.depth - 1]"""
