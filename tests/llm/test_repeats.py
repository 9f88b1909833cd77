"""Operators 5, 6 and 8 against brute force."""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from quillstat.llm import block_dedup, jaccard, suffix_dedup

from .conftest import DOCS, sha

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(t):
    return WORD.findall((t or "").encode())


def test_block_dedup_is_exact(docs, texts):
    first, want = {}, {}
    for i in sorted(texts):
        w = words_of(texts[i])
        gone = set()
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k:k + 13]), i) < i:
                gone.update(range(k, k + 13))
        want[i] = (len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone)))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in block_dedup.remove_repeats(docs).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 500


def test_suffix_dedup_is_exact(docs, texts):
    first, want = {}, {}
    for i in sorted(texts):
        b = (texts[i] or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first.setdefault(b[k:k + 50], i) < i:
                gone[k:k + 50] = True
        runs = len(re.findall(b"\x01+", gone.tobytes()))
        want[i] = (len(b), int(gone.sum()), runs, sha(np.frombuffer(b, np.uint8)[~gone].tobytes()))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 3000


def test_a_bucket_sends_each_distinct_span_once():
    """A rule line and a passage in every document of a bucket, and the windows removed from each of them."""
    rng = np.random.default_rng(7)
    rows = {i: b"-" * 80 + b"\n" + bytes(rng.integers(97, 123, 60, dtype=np.uint8)) + b"\n" + b"the same sentence of more than fifty bytes stands in each document" for i in range(100)}
    table = pa.table({"doc_id": list(rows), "text": [t.decode() for t in rows.values()], "bucket": pa.array([3] * len(rows), pa.int32())})
    offered = suffix_dedup._sampled(4)(table)
    answers = pa.concat_tables([suffix_dedup.common(need_mark=False)(offered.filter(pc.equal(offered["shard"], s))) for s in pc.unique(offered["shard"]).to_pylist()])
    sent = suffix_dedup._spans(4)(table, answers)
    spans = [x for r in sent.to_pylist() for x in np.frombuffer(r["keys"], np.uint64).tolist()]
    assert len(spans) == len(set(spans)) and sum(len(r["windows"]) for r in sent.to_pylist()) < 15 * len(rows)
    judged = pa.concat_tables([suffix_dedup._judged(sent.filter(pc.equal(sent["shard"], s))) for s in pc.unique(sent["shard"]).to_pylist()])
    first, got = {}, {r["doc_id"]: r for r in suffix_dedup._removed(table, judged).to_pylist()}
    for i, b in rows.items():
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first.setdefault(b[k:k + 50], i) < i:
                gone[k:k + 50] = True
        assert (got[i]["n_removed"], got[i]["kept_sha256"]) == (int(gone.sum()), sha(np.frombuffer(b, np.uint8)[~gone].tobytes()))


def test_log_family_merges_geometrically():
    family = suffix_dedup.LogFamily()
    seen = {}
    rng = np.random.default_rng(1)
    for batch in range(20):
        keys, docs = rng.integers(0, 500, 50).astype(np.uint64), np.full(50, batch)
        late = family.judge(keys, docs)
        assert late.tolist() == [seen.get(int(k), batch) < batch for k in keys]
        for k in keys:
            seen.setdefault(int(k), batch)
        assert len(family.levels) <= 7


def test_long_texts_are_cut_with_overlap(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 100)
    text = bytes(np.random.default_rng(2).integers(97, 123, 1234, dtype=np.uint8))
    windows = []
    for rows, offs, parts in suffix_dedup.pieces([text]):
        _, offset, _, start, count = suffix_dedup.anchors(parts)
        piece = np.searchsorted(offset, start, "right") - 1
        for s, c, p in zip(start, count, piece):
            windows += [int(s - offset[p] + offs[p]) + k for k in range(c)]
    assert sorted(windows) == list(range(1234 - 49))


def sets_of(texts):
    out = {}
    for i, t in texts.items():
        w = words_of(t)
        out[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def test_jaccard_classes_are_exact(docs, texts):
    sets = sets_of(texts)
    link = {i: {j for j in sets if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} for i in sets}
    want = {}
    for i in sets:
        reach, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        want[i] = (min(reach), len(link[i]))
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_classes(docs).collect()}
    assert got == want
    kept = {r.doc_id for r in jaccard.keep_one(docs).collect()}
    assert kept == {i for i in want if want[i][0] == i}


def test_groups_larger_than_a_block(spark, monkeypatch):
    """A near-copy group over many blocks: workers see the module's own BLOCK, in_blocks the small one."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    base = [f"w{k}" for k in range(100)]
    rows = [(i, " ".join([*base[:k], f"new{i}", *base[k + 1:]]), "en", "s", 1) for i, k in enumerate(range(20, 50))]
    got = jaccard.jaccard_classes(spark.createDataFrame(rows, DOCS)).collect()
    sets = sets_of({r[0]: r[1] for r in rows})
    for r in got:
        links = [j for j in sets if j != r.doc_id and len(sets[j] & sets[r.doc_id]) >= 0.8 * len(sets[j] | sets[r.doc_id])]
        assert (r.class_id, r.n_links) == (0, len(links))


def test_bayes_table_keeps_what_can_reach_the_threshold():
    need = jaccard.min_matches()
    n = np.arange(jaccard.STEP, jaccard.HASHES + 1, jaccard.STEP)
    assert (need < 0.8 * n).all() and (np.diff(need) > 0).all() and need[-1] > 0.5 * n[-1]


@pytest.mark.parametrize("operator", [block_dedup.remove_repeats, suffix_dedup.remove_repeats, jaccard.jaccard_classes])
def test_empty_null_and_repeated(spark, no_docs, operator):
    assert operator(no_docs).count() == 0
    rows = spark.createDataFrame([(None, "a b", "en", "s", 1), (5, "b", None, None, None), (5, "a", "en", "s", 1), (6, None, "en", "s", 0)], DOCS)
    assert sorted(r.doc_id for r in operator(rows).collect()) == [5, 6]
