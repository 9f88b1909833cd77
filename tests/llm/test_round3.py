"""Operators 11-13 against brute force, with null, empty, long, tied, repeated and clashing input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstat.llm import language_id, prefix_trie, spelling

from .conftest import DOCS


# --- operator 13 -------------------------------------------------------------

def near_by_hand(a: str, b: str) -> bool:
    """One inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_hand(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    out = {}
    for w, k in n.items():
        near = sorted((v for v in n if near_by_hand(w, v)), key=lambda v: (-n[v], v))
        form = near[0] if near and n[near[0]] >= 5 * k else None
        out[w] = (form, k, len(near), n[form] if form else None)
    root = {}
    for w in out:
        at = w
        while out[at][0]:
            at = out[at][0]
        root[w] = at
    return {(w, f, root[w], k, m, fn) for w, (f, k, m, fn) in out.items()}


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(13)
    base = ["aabbcc", "letters", "lettters", "Änderung", "änderung", "strasse", "straße", "aaaaaa", "aaaaaaa", "bananas", "banana", "abcdef", "bbcdef"]
    words = list(base)
    for w in base:
        for _ in range(14):
            k = rng.randrange(len(w) + 1)
            words.append(rng.choice([w[:k] + rng.choice("abtÿ×") + w[k:], w[:k] + w[k + 1:], w[:k] + rng.choice("abtÀ") + w[k + 1:]]))
    rows = []
    for i in range(400):
        rows.append((i, " ".join(rng.choices(words, weights=[40 // (1 + k % 9) ** 2 + 1 for k in range(len(words))], k=60)) + "1x,y"))
    rows += [(3, "letters " * 50), (3, "letters " * 50), (None, "letters Bananas\tBANANAS"), (None, None), (500, ""), (501, "z" * 9000), (502, "strasse " * 20000)]
    return rows


def test_variants_equal_brute_force(spark, misspelt):
    table = spark.createDataFrame(misspelt, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(0)).repartition(5)
    got = [tuple(r) for r in spelling.variants(table).collect()]
    want = variants_by_hand(misspelt)
    assert set(got) == want and len(got) == len(want)
    assert len({w for w, f, *_ in want if f}) > 20 and any(r != f for _, f, r, *_ in want if f)
    assert spelling.variants(table.where("false")).count() == 0 and spelling.variants(table.where("text is null")).count() == 0


def test_rotations_file_every_word_under_its_prefixes(spark):
    got = {(r.prefix, r.whole, r["first"]) for r in spelling.rotations(spark.createDataFrame([("abb", 7)], "word string, n long")).collect()}
    assert got == {("abb$", True, False), ("bb$a", True, False), ("b$ab", True, False), ("$abb", True, False),
                   ("bb$", False, True), ("b$a", False, True), ("$ab", False, False)}


# --- operator 12 -------------------------------------------------------------

def trie_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", int(hashlib.md5((text or "").encode()).hexdigest()[:15], 16), text or ""))
    own = {c: [(r, x) for _, r, _, x in sorted(t)] for c, t in own.items()}
    full = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + t[h:]
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    return Counter((m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(str(c) for c in m if len(full[c]) == len(k)).encode()).hexdigest()) for k, m in members.items())


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(12)
    rows, texts = [], ["hi", "yes", "no", "é", "", None]
    for c in range(-11, 160):
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t % 3 else "user", texts[0] if t == 0 else rng.choice(texts)))
    for c in range(200, 300):  # one very common conversation
        rows += [(c, 0, "user", "hi"), (c, 1, "assistant", "hello"), (c, 2, "user", "bye")]
    rows += [(310, t, "user", f"turn {t % 7}") for t in range(120)] + [(311, t, "user", f"turn {t % 7}") for t in range(119)]
    rows += [(320, None, None, "first"), (320, None, "user", None), (320, 3, "user", "x"), (320, 3, "user", "x"), (320, 3, "user", "a"), (None, 1, "user", "lost"),
             (330, 0, "user", "long " * 50000), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("shards,fan", [(1, 64), (7, 2), (60, 3), (None, 64)])
def test_trie_equals_brute_force(spark, talks, shards, fan):
    table = (spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").repartition(4)
             .withColumn("key", F.lit("clash")).withColumn("depth", F.lit(0)).withColumn("n_convs", F.lit(1)))
    got = Counter(tuple(r) for r in prefix_trie.prefix_nodes(table, shards, fan).collect())
    assert got == trie_by_hand(talks)
    if shards == 1:
        assert prefix_trie.prefix_nodes(table.where("false")).count() == 0


def test_prefix_lengths_of_sorted_rows():
    rng = random.Random(2)
    for _ in range(20):
        rows = [tuple(rng.randint(1, 2) for _ in range(rng.choice([0, 1, 3, 17, 40]))) for _ in range(30)]
        rows += [rows[0] + (1,) * 20, rows[1]]
        length = np.array([len(r) for r in rows])
        start = np.concatenate([[0], np.cumsum(length)[:-1]])
        order, shared = prefix_trie.sorted_prefixes(np.array([x for r in rows for x in r]), start, length, np.arange(len(rows)))
        assert [(rows[i], i) for i in order] == sorted((r, i) for i, r in enumerate(rows))
        for k in range(1, len(rows)):
            a, b = rows[order[k - 1]], rows[order[k]]
            assert shared[k] == next((d for d, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


# --- operator 11 -------------------------------------------------------------

def grams_by_hand(text):
    """Blank-edged n-grams of one text, as (n, characters)."""
    s = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    out = Counter()
    for n in (1, 2, 3):
        for k in range(len(s) - n + 1):
            g = s[k:k + n]
            if " " not in g[1:-1] and g.strip() and not (n > 1 and g[-1] == " " and g[0] == " "):
                out[g] += 1
    return out


def bucket_by_hand(g):
    h = 0
    for c in g:
        h = (h * 0x9E3779B1 + ord(c)) % 2 ** 32
    h = (h + len(g)) % 2 ** 32
    h ^= h >> 15
    h = h * 0x85EBCA6B % 2 ** 32
    return (h ^ h >> 13) % language_id.BUCKETS


def test_gram_counts_equal_brute_force(monkeypatch):
    texts = ["Straße, öl 12!", "", "a", "  b  ", "éé-éé", "123", "the quick brown fox " * 30]
    row, bucket, n = language_id.counts(texts)
    want = Counter()
    for i, t in enumerate(texts):
        for g, k in grams_by_hand(t).items():
            want[i, bucket_by_hand(g)] += k
    assert dict(zip(zip(row.tolist(), bucket.tolist()), n.tolist())) == dict(want)
    monkeypatch.setattr(language_id, "PIECE", 37)  # a long text scanned in pieces
    _, bucket, n = language_id.counts(texts[-1:])
    assert dict(zip(bucket.tolist(), n.tolist())) == {b: k for (i, b), k in want.items() if i == len(texts) - 1}


@pytest.fixture(scope="module")
def tongues():
    rng = random.Random(11)
    words = {"aa": ["kala", "talo", "sauna", "koti"], "bb": ["strøm", "være", "gård", "ikke"], "cc": ["quiet", "thing", "which", "though"]}
    rows = []
    for i in range(400):
        lang = ("aa", "bb", "cc", "cc")[i % 4]
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(2, 30))), lang, "s", 1))
    rows += [(1000, None, "aa", "s", 1), (1001, "", "bb", "s", 1), (1002, "12 !?", "cc", "s", 1), (1003, "quiet thing " * 40000, None, "s", 1), (None, "kala talo", None, "s", 1),
             (1005, "жжж щщщ", None, "s", 1), (7, "kala talo sauna", "aa", "s", 1), (7, "kala talo sauna", "aa", "s", 1), (None, "ikke", "bb", "s", 1)]
    return rows


def test_languages(spark, tongues, no_docs):
    table = spark.createDataFrame(tongues, DOCS).repartition(3)
    got = language_id.languages(table).collect()
    assert len(got) == len(tongues)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == lang for i, _, lang, *_ in tongues[:400] if i != 7)
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "cc"] and by_id[1000].score == 0
    assert by_id[1005].rejected and not by_id[1003].rejected
    assert Counter(r.lang_pred for r in got if r.doc_id == 7) == {"aa": 2, "cc": 1}
    assert language_id.languages(no_docs).count() == 0
    assert {(r.lang_pred, r.score, r.rejected) for r in language_id.languages(table.withColumn("lang", F.lit(None).cast("string"))).collect()} == {("und", 0.0, True)}


def test_answers_equal_brute_force_over_blocks(spark, tongues, monkeypatch):
    table = spark.createDataFrame(tongues, DOCS).repartition(3).withColumn("row", F.lit(1)).withColumn("score", F.lit("clash"))
    model = language_id.train(table.where("doc_id % 2 = 0"))
    texts = [t for i, t, lang, *_ in tongues if i is not None and i % 2 == 0 and lang]
    df = Counter(b for t in texts for b in {bucket_by_hand(g) for g in grams_by_hand(t or "")})
    for b in range(0, language_id.BUCKETS, 7):
        assert math.isclose(model.idf[b], math.log((1 + len(texts)) / (1 + df[b])) + 1)
    centres = [(r.lang, np.frombuffer(r.centre, np.float32).astype(float)) for r in model.table.collect()]
    want = Counter()
    for i, t, *_ in tongues:
        v = np.zeros(language_id.BUCKETS)
        for g, k in grams_by_hand(t or "").items():
            v[bucket_by_hand(g)] += k
        v = np.where(v > 0, 1 + np.log(np.maximum(v, 1)), 0) * model.idf
        minus, lang = min((-float(v @ c) / np.linalg.norm(v), name) for name, c in centres) if v.any() else (0.0, "und")
        want[i, lang, round(min(-minus, 1.0), 6) + 0.0] += 1
    for limit in (64 << 20, 1):  # all languages at once, and one after another
        monkeypatch.setattr(language_id, "MODEL_BYTES", limit)
        out = language_id.identify(table, model)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "lang_pred", "score", "rejected"]
        assert Counter((r.doc_id, r.lang_pred, round(r.score, 6)) for r in out.collect()) == want


def test_sample_is_bounded_and_whole(spark):
    rows = [(i, f"text {i}", "aa" if i % 3 else "bb", "s", 1) for i in range(300)] + [(5, "text 5", "aa", "s", 1)] * 40
    picked = language_id.sample(spark.createDataFrame(rows, DOCS), 30).collect()
    assert Counter(r.lang for r in picked) == {"aa": 30, "bb": 30} and len({r.text for r in picked}) == 60
