"""Operators 1-4, 7, 9, 10 and the pipeline."""

import json
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from quillstat.llm import decontaminate, embed_dedup, lattice_lm, mixing, quality, secret_scan, toolcalls

from .conftest import DOCS
from .test_repeats import words_of


def test_quality_learns_and_scores_all(spark, docs, texts):
    rng = random.Random(5)
    rows = []
    for i in range(1000, 1300):
        good = i % 3 > 0
        rows.append((i, " ".join(rng.choice(["the", "river", "runs", "slow", "and", "wide"]) if good else rng.choice(["$$$", "BUY!!", "xxqz###"]) for _ in range(30)), "en", "s", 1))
    corpus = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(r[0], int(r[0] % 3 > 0)) for r in rows] + [(None, 1), (1000, None)], "doc_id long, quality int")
    got = quality.quality(corpus, labels, sample_per_class=80).collect()
    assert len(got) == 300 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == (r.doc_id % 3 > 0) for r in got if r.held_out) >= 0.97 * sum(r.held_out for r in got)
    scored = quality.score(docs, (np.zeros(quality.BUCKETS, np.float32), 0.0))
    assert scored.count() == len(texts) and {r.score for r in scored.select("score").collect()} == {0.5}
    assert quality.train(corpus, labels.where("false"), "quality")[1] == 0.0


def test_mixing_meets_targets(spark, docs, no_docs):
    assert mixing.mix(no_docs, sweeps=1).count() == 0
    targets = spark.createDataFrame([("source", f"src{k}", 1.0) for k in range(4)] + [("source", "", 2.0), ("source", "absent", 9.0)]
                                    + [("lang", x, 1.0) for x in ("en", "de", "")] + [("topic", t, 1.0) for t in ("brief", "lines", "prose", "long")], "dim string, value string, share double")
    got = mixing.mix(docs, targets, sweeps=5)
    w = {r["_source"]: r["w"] for r in got.groupBy("_source").agg(F.sum(F.col("_weight") * F.col("_tokens")).alias("w")).collect()}
    assert set(w) == {"", "src0", "src1", "src2", "src3"}
    # the only long text is of src3, which the topic targets therefore hold above its share
    assert abs(w[""] / w["src1"] - 2) < 0.2 and abs(w["src0"] / w["src2"] - 1) < 0.1
    assert got.where("_probability < 0 or _probability > 1").count() == 0 and got.count() == docs.count()


def test_mix_keeps_its_budget_beside_a_stray_cell(spark):
    rows = [(i, "word " * (100 if i % 3 else 450), "en" if i % 4 else "de", f"s{i % 2}", 1) for i in range(3000)]
    for corpus in (rows, [*rows, (9999, "a few words " * 5, "ne", "s0", 1)]):
        got = mixing.mix(spark.createDataFrame(corpus, DOCS)).agg(
            F.sum("_tokens").alias("n"), F.sum(F.col("_tokens") * F.col("_probability")).alias("expected"),
            F.sum(F.when(F.col("_sampled"), F.col("_tokens")).otherwise(0)).alias("kept"), F.max("_probability").alias("top")).first()
        assert abs(got.expected / got.n - mixing.KEEP) < 0.001 and abs(got.kept / got.n - mixing.KEEP) < 0.05 and got.top <= 1
    shares = [mixing.mixed(spark.createDataFrame(c, DOCS)).agg(F.avg(F.col("sampled").cast("double"))).first()[0] for c in (rows, corpus)]
    assert abs(shares[0] - shares[1]) < 0.01 * shares[0]
    stray = mixing.mix(spark.createDataFrame(corpus, DOCS)).where("doc_id = 9999").first()
    assert stray["_probability"] == 1 and stray["_sampled"]
    cells = spark.createDataFrame([(10, 0.0), (10, 0.5), (10, 2.0), (10, 8.0)], "tokens long, _weight double")
    for keep, c in ((0.25, 10 / 105), (0.55, 0.48), (0.6, 0.8), (0.6875, 1.5), (1.0, math.inf)):
        assert math.isclose(mixing.scale_of(cells, keep), c)


def test_tool_calls(spark):
    calls = spark.createDataFrame([(1, "b", "add", '{"y": 2.0, "x": 1}', "a", 2), (1, "a", "add", '{"x": 1}', None, 1), (1, "c", "nope", "{", "missing", 3),
                                   (1, "d", "add", '{"x":1,"y":2}', "e", 4), (1, "e", "add", None, "d", 5), (1, "b", "add", "{}", None, 9), (None, "z", "add", "{}", None, 1)],
                                  "conv_id long, call_id string, name string, arguments string, after string, turn long")
    results = spark.createDataFrame([(1, "a", "é\n", 2), (1, "a", "later", 3), (1, "q", "nobody", 3)], "conv_id long, call_id string, content string, turn long")
    schema = {"add": {"type": "object", "required": ["x", "y"], "properties": {"x": {"type": "integer"}, "y": {"type": "integer", "maximum": 2}}, "additionalProperties": False}}
    got = toolcalls.ordered(toolcalls.link_calls(calls, results, schema)).collect()
    assert [(r.call_id, r.level, r.valid, r.has_result) for r in got] == [("a", 0, False, True), ("c", 0, False, False), ("b", 1, True, False), ("d", None, True, False), ("e", None, False, False)]
    assert got[2].json == '{"arguments":{"x":1,"y":2},"id":"b","name":"add","result":null,"valid":true}'
    assert json.loads(got[0].json)["result"] == "é\n"
    odd = {"deep": '{"x":' * 1500 + "1" + "}" * 1500, "deeper": "[" * 3000 + "]" * 3000, "surrogate": '{"x":"\\ud800"}', "digits": '{"x":' + "9" * 400 + "}",
           "huge": '{"x":1e400}', "nan": '{"x":NaN}', "true": '{"x":true}', "one": '{"x":1.0}', "two": '{"x":2}', "many": '{"x":' + "9" * 5000 + "}"}
    table = spark.createDataFrame([(1, k, "pick", v, None, 1) for k, v in odd.items()], calls.schema)
    got = {r.call_id: r for r in toolcalls.link_calls(table, results.where("false"), {"pick": {"type": "object", "properties": {"x": {"enum": [1, None]}}}, }).collect()}
    assert {k for k, r in got.items() if r.valid} == {"one"} and len(got) == len(odd)
    assert all(json.loads(r.json)["arguments"] is None for k, r in got.items() if k in ("deep", "deeper", "surrogate", "huge", "nan", "many"))
    assert json.loads(got["digits"].json)["arguments"]["x"] == int("9" * 400) and json.loads(got["true"].json)["arguments"] == {"x": True}
    chain = spark.createDataFrame([(7, str(k), "n", "{}", str(k - 1), k) for k in range(37)], calls.schema)
    assert sorted(r.level for r in toolcalls.levels(chain).collect()) == list(range(37))
    assert toolcalls.link_calls(calls.where("false"), results, schema).count() == 0


def test_decontamination_is_exact(spark, docs, texts, no_docs):
    rng = random.Random(8)
    long = texts[115].split()
    items = {1: " ".join(long[500:540]), 2: " ".join(long[10:30]).upper(), 3: "quite new words that nobody wrote here", 4: "", 5: None, 6: "one",
             7: " ".join(long[700:740] + ["other", "words", "follow"]), 8: " ".join(rng.sample(long, 40)),
             9: " ".join(long[800:803]), 10: "a a", 11: " ".join(long[900:904])}
    table = spark.createDataFrame([*items.items(), (None, "x"), (1, "~repeated row")], "item_id long, text string")
    fold = lambda t: tuple("".join(c if c.isalnum() else " " for c in (t or "").lower()).split())
    grams = lambda w, n: {w[k:k + n] for k in range(len(w) - n + 1)} if n else set()
    want = set()
    for i, t in texts.items():
        for j, item in items.items():
            n = min(5, len(fold(item)))
            own, need = grams(fold(t), n), grams(fold(item), n)
            if need and len(need & own) >= 0.8 * len(need):
                want.add((i, j, len(need), len(need & own)))
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in decontaminate.contaminated(docs, table, block_bytes=300).collect()}
    assert got == want and {(115, 1), (115, 2), (115, 7), (112, 6), (115, 9), (113, 10), (115, 11)} <= {x[:2] for x in want}
    assert decontaminate.contaminated(no_docs, table).count() == 0
    assert decontaminate.clean_documents(docs, table.where("false")).count() == len(texts)


def test_embedding_links_are_exact(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((12, 20))
    rows = []
    for i in range(300):
        x = centre[i % 12] + rng.standard_normal(20) * (0.3 if i % 5 else 0.05)
        rows.append((i, [float(v) for v in x.astype(np.float32)], i % 2 if i % 11 else None))
    rows += [(300, rows[0][1], rows[0][2]), (301, None, 1), (302, [0.0] * 20, 1), (303, [float("nan")] * 20, 1), (304, [1.0, 2.0], 1), (305, [None] * 20, 0), (306, rows[2][1], 0)]
    vectors = {i: np.array(x, float) for i, x, label in rows if x and None not in x and np.isfinite(x).all() and np.any(x)}
    label = {i: y for i, _, y in rows}
    link = {i: {j for j in vectors if i in vectors and j != i and label[i] is not None and label[i] == label[j] and len(vectors[i]) == len(vectors[j])
                and vectors[i] @ vectors[j] / math.sqrt((vectors[i] @ vectors[i]) * (vectors[j] @ vectors[j])) >= 0.93} for i in label}
    want = {}
    for i in label:
        reach, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        want[i] = (len(link[i]), min(reach), min(reach) == i)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for rows_of_a_block in (embed_dedup.ROWS, 9):  # whole cells, and cells split into pairs of blocks
        monkeypatch.setattr(embed_dedup, "ROWS", rows_of_a_block)
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_vectors(table).collect()}
        assert got == want and sum(len(x) for x in link.values()) > 100
    assert embed_dedup.near_vectors(table.where("false")).count() == 0


def test_secrets(spark, no_docs):
    rng = random.Random(2)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for i in range(120):
        rows.append((i, f"some plain words password={hexes(18)} and AKIA{''.join(rng.choice('ABCDEFGH234567') for _ in range(16))} é end", "en", "s", 1))
        rows.append((1000 + i, f"call {rng.randrange(10**15, 10**16)} or see https://example.org/some/long/path/{hexes(6)} for someinternationalization", "en", "s", 1))
    rows += [(5000, None, "en", "s", 0), (5001, "", "en", "s", 0), (None, "password=0123456789abcdef00", "en", "s", 1)]
    table = spark.createDataFrame(rows, DOCS)
    got = secret_scan.scan(table).collect()
    assert all(r.is_secret == (r.doc_id is None or r.doc_id < 1000) for r in got) and sum(r.is_secret for r in got) == 241
    clean = {r.doc_id: r for r in secret_scan.redact(table).collect()}
    assert len(clean) == len(rows) and clean[5000].text is None and clean[3].text == "some plain words password=[SECRET] and [SECRET] é end"
    assert clean[3].n_chars == len(clean[3].text) and clean[1003].text == dict((r[0], r[1]) for r in rows)[1003]
    assert secret_scan.scan(no_docs).count() == 0


def test_values_after_names_are_masked_whole(spark):
    values = ["hunter2!9", "correcthorsebatterystaple", "qwmzkrtpvbxnalcd", "S3cr3t!Pass#2024", "a.b$c%9Z", "grüße!77"]
    rows = [(i, f"the plain words {lead}{v} stand in a line", "en", "s", 1) for i, (lead, v) in enumerate((lead, v) for lead in ("password=", "token: ", "DB_PASSWORD = ") for v in values)]
    n = len(rows)
    rows += [(100, 'config {"auth":{"token":"x9!k2","user":"joe"}} here', "en", "s", 1), (101, "the password:", "en", "s", 1), (102, "first of the next text", "en", "s", 1),
             (103, "a token bucket and a pass through the secret garden; note: plain words, see https://example.org/some/path", "en", "s", 1)]
    clean = {r.doc_id: r.text for r in secret_scan.redact(spark.createDataFrame(rows, DOCS)).collect()}
    lead = {r[0]: r[1].split(next(v for v in values if v in r[1]))[0] for r in rows[:n]}
    assert {i: clean[i] for i in range(n)} == {i: lead[i] + "[SECRET] stand in a line" for i in range(n)}
    assert clean[100] == 'config {"auth":{"token":"[SECRET]","user":"joe"}} here'
    assert all(clean[i] == dict((r[0], r[1]) for r in rows)[i] for i in (101, 102, 103))


def test_lattice_sums_all_segmentations():
    pieces = sorted([b"a", b"b", b"ab", b"\x01a", b"\x01", b"bab"])
    logp = np.log(np.arange(1, 7) / 21)
    lattice = lattice_lm.Lattice(pieces, logp)

    def brute(w):
        return 1.0 if not w else sum(math.exp(logp[k]) * brute(w[len(p):]) for k, p in enumerate(pieces) if w.startswith(p))

    words = [b"\x01ab", b"\x01abab", b"\x01b", b"\x01aab"]
    assert np.allclose(np.exp(lattice.marginals(words)), [brute(w) for w in words])
    uses, likelihood = lattice.expected([b"\x01ab"], np.array([2]))
    assert math.isclose(likelihood, 2 * math.log(brute(b"\x01ab")))
    by = dict(zip(pieces, uses))
    ways = {(b"\x01a", b"b"): 0, (b"\x01", b"ab"): 0, (b"\x01", b"a", b"b"): 0}
    for way in ways:
        ways[way] = math.exp(sum(logp[pieces.index(p)] for p in way))
    assert math.isclose(by[b"ab"], 2 * ways[(b"\x01", b"ab")] / sum(ways.values()))


def test_lattice_of_long_words_and_side_by_side(monkeypatch):
    """A word alone, among many of its length, or cut into blocks has one probability and the same uses."""
    rng = random.Random(8)
    pieces = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 20))) for _ in range(300)} | {b"a", b"b", b"c", b"\x01"})
    lattice = lattice_lm.Lattice(pieces, np.log(np.full(len(pieces), 1 / len(pieces))))
    words = [b"\x01" + bytes(rng.choice(b"abc") for _ in range(99)) for _ in range(40)]
    counts = np.arange(1, 41)
    many, (uses, ll) = lattice.marginals(words), lattice.expected(words, counts)
    monkeypatch.setattr(lattice_lm, "BLOCK", 16)
    assert np.allclose([lattice.marginals([w])[0] for w in words], many)
    single = [lattice.expected([w], np.array([n])) for w, n in zip(words, counts)]
    assert np.allclose(sum(u for u, _ in single), uses) and math.isclose(sum(x for _, x in single), ll)


def test_lattice_keeps_all_pieces_and_settles(spark):
    pieces, logp = lattice_lm.read_pieces()
    assert max(map(len, pieces)) > 16 and math.isclose(np.exp(logp).sum(), 1)
    lattice = lattice_lm.Lattice(pieces, logp)
    words = spark.createDataFrame([(w.encode(), n) for w, n in (("river", 50), ("rivers", 20), ("running", 30), ("run", 70), ("xqzv", 1))], "word binary, n long")
    fitted, course = lattice_lm.fit_pieces(words, lattice, logp, spark.sparkContext.broadcast(lattice), 1e-4)
    assert all(b >= a for a, b in zip(course, course[1:])) and len(course) > 2 and math.isclose(np.exp(fitted).sum(), 1)
    assert lattice.weigh(fitted).marginals([b"\x01river"])[0] > lattice.weigh(logp).marginals([b"\x01river"])[0]


def test_lattice_scores(spark, docs, texts, no_docs, monkeypatch):
    monkeypatch.setattr(lattice_lm, "HEAD", 40)
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    tokens = {i: [w.translate(low) for w in words_of(t)] + [None] for i, t in texts.items()}
    count = {}
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for w in t:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    got = {r.doc_id: r for r in lattice_lm.lattice_scores(docs).collect()}
    for i, t in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(t), sum(w in count for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r.score < 0
    assert got[112].score == got[116].score and got[110].score == got[111].score
    assert lattice_lm.lattice_scores(no_docs).count() == 0


def test_pipeline(spark, small_dir):
    import corpus_pipeline
    from quillstat.llm.shared import stash
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stash(stage(spark, docs, small_dir), "test")
        assert out.columns[:len(columns)] == columns and (k == len(corpus_pipeline.STAGES) - 1 or out.columns == columns)
        assert 0 < out.count() <= before
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert {r.doc_id for r in out.select("doc_id").collect()} <= ids
        docs, before = out, out.count()


def test_stages_judge_every_row_by_itself(spark, small_dir):
    """Null and repeated doc_id, clashing columns: copies, benchmark passages and secrets go all the same."""
    import corpus_pipeline
    from quillstat.llm import jaccard
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    prose = " ".join(f"w{k}" for k in range(40))
    rows = [(None, "here are one two three four five six seven eight nine ten words"), (None, prose), (None, prose), (5, prose), (5, "another text of the same number"),
            (6, prose + " more"), (None, None), (None, "password=hunter2!9x"), (7, "password=0123456789abcdef00"), (7, "clean text"), (8, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    for c in ("_gone", "_id", "_spans", "_tokens", "_weight", "score", "row", "rest", "class_id", "a.b"):
        docs = docs.withColumn(c, F.lit(c))
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns and sorted(str(r.text) for r in clean.collect()) == sorted(str(t) for _, t in rows[1:])
    kept = jaccard.keep_one(docs)
    texts = [r.text for r in kept.collect()]
    assert kept.columns == docs.columns and texts.count(prose) + texts.count(prose + " more") == 1 and len(texts) == len(rows) - 3
    masked = secret_scan.redact(docs)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    assert not any(s in str(r.text) for r in masked.collect() for s in ("hunter2", "0123456789abcdef00")) and masked.where("_spans = '_spans'").count() == len(rows)
    for name, stage in (corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[4]):
        out = stage(spark, docs, small_dir)
        assert out.columns[:len(docs.columns)] == docs.columns and out.where("score = 'score' and _tokens = '_tokens'").count() == out.count()
        assert stage(spark, docs.where("false"), small_dir).count() == 0
