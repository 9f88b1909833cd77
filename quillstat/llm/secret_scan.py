"""Secret scans with a random forest against false positives (operator 9).

Candidates are runs of 12 or more characters ``[A-Za-z0-9+/_-]`` in a text that
hold a digit or, after the first character, a capital letter (runs of capitals
alone from 16 characters), and the whole value, any characters but spaces from
``LEAST`` on, that follows an assignment or a name that speaks of secrets (less
the punctuation at its end; to the closing quote if it is quoted).  Of equal
spans one stands; overlapping ones are reported each and masked together.  Each
has the features named by the method:

* length, and the share of digits, capitals and hexadecimal digits;
* character transitions: the share of neighbouring characters that change class
  (small, capital, digit, sign), and the entropy of the characters;
* dictionary coverage: the share of its letter trigrams that occur in the words
  of the text around it (whatever the language, a random string does not look
  like its surroundings);
* path: whether it stands in a path, address or mail name, and how many slashes and dots touch it;
* neighbouring words: whether the word before, or the name it is assigned to,
  speaks of secrets, and whether it is quoted or assigned.

A random forest (Spark's, ``TREES`` trees of depth ``DEPTH``) learns from
labelled findings.  Without findings of one's own, ``known_findings`` labels
those candidates for which a published format or a check digit decides, and
``EXAMPLES`` adds passwords and harmless values in the form of short sentences;
the rest are scored by the forest alone.  Training reads at most ``SAMPLE`` labelled
findings of each kind (those of smallest hash); scanning and scoring cover
every candidate of every text.

Edge cases: a null or empty text has no candidate; a null doc_id is scanned and
reported as null; repeated rows are reported each; if labelled findings of one
kind are missing, the score of every candidate is the share of the other (own
labels; ``EXAMPLES`` has both kinds); an empty table gives no rows.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.session import ship_package

from .shared import numbered, stash
from .textscan import SPACE, as_bytes, column, slices

TREES = 24
DEPTH = 6
SAMPLE = 8000
SECRET_AT = 0.5
MASK = "[SECRET]"
AROUND = 200
#: characters of a value after a name or an assignment
LEAST = 4

_NAMES = rb"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer|private[_-]?key)"
_NAMED = re.compile(_NAMES + rb"[\"']?\s*(?:[=:]|=>)?\s*[\"']?$", re.I)
_ASSIGNED = re.compile(rb"(?:[=:]|=>)\s*[\"']?$")
#: what a value follows; texts are told apart by a zero byte, which no space pattern takes
_AFTER_NAME = re.compile(_NAMES + rb"[\"']?\s*(?:=>|[=:])\s*(?:[\[{(]+(?=[\"']))?|(?<![A-Za-z0-9])" + _NAMES + rb"[\"']?\s+(?![=:])", re.I)
_AFTER_SIGN = re.compile(rb"(?:=>|[=:])\s*(?:[\[{(]+(?=[\"']))?")
#: to the closing quote, or to a space or the next assignment of a list
_VALUE = re.compile(rb"\"[^\"\n\x00]+(?=\")|'[^'\n\x00]+(?=')|(?:(?![,;&][\"']?[A-Za-z_][\w.\-]{0,99}[\"']?[=:])[^\s\x00])+")
_END = b".,;:)]}>\"'"
FEATURES = ["f_length", "f_digits", "f_capitals", "f_hex", "f_turns", "f_entropy", "f_dictionary", "f_path", "f_signs", "f_named", "f_assigned", "f_quoted"]

_CLASS = np.full(256, 3, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_LONG = np.zeros(256, bool)
_LONG[[*range(48, 58), *range(65, 91), *range(97, 123), 43, 47, 95, 45]] = True


def describe(text: bytes, a: int, b: int) -> list[float]:
    """The features of the candidate text[a:b]."""
    run, before, after = text[a:b], text[max(0, a - AROUND):a], text[b:b + AROUND]
    kind = _CLASS[np.frombuffer(run, np.uint8)]
    n = len(run)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(run).values())
    letters = run.lower()
    grams = [letters[i:i + 3] for i in range(n - 2) if letters[i:i + 3].isalpha()]
    nearby = (before.rpartition(b" ")[0] + b" " + after.partition(b" ")[2]).lower()
    touch = text[max(0, a - 1):a] + text[b:b + 1]
    word = before.split(b" ")[-1] + run + after.split(b" ")[0]
    return [float(n), float((kind == 2).mean()), float((kind == 1).mean()), sum(c in b"0123456789abcdefABCDEF" for c in run) / n,
            float((kind[1:] != kind[:-1]).mean()), entropy, sum(g in nearby for g in grams) / max(1, n - 2),
            float(b"://" in word or b"@" in word or word.count(b"/") > 1), float(run.count(b"/") + sum(c in b"./\\@" for c in touch)),
            float(bool(_NAMED.search(before[-40:]))), float(bool(_ASSIGNED.search(before[-4:]))),
            float(before[-1:] in (b'"', b"'") and after[:1] == before[-1:])]


def runs(text: bytes) -> Iterator[tuple[int, int]]:
    """Byte spans of the long words that look like no plain word.  Long words are found by numpy, only they meet the pattern."""
    b = np.frombuffer(text, np.uint8)
    inside = _LONG[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    keep = end - start >= 12
    for a, z in zip(start[keep].tolist(), end[keep].tolist()):
        run = text[a:z]
        capitals = any(65 <= c <= 90 for c in run[1:])
        if any(48 <= c <= 57 for c in run) or (capitals and (not run.isupper() or z - a >= 16)):
            yield a, z


def values(text: bytes) -> Iterator[tuple[int, int]]:
    """Byte spans of the values after a name that speaks of secrets, and of those after any assignment."""
    for follows in (_AFTER_NAME, _AFTER_SIGN):  # each takes up after its last value, so that no byte is read for ever new values
        at = 0
        while found := follows.search(text, at):
            at = found.end()
            if value := _VALUE.match(text, at):
                a, at = value.span()
                z, quote = at, text[a:a + 1]
                a += quote in (b'"', b"'")
                if quote not in (b'"', b"'") or text[z:z + 1] != quote:
                    z = a + len(text[a:z].rstrip(_END))
                if len(text[a:z].decode("utf-8", "replace")) >= LEAST:
                    yield a, z


def candidates(text: bytes) -> list[tuple[int, int]]:
    """Byte spans of the candidates, in order."""
    return sorted({*runs(text), *values(text)})


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start_byte", T.LongType()), T.StructField("end_byte", T.LongType()),
                       T.StructField("finding", T.StringType()), *[T.StructField(f, T.DoubleType()) for f in FEATURES]])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.float64()] * len(FEATURES)]
    for batch in batches:
        ids, texts, out = column(batch, "doc_id").to_pylist(), as_bytes(column(batch, "text")), []
        for lo, hi in slices(texts):
            start = np.cumsum([0] + [len(t) + 1 for t in texts[lo:hi]])
            whole = b"\0".join(texts[lo:hi])
            spans = candidates(whole)
            rows = np.searchsorted(start, [a for a, _ in spans], "right") - 1
            for (a, z), r in zip(spans, rows.tolist()):
                text, o = texts[lo + r], int(start[r])
                out.append((ids[lo + r], a - o, z - o, whole[a:z].decode("utf-8", "replace"), *describe(text, a - o, z - o)))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=SCHEMA.names)


def findings(docs: DataFrame) -> DataFrame:
    """Every candidate of every text with its features."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_scan, SCHEMA)


def _luhn(digits: str) -> Column:
    c = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(F.reverse(F.col(digits)), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(c, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def known_findings(found: DataFrame) -> DataFrame:
    """Candidates that a published format decides: label 1 secret, 0 not; others are left out.

    1: access key ids (AKIA and 16 of A-Z2-7 or digits), code-host and chat tokens by their
    prefixes, and values of at least 16 hexadecimal digits, or of mixed classes,
    assigned to a name that speaks of secrets.
    0: numbers, parts of paths and addresses, words of the text's own letters
    and placeholders of one repeated character.
    """
    f = F.col("finding")
    secret = (f.rlike("^(AKIA|ASIA)[A-Z0-9]{16}$") | f.rlike("^(ghp_|gho_|ghs_|github_pat_|xox[abp]-|sk-|glpat-|AIza)[A-Za-z0-9_-]{16,}$")
              | ((F.col("f_named") == 1) & (F.col("f_length") >= 16) & (f.rlike("^[0-9a-f]+$") | (F.col("f_turns") >= 0.3)) & f.rlike("[0-9]") & f.rlike("[A-Za-z]")))
    harmless = (f.rlike(r"^[0-9\-/]+$") | (F.col("f_path") == 1) | ((F.col("f_dictionary") >= 0.5) & (F.col("f_digits") < 0.2)) | f.rlike(r"^(.)\1+$"))
    label = F.when(secret, 1.0).when(harmless & (F.col("f_named") == 0), 0.0)
    return found.withColumn("label", label).where("label is not null")


def examples() -> list[tuple]:
    """Values of known kind in short sentences: (label, *features)."""
    rng = random.Random(9)
    words = ["correct", "horse", "battery", "staple", "summer", "dragon", "river", "orange", "monkey", "window", "silver", "planet", "coffee", "garden", "winter", "bucket"]
    small = "abcdefghijklmnopqrstuvwxyz"
    letters = lambda n, kind=small: "".join(rng.choice(kind) for _ in range(n))
    word = lambda: rng.choice(words)
    mixed = [lambda: word() + str(rng.randrange(100)) + rng.choice("!@#$.%") + str(rng.randrange(10)), lambda: word().capitalize() + rng.choice("!@#$%") + word().capitalize() + "#" + str(rng.randrange(3000)),
             lambda: letters(rng.randint(6, 12), small + small.upper() + "0123456789!@#$%"), lambda: letters(rng.randint(12, 40), "0123456789abcdef"),
             lambda: letters(rng.randint(20, 40), small + small.upper() + "0123456789+/"), lambda: "-".join(letters(4) for _ in range(4)) + str(rng.randrange(10))]
    plain = [lambda: "".join(word() for _ in range(rng.randint(3, 4))), lambda: letters(16), lambda: word() + word(), lambda: letters(8), word, lambda: str(rng.randrange(10**5, 10**10))]
    harmless = [word, lambda: str(rng.randrange(1000, 10**10)), lambda: word() + "-" + word(), lambda: f"{rng.randrange(10, 24)}:{rng.randrange(10, 60)}", lambda: f"//{word()}.org/{word()}/{word()}/{letters(5)}",
                lambda: f"{rng.randrange(100, 2000)}px", lambda: word().capitalize(), lambda: "".join(word().capitalize() for _ in range(3)), lambda: f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 10)}-1{rng.randrange(10)}"]
    names = ["password", "passwd", "pwd", "secret", "token", "api_key", "DB_PASSWORD", "auth", "access_key"]
    others = ["note", "time", "see", "size", "title", "name", "date", "width", "id", "https"]
    signs = ["=", ": ", ":", " = ", " => "]
    out = []

    def add(label: float, lead: str, value: str, quote: str = "") -> None:
        before = f"{word()} {word()} {lead}{quote}".encode()
        text = before + f"{value}{quote} {word()} and {word()}".encode()
        out.append((label, *describe(text, len(before), len(before) + len(value.encode()))))

    for _ in range(60):
        for make in (*mixed, *plain):
            add(1.0, rng.choice(names) + rng.choice(signs), make(), rng.choice(["", "", '"']))
        for make in mixed:
            add(1.0, rng.choice(names[:5]) + " ", make())
        add(1.0, "app password ", letters(16))
        add(1.0, rng.choice(["", "key ", "id="]), "AKIA" + letters(16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
        for make in harmless:
            add(0.0, rng.choice(others) + rng.choice(signs), make(), rng.choice(["", "", '"']))
        for _ in range(6):
            add(0.0, rng.choice(["token", "pass", "secret", "auth", "password"]) + " ", rng.choice(["is", "was", "through", "of", "for", "over", "must", word(), word(), word() + "s"]).ljust(4, "s"))
        for value in (f"{word()}/{word()}/{word()}/{rng.randrange(99)}", str(rng.randrange(10**12, 10**16)), word() + word().capitalize() + word().capitalize(), f"{word()}_{word()}_{rng.randrange(99)}"):
            add(0.0, "", value)
    return out


def fit_forest(labelled: DataFrame, sample: int = SAMPLE, more: list[tuple] = ()):
    """A forest, or the only label there is (None without any).  ``more``: examples, which together weigh as much as the findings."""
    parts = [labelled.where(F.col("label") == y).orderBy(F.xxhash64("finding", "doc_id", "start_byte"), "finding", "doc_id", "start_byte").limit(sample)
             .select("label", *FEATURES) for y in (0.0, 1.0)]
    rows = stash(parts[0].union(parts[1]), "secret-sample").withColumn("weight", F.lit(1.0))
    if more:
        weight = max(1.0, rows.count() / len(more))
        rows = rows.union(rows.sparkSession.createDataFrame([(*x, weight) for x in more], rows.schema))
    labels = [r.label for r in rows.select("label").distinct().collect()]
    if len(labels) < 2:
        return labels[0] if labels else None
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.coalesce(1).sortWithinPartitions("label", *FEATURES))
    return RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="sqrt").fit(assembled)


def scan(docs: DataFrame, labelled: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, start_byte, end_byte, finding, score, is_secret for every candidate of every text.

    ``labelled``: findings with features (as ``findings`` gives) and a 0/1 ``label``.
    """
    found = stash(findings(docs), "secret-findings")
    model = fit_forest(known_findings(found), sample, examples()) if labelled is None else fit_forest(labelled, sample)
    if model is None or isinstance(model, float):
        scored = found.withColumn("score", F.lit(model or 0.0))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start_byte", "end_byte", "finding", "score", (F.col("score") >= SECRET_AT).alias("is_secret"))


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = column(batch, "text").to_pylist(), column(batch, "spans").to_pylist()
        for i, found in enumerate(spans):
            if found and texts[i]:
                raw, parts, done = texts[i].encode(), [], 0
                for s in sorted(found, key=lambda s: s["start_byte"]):
                    if s["start_byte"] >= done:
                        parts += [raw[done:s["start_byte"]], MASK.encode()]
                    done = max(done, s["end_byte"])  # overlapping secrets share a mask
                texts[i] = b"".join([*parts, raw[done:]]).decode("utf-8", "replace")
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), column(batch, "rest")], names=["text", "rest"])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every secret masked by ``MASK``; all rows and columns stay, n_chars follows the text.

    Each row is masked by the findings of its own text, whatever its doc_id.
    """
    rows = numbered(docs)
    found = scan(rows.select("doc_id", "row.text")).where("is_secret")
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("start_byte", "end_byte")).alias("spans"))
    others = [c for c in docs.columns if c != "text"]
    rest = F.struct(F.lit(0).alias("_"), *[F.col("row")[c].alias(f"c{i}") for i, c in enumerate(others)]).alias("rest")
    work = rows.join(spans, "doc_id", "left").select("row.text", "spans", rest)
    out = work.mapInArrow(_masked, work.select("text", "rest").schema)
    masked = {c: F.col("rest")[f"c{i}"] for i, c in enumerate(others)} | {"text": F.col("text")}
    if "n_chars" in masked:
        masked["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[masked[c].alias(c) for c in docs.columns])
