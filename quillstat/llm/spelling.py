"""Spelling variant grouping by permuterm rotations (operator 13).

A word of m code points, marked with the terminator ``$``, has m + 1 rotations.
A rotation ``y$xc`` belongs to the word x·c·y; without its last code point it is
``y$x``, the same for every word that has another code point in the place of c,
and it is the whole rotation of the word xy that lacks c.  So each rotation is
filed under itself and under its prefix without the last code point; the
filings are sorted by that prefix, and a run of equal prefixes holds words of
which each two differ by exactly one replaced, inserted or deleted code point.
A run has at most one word for each letter and one that lacks it, whatever the
corpus.  The scan of a run gives each of its words the number of its near words
there and the most frequent other one, so no pairs are written.  A replaced
pair meets in one run; an inserted code point beside its like meets in several
and is counted in the run of its first place.

Words are the runs of letters (A-Z, a-z and U+00C0 to U+00FF) of all texts,
A-Z lower-cased; a fixed share of the runs loses a code point told by a hash of
doc_id and run, which plants misspellings.  Counting is one aggregation with
map-side sums, so frequent words cost no more than others.  A form has at least
``DOMINANCE`` times its word's occurrences, so a chain of forms is at most
log(largest n) / log(DOMINANCE) long, and its end is found by doubling.

Edge cases: a null text has no words; a null doc_id is written as the empty
string before the colon; repeated rows count each; words of equal n are taken in
code-point order; a table without words gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stash

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 6
MIN_COUNT = 5
#: one run in so many loses a code point
SLIP = 199
#: a form occurs at least so many times as often as its word
DOMINANCE = 5
MARK = "$"


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the words of the documents and their occurrences."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                       F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= min_length)  # a run only gets shorter
    h = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return (runs.select("run", h.alias("h"))
            .select(F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
            .where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _part(text: str, start: Column, length: Column) -> Column:
    return F.substring(text, start, length)


def rotations(words: DataFrame) -> DataFrame:
    """Filings of the rotations: prefix, word, n, whole (the prefix is the whole rotation), first.

    ``first``: the code point that the prefix skips is not beside its like on the left.
    """
    m = F.char_length("word")
    turned = (words.select("word", "n", F.explode(F.sequence(F.lit(0), m)).alias("j"))
              .select("word", "n", "j", F.concat(_part("word", F.col("j") + 1, m), F.lit(MARK), _part("word", F.lit(1), F.col("j"))).alias("rotation")))
    skipped = _part("word", F.col("j"), F.lit(1))
    first = (F.col("j") == 1) | (skipped != _part("word", F.col("j") - 1, F.lit(1)))
    filed = F.array(F.struct(F.col("rotation").alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("first")),
                    F.struct(_part("rotation", F.lit(1), m).alias("prefix"), F.lit(False).alias("whole"), first.alias("first")))
    return (turned.select("word", "n", F.inline(F.when(F.col("j") == 0, F.slice(filed, 1, 1)).otherwise(filed))))


def neighbours(words: DataFrame) -> DataFrame:
    """word, n, n_near and best, a struct (n, word) of the near word of largest n (null without one)."""
    run = Window.partitionBy("prefix")
    order = run.orderBy(F.desc("n"), "word")
    whole_run = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scanned = (rotations(words)
               .withColumn("rank", F.row_number().over(order))
               .withColumn("size", F.count(F.lit(1)).over(whole_run)).withColumn("longer", F.sum(F.col("first").cast("long")).over(whole_run))
               .withColumn("shorter", F.max("whole").over(whole_run))
               .withColumn("top", F.first(F.struct("n", "word")).over(whole_run))
               .withColumn("next", F.nth_value(F.struct("n", "word"), 2).over(whole_run))
               .where("size > 1"))
    replaced = F.col("size") - F.col("shorter").cast("long") - 1
    near = F.when(F.col("whole"), F.col("longer")).otherwise(replaced + (F.col("shorter") & F.col("first")).cast("long"))
    other = F.when(F.col("rank") == 1, F.col("next")).otherwise(F.col("top"))
    found = scanned.select("word", "n", near.alias("near"), other.alias("other"))
    none = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast(found.schema["other"].dataType).alias("other"))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other.n")).alias("minus"), F.col("other.word").alias("word"))))
    return (found.unionByName(none).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best.alias("b"))
            .select("word", "n", "n_near", F.when(F.col("b").isNotNull(), F.struct((-F.col("b.minus")).alias("n"), F.col("b.word").alias("word"))).alias("best")))


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the documents."""
    words = stash(word_counts(docs), "spelling-words")
    near = neighbours(words)
    is_form = F.col("best.n") >= DOMINANCE * F.col("n")
    table = stash(near.select("word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, F.col("best.n")).alias("form_n")), "spelling-forms")
    links = table.where("form is not null").select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 1
    longest = 1 + math.ceil(math.log(most) / math.log(DOMINANCE))
    for _ in range(math.ceil(math.log2(longest + 1))):  # chains of 1, 2, 4, ... forms
        step = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stash(links.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return (table.join(links, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def oracle_sql() -> str:
    """The same in DuckDB SQL: near words share what is left when a code point goes, at the same place or of a longer word."""
    return rf"""
WITH crc AS (SELECT [list_reduce([b::UBIGINT] || [0::UBIGINT for z in range(8)], lambda a, z: xor(a >> 1, 3988292384::UBIGINT * (a & 1::UBIGINT))) for b in range(256)] AS t),
runs AS (SELECT doc, run, count(*) AS k FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
         WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, k, xor(list_reduce([4294967295::UBIGINT] || [('0x' || x)::UBIGINT for x in regexp_extract_all(hex(encode(doc || ':' || run)), '..')],
        lambda a, b: xor(a >> 8, t[1 + xor(a & 255::UBIGINT, b)::INT])), 4294967295::UBIGINT)::BIGINT AS h FROM runs, crc),
results AS (SELECT CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM results WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
   UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
   UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
forms AS (SELECT w.word, w.n, count(other)::BIGINT AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n FROM words w LEFT JOIN near USING (word, n) GROUP BY ALL),
chosen AS (SELECT word, n, n_near, CASE WHEN best_n >= {DOMINANCE} * n THEN best END AS form, CASE WHEN best_n >= {DOMINANCE} * n THEN best_n END AS form_n FROM forms),
chain AS (WITH RECURSIVE c AS (SELECT word, word AS point, 0 AS k FROM chosen UNION ALL SELECT c.word, f.form, k + 1 FROM c JOIN chosen f ON f.word = c.point WHERE f.form IS NOT NULL)
   SELECT word, arg_max(point, k) AS root FROM c GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM chosen JOIN chain USING (word)"""
