"""Mixing sources to target weights by iterative proportional fitting (operator 2).

DataFrame functions only.  Tokens (words) are counted per cell of source,
language and topic; the cells' shares are raked in turn to the target shares of
each of the three dimensions, for ``SWEEPS`` sweeps; the calibrated share over
the raw share of a cell is its weight, and a document is kept with probability
min(1, c * weight).  c is solved for a budget, the share ``KEEP`` of all tokens,
so a stray cell of great weight is kept whole and lowers nobody else's rate.
The draw is a hash of doc_id, so a run can be repeated and a lost task redone.

Default targets: per dimension, shares in proportion to the token count to the
power ``TEMPERATURE`` (the usual flattening of source mixes).  Own targets are a
table (dim, value, share); only the shares' proportions within a dimension count.

Topic is the column ``topic`` if there is one, else the register of the text,
one of four told by length and line breaks (see ``topic_of``).

The cell table is pre-aggregated in each task, so a source with a third of all
rows costs no more than another.  Sweeps work on cells (distinct source, language
and topic): the goals are joined once, a step is one window sum over a dimension,
and the cells are written every ``WRITE_EVERY`` sweeps.  The weights are broadcast
to the documents only if their bytes are counted to be few.

Edge cases: a null source, language or topic is the value '' of its dimension; a
null or empty text has no token, does not move the shares and gets its cell's
weight (0 in a cell without tokens); a null doc_id is drawn as the text '';
repeated rows are drawn alike; an empty table gives no rows; of the input's
columns those named like an added one are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stash

DIMS = ("source", "lang", "topic")
TEMPERATURE = 0.7
SWEEPS = 8
WRITE_EVERY = 4
#: of the figures that the query shows; draws take the unrounded ones
DIGITS = 6
#: share of all tokens that are kept
KEEP = 0.5
#: a table of weights of more bytes is joined by a shuffle
BROADCAST_BYTES = 8 << 20


def topic_of(text: Column) -> Column:
    """brief: under 400 characters; lines: a line break for each 200 characters or fewer; long: 4000 or more; else prose."""
    n = F.coalesce(F.length(text), F.lit(0))
    breaks = F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))), F.lit(0))
    return F.when(n < 400, "brief").when(breaks * 200 >= n, "lines").when(n >= 4000, "long").otherwise("prose")


def with_cells(docs: DataFrame) -> DataFrame:
    """The documents with the columns _source, _lang, _topic and _tokens."""
    topic = F.col("topic").cast("string") if "topic" in docs.columns else topic_of(F.col("text"))
    empty = F.lit("")
    return (docs.withColumn("_source", F.coalesce(F.col("source").cast("string"), empty))
            .withColumn("_lang", F.coalesce(F.col("lang").cast("string"), empty))
            .withColumn("_topic", F.coalesce(topic, empty))
            .withColumn("_tokens", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")))


def default_targets(cells: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """(dim, value, share) with shares in proportion to tokens ** temperature."""
    out = None
    for d in DIMS:
        part = (cells.groupBy(F.col(f"_{d}").alias("value")).agg(F.sum("tokens").alias("n"))
                .select(F.lit(d).alias("dim"), "value", F.pow(F.col("n").cast("double"), F.lit(temperature)).alias("share")))
        out = part if out is None else out.unionByName(part)
    return out


def rake(cells: DataFrame, targets: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """Cells with ``w``, in proportion to their calibrated share.  ``cells``: _source, _lang, _topic, tokens > 0."""
    table = cells
    for d in DIMS:
        goal = targets.where(F.col("dim") == d).select(F.col("value").alias(f"_{d}"), F.col("share").cast("double").alias(f"_goal_{d}"))
        table = table.join(goal, f"_{d}")
    table = stash(table.withColumn("w", F.col("tokens").cast("double")), "mix-goals")
    for k in range(1, sweeps + 1):
        for d in DIMS:
            table = table.withColumn("w", F.col("w") * F.col(f"_goal_{d}") / F.sum("w").over(Window.partitionBy(f"_{d}")))
        if k % WRITE_EVERY == 0 or k == sweeps:
            table = stash(table, "mix-sweeps")
    return table.select("_source", "_lang", "_topic", "tokens", "w")


def scale_of(weights: DataFrame, keep: float) -> float:
    """c with sum(tokens * min(1, c * _weight)) = keep * sum(tokens); infinite if all cells of any weight must be kept whole.

    The sum is concave in c, so Newton's steps from c = 0 rise to the answer, and
    end as each but the last keeps further cells whole.
    """
    c, whole = 0.0, -1.0
    while True:
        clipped = F.col("_weight") * F.lit(c) >= 1
        tokens = F.col("tokens").cast("double")
        a = weights.agg(F.sum(tokens).alias("n"), F.sum(F.when(clipped, tokens).otherwise(0.0)).alias("whole"),
                        F.sum(F.when(clipped, 0.0).otherwise(tokens * F.col("_weight"))).alias("rest")).first()  # one row
        if not a.n or not a.rest:
            return math.inf
        if a.whole <= whole:
            return c
        c, whole = max(c, (keep * a.n - a.whole) / a.rest), a.whole


def mix(docs: DataFrame, targets: DataFrame | None = None, sweeps: int = SWEEPS, keep: float = KEEP) -> DataFrame:
    """All columns of ``docs`` and _source, _lang, _topic, _tokens, _weight, _probability and _sampled.

    ``keep``: the share of all tokens to keep.
    """
    marked = with_cells(docs.drop("_weight", "_probability", "_sampled"))
    cells = marked.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens")).where("tokens > 0")
    cells = stash(cells, "mix-counts")
    table = rake(cells, default_targets(cells) if targets is None else targets, sweeps)
    share = table.agg(F.sum("tokens").alias("_all"), F.sum("w").alias("_w"))
    weights = stash(table.crossJoin(F.broadcast(share))  # one row
                    .withColumn("_weight", (F.col("w") / F.col("_w")) / (F.col("tokens") / F.col("_all"))), "mix-calibrated")
    probability = F.least(F.lit(1.0), F.col("_weight") * F.lit(scale_of(weights, keep)))
    size = weights.agg(F.sum(F.octet_length("_source") + F.octet_length("_lang") + F.octet_length("_topic") + 64)).first()[0] or 0
    weights = weights.select("_source", "_lang", "_topic", "_weight", F.when(F.col("_weight") > 0, probability).otherwise(0.0).alias("_probability"))
    if size <= BROADCAST_BYTES:
        weights = F.broadcast(weights)
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    zero = F.lit(0.0)
    return (marked.join(weights, ["_source", "_lang", "_topic"], "left")
            .withColumn("_weight", F.coalesce("_weight", zero)).withColumn("_probability", F.coalesce("_probability", zero))
            .withColumn("_sampled", draw < F.col("_probability")))


def mixed(docs: DataFrame) -> DataFrame:
    """One row per document: its cell, tokens, calibrated weight, probability and whether it is sampled."""
    needed = docs.select("doc_id", "text", "lang", "source", *(["topic"] if "topic" in docs.columns else []))
    return mix(needed).select("doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"),
                              F.col("_tokens").alias("n_tokens"), F.round("_weight", DIGITS).alias("weight"),
                              F.round("_probability", DIGITS).alias("probability"), F.col("_sampled").alias("sampled"))


def oracle_sql(sweeps: int = SWEEPS, temperature: float = TEMPERATURE, keep: float = KEEP) -> str:
    """The same in DuckDB SQL, sweeps written out; c is the largest that any number of cells kept whole, heaviest first, allows."""
    ctes = [r"""marked AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
 CASE WHEN coalesce(length(text), 0) < 400 THEN 'brief'
      WHEN (length(text) - length(replace(text, chr(10), ''))) * 200 >= length(text) THEN 'lines'
      WHEN length(text) >= 4000 THEN 'long' ELSE 'prose' END AS topic,
 coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens FROM documents)""",
            "cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM marked GROUP BY ALL HAVING sum(n_tokens) > 0)"]
    for d in DIMS:
        ctes.append(f"goal_{d} AS (SELECT {d}, power(sum(tokens), {temperature}) / sum(power(sum(tokens), {temperature})) OVER () AS goal FROM cells GROUP BY {d})")
    ctes.append("s0 AS (SELECT *, tokens AS w FROM cells)")
    k = 0
    for _ in range(sweeps):
        for d in DIMS:
            ctes.append(f"s{k + 1} AS MATERIALIZED (SELECT s.source, s.lang, s.topic, s.tokens, s.w * g.goal / sum(s.w) OVER (PARTITION BY s.{d}) AS w "
                        f"FROM s{k} s JOIN goal_{d} g USING ({d}))")
            k += 1
    ctes.append(f"weighed AS (SELECT source, lang, topic, (w / sum(w) OVER ()) / (tokens / sum(tokens) OVER ()) AS weight FROM s{k})")
    ctes.append("""ranked AS (SELECT *, sum(tokens) OVER () AS n, coalesce(sum(tokens) OVER before, 0) AS whole,
 sum(tokens * weight) OVER () - coalesce(sum(tokens * weight) OVER before, 0) AS rest FROM (SELECT * FROM weighed JOIN cells USING (source, lang, topic))
 WINDOW before AS (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
    ctes.append(f"final AS (SELECT source, lang, topic, weight, least(1.0, weight * max(({keep} * n - whole) / rest) OVER ()) AS probability FROM ranked)")
    return ("WITH " + ",\n".join(ctes) + "\nSELECT m.doc_id, m.source, m.lang, m.topic, m.n_tokens, "
            f"coalesce(round(f.weight, {DIGITS}), 0.0) AS weight, coalesce(round(f.probability, {DIGITS}), 0.0) AS probability, "
            "('0x' || substr(md5(coalesce(m.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < coalesce(f.probability, 0.0) AS sampled "
            "FROM marked m LEFT JOIN final f USING (source, lang, topic)")
