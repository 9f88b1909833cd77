"""One query per operator of this package, over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from quillstat.session import ship_package

from . import block_dedup as op8
from . import decontaminate as op4
from . import embed_dedup as op7
from . import jaccard as op6
from . import language_id as op11
from . import lattice_lm as op10
from . import mixing as op2
from . import prefix_trie as op12
from . import quality as op1
from . import secret_scan as op9
from . import spelling as op13
from . import suffix_dedup as op5
from . import toolcalls as op3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_quality")
def op1_quality(spark, sf_dir):
    return op1.quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query("op5_suffix_array_dedup")
def op5_suffix_array_dedup(spark, sf_dir):
    return op5.remove_repeats(_read(spark, sf_dir, "documents"))


@query("op6_ngram_jaccard")
def op6_ngram_jaccard(spark, sf_dir):
    return op6.jaccard_classes(_read(spark, sf_dir, "documents"))


@query("op2_source_mix", op2.oracle_sql())
def op2_source_mix(spark, sf_dir):
    return op2.mixed(_read(spark, sf_dir, "documents"))


_OP3_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
calls AS (SELECT conv_id, turn, min(text) AS text FROM c WHERE role = 'user' GROUP BY ALL),
results AS (SELECT conv_id, turn, min(text) AS content FROM c WHERE role = 'assistant' GROUP BY ALL),
runs AS (SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run FROM calls),
leveled AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS level FROM runs),
joined AS (SELECT l.*, r.conv_id IS NOT NULL AS has_result, r.content, coalesce(len(regexp_extract_all(l.text, '[^\x20\x09-\x0D]+')), 0) AS words
           FROM leveled l LEFT JOIN results r ON r.conv_id = l.conv_id AND r.turn = l.turn + 1)
SELECT conv_id, conv_id || ':' || turn AS call_id, level, turn, 'reply' AS name, has_result, words >= 3 AND text <> '' AS valid,
  '{"arguments":{"prompt":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"words":' || words || '},"id":"' || conv_id || ':' || turn || '","name":"reply","result":'
  || coalesce(to_json(content)::VARCHAR, 'null') || ',"valid":' || (words >= 3 AND text <> '') || '}' AS json
FROM joined"""


@query("op3_tool_calls", _OP3_SQL)
def op3_tool_calls(spark, sf_dir):
    return op3.link_calls(*op3.turns_as_calls(_read(spark, sf_dir, "conversations")), op3.TURN_SCHEMAS)


_OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
l AS (SELECT DISTINCT least(len(w), 5) AS n FROM i WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, n, s FROM (SELECT doc_id, n, unnest([array_to_string(w[k:k + n - 1], ' ') for k in range(1, len(w) - n + 2)]) AS s FROM d, l WHERE len(w) >= n)),
ish AS (SELECT DISTINCT item_id, n, s FROM (SELECT item_id, least(len(w), 5) AS n, unnest([array_to_string(w[k:k + least(len(w), 5) - 1], ' ') for k in range(1, len(w) - least(len(w), 5) + 2)]) AS s FROM i WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM ish GROUP BY item_id),
shared AS (SELECT ds.doc_id, ish.item_id, count(*) AS n_shared FROM ds JOIN ish USING (n, s) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment FROM shared JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles"""


@query("op4_decontaminate", _OP4_SQL)
def op4_decontaminate(spark, sf_dir):
    return op4.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


_OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings WHERE vec_id IS NOT NULL UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM low LEFT JOIN n USING (vec_id)"""


@query("op7_embedding_near_dedup", _OP7_SQL)
def op7_embedding_near_dedup(spark, sf_dir):
    return op7.near_vectors(_read(spark, sf_dir, "embeddings"))


@query("op8_substring_dedup")
def op8_substring_dedup(spark, sf_dir):
    return op8.remove_repeats(_read(spark, sf_dir, "documents"))


@query("op9_secret_scan")
def op9_secret_scan(spark, sf_dir):
    return op9.scan(_read(spark, sf_dir, "documents"))


@query("op10_lattice_likelihood")
def op10_lattice_likelihood(spark, sf_dir):
    return op10.lattice_scores(_read(spark, sf_dir, "documents"))


@query("op11_language_id")
def op11_language_id(spark, sf_dir):
    return op11.languages(_read(spark, sf_dir, "documents"))


@query("op12_prefix_trie", op12.ORACLE_SQL)
def op12_prefix_trie(spark, sf_dir):
    return op12.prefix_nodes(_read(spark, sf_dir, "conversations"))


@query("op13_spelling_variants", op13.oracle_sql())
def op13_spelling_variants(spark, sf_dir):
    return op13.variants(_read(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
