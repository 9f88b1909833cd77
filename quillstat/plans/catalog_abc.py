"""Catalogue sections A (sources), B (profile) and C (exploratory statistics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.operators import eda as E
from quillstat.operators import profile as P
from quillstat.plans import oracle as O
from quillstat.plans import views as V
from quillstat.plans.registry import query, union_all
from quillstat.sources.readers import normalise_missing, type_decisions

PROFILED = ["orders", "customer", "part", "events", "labels", "documents", "lineitem_messy"]


def _profiles(spark, sf, fn, tables=PROFILED, distinct="exact") -> DataFrame:
    """Apply ``fn(profile_df, relation_df)`` per table and tag rows with the table name.

    ``distinct``: exact where counts are shown, hybrid where only decisions are, none where neither is."""
    out = []
    for t in tables:
        rel = V.relation(spark, sf, t)
        out.append(fn(P.profile(rel, distinct=distinct), rel).select(F.lit(t).alias("table_name"), "*"))
    return union_all(out)


# ===========================================================================
# A. Sources
# ===========================================================================

_MESSY_TEXT = ["l_returnflag", "l_linestatus", "qty_text", "ship_text", "flag_text"]
_ORDERS_AS_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("a3_missing_tokens", O.union_all([
    f"SELECT {O.lit(c)} AS column_name, count(*) - count({V.na_sql(O.q(c))}) AS n_missing "
    f"FROM ({V.LINEITEM_MESSY_RAW_SQL}) raw" for c in _MESSY_TEXT]))
def a3_missing_tokens(spark, sf):
    df = normalise_missing(V.lineitem_messy_raw(spark, sf))
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in _MESSY_TEXT])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), (F.col("n") - F.col(c)).alias("n_missing"))
        for c in _MESSY_TEXT])))


_ORDERS_TEXT_SQL = "(SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in _ORDERS_AS_TEXT) + " FROM orders)"


@query("a4_type_inference", O.union_all(
    [f"SELECT 'lineitem_messy' AS table_name, {O.lit(c)} AS column_name, "
     f"({O.infer_type_sql(c, '(SELECT ' + V.na_sql(O.q(c)) + ' AS ' + O.q(c) + ' FROM (' + V.LINEITEM_MESSY_RAW_SQL + ') raw)')}) AS inferred_type"
     for c in _MESSY_TEXT] +
    [f"SELECT 'orders_text' AS table_name, {O.lit(c)} AS column_name, "
     f"({O.infer_type_sql(c, _ORDERS_TEXT_SQL)}) AS inferred_type" for c in _ORDERS_AS_TEXT] +
    [f"SELECT DISTINCT 'orders_odd', '{c}', '{kind}' FROM orders"
     for c, kind in (("padded", "bigint"), ("infinite", "double"), ("nothing", "double"), ("inner_blank", "string"))]))
def a4_type_inference(spark, sf):
    messy = normalise_missing(V.lineitem_messy_raw(spark, sf)).select(*_MESSY_TEXT)
    orders_text = V.load_testdata(spark, sf, "orders").select(
        *[F.col(c).cast("string").alias(c) for c in _ORDERS_AS_TEXT])
    key = F.col("o_orderkey").cast("string")
    odd = V.load_testdata(spark, sf, "orders").select(
        F.concat(F.lit(" "), key, F.lit("  ")).alias("padded"),
        F.when(F.col("o_orderkey") % 2 == 0, "-inf").otherwise(F.col("o_totalprice").cast("string")).alias("infinite"),
        F.lit("NA").alias("nothing"), F.concat(key, F.lit(" 1")).alias("inner_blank"))
    return (type_decisions(messy).select(F.lit("lineitem_messy").alias("table_name"), "*")
            .unionByName(type_decisions(orders_text).select(F.lit("orders_text").alias("table_name"), "*"))
            .unionByName(type_decisions(normalise_missing(odd)).select(F.lit("orders_odd").alias("table_name"), "*")))


# ===========================================================================
# B. Profile
# ===========================================================================

_FLAGS = O.flags_sql(PROFILED)


@query("b1_table_counts", f"""WITH f AS ({_FLAGS})
SELECT table_name, max(n_rows) AS n_rows, count(*) AS n_cols,
  CAST(2 + max(CAST(classification_target AS INTEGER)) + max(CAST(regression_suggested AS INTEGER)) AS BIGINT) AS n_tasks
FROM f GROUP BY table_name""")
def b1_table_counts(spark, sf):
    return _profiles(spark, sf, lambda p, r: P.table_summary(p).drop("missing_pct"), distinct="hybrid")


@query("b2_semantic_type", f"SELECT table_name, ordinal, column_name, semantic_type FROM ({O.profiles_sql(PROFILED)}) p")
def b2_semantic_type(spark, sf):
    return _profiles(spark, sf, lambda p, r: p.select("ordinal", "column_name", "semantic_type"), distinct="hybrid")


_DATE_COLS = [c for c, _, _ in V.DATE_TEXTS] + ["two_layouts", "impossible", "remark"]


@query("b2_date_layouts", O.date_types_sql(V.LINEITEM_DATES_SQL, _DATE_COLS))
def b2_date_layouts(spark, sf):
    return P.profile(V.lineitem_dates(spark, sf).select(*_DATE_COLS), distinct="hybrid").select("column_name", "semantic_type")


@query("b3_missing_pct", f"SELECT table_name, column_name, n_missing, missing_pct FROM ({O.profiles_sql(PROFILED)}) p")
def b3_missing_pct(spark, sf):
    return _profiles(spark, sf, lambda p, r: p.select("column_name", "n_missing", "missing_pct"), distinct="none")


@query("b4_distinct_count", f"SELECT table_name, column_name, n_unique FROM ({O.profiles_sql(PROFILED)}) p")
def b4_distinct_count(spark, sf):
    return _profiles(spark, sf, lambda p, r: p.select("column_name", "n_unique"))


_FIRST_SEEN = [t for t in PROFILED if t != "lineitem_messy"]   # tables as they lie in files


@query("b5_first_seen", O.union_all([O.samples_sql(t, first_seen=True) for t in _FIRST_SEEN]))
def b5_first_seen(spark, sf):
    return union_all([P.sample_values(V.load_testdata(spark, sf, t), file_order=True)
                      .select(F.lit(t).alias("table_name"), "column_name", "sample_rank", "sample_value") for t in _FIRST_SEEN])


@query("b5_sample_values", O.union_all([O.samples_sql(t) for t in PROFILED]))
def b5_sample_values(spark, sf):
    out = []
    for t in PROFILED:
        rel = V.relation(spark, sf, t)
        out.append(P.sample_values(rel).select(F.lit(t).alias("table_name"), "column_name",
                                               "sample_rank", "sample_value"))
    return union_all(out)


@query("b6_distinct_ratio", f"SELECT table_name, column_name, round(distinct_ratio, 6) AS distinct_ratio FROM ({O.profiles_sql(PROFILED)}) p")
def b6_distinct_ratio(spark, sf):
    return _profiles(spark, sf, lambda p, r: p.select("column_name", F.round("distinct_ratio", 6).alias("distinct_ratio")))


@query("b7_suggested_tasks", f"""WITH f AS ({_FLAGS}), g AS (
  SELECT table_name, bool_or(classification_target) AS c, bool_or(regression_suggested) AS r FROM f GROUP BY table_name)
SELECT table_name, 1 AS position, 'anomaly_detection' AS task FROM g
UNION ALL SELECT table_name, 2, 'clustering' FROM g
UNION ALL SELECT table_name, 3, 'classification' FROM g WHERE c
UNION ALL SELECT table_name, 4, 'regression' FROM g WHERE r""")
def b7_suggested_tasks(spark, sf):
    return _profiles(spark, sf, lambda p, r: P.suggest_tasks(p), distinct="hybrid")


@query("b8_targets_for_task", f"""WITH f AS ({_FLAGS})
SELECT table_name, 'classification' AS task, column_name,
  CAST(row_number() OVER (PARTITION BY table_name ORDER BY ordinal) AS INTEGER) AS position
FROM f WHERE classification_target
UNION ALL
SELECT table_name, 'regression' AS task, column_name,
  CAST(row_number() OVER (PARTITION BY table_name ORDER BY ordinal) AS INTEGER) AS position
FROM f WHERE regression_target""")
def b8_targets_for_task(spark, sf):
    return _profiles(spark, sf, lambda p, r: union_all([
        P.targets_for_task(p, t).select(F.lit(t).alias("task"), "column_name", "position")
        for t in ("classification", "regression")]), distinct="hybrid")


@query("b9_id_exclusion", f"WITH f AS ({_FLAGS}) SELECT table_name, column_name, id_excluded FROM f")
def b9_id_exclusion(spark, sf):
    return _profiles(spark, sf, lambda p, r: p.select("column_name", P.id_excluded(F.col("column_name")).alias("id_excluded")), distinct="none")


@query("b10_target_union", f"""WITH f AS ({_FLAGS})
SELECT table_name, column_name, CAST(row_number() OVER (PARTITION BY table_name
  ORDER BY CASE WHEN classification_target THEN 0 ELSE 1 END, ordinal) AS INTEGER) AS position
FROM f WHERE classification_target OR regression_suggested""")
def b10_target_union(spark, sf):
    return _profiles(spark, sf, lambda p, r: P.suggested_targets(p), distinct="hybrid")


@query("b11_target_advice", f"""WITH f AS ({_FLAGS})
SELECT table_name, 'classification' AS task, ordinal, column_name, n_unique,
  CASE WHEN n_unique = 2 THEN 'binary' ELSE CAST(n_unique AS VARCHAR) || ' classes' END AS advice
FROM f WHERE classification_target
UNION ALL
SELECT table_name, 'regression', ordinal, column_name, n_unique,
  'continuous with ' || CAST(n_unique AS VARCHAR) || ' unique values' FROM f WHERE regression_target""")
def b11_target_advice(spark, sf):
    return _profiles(spark, sf, lambda p, r: P.target_advice(p))


@query("b12_table_missing_pct", f"SELECT table_name, round(avg(missing_pct), 1) AS missing_pct FROM ({O.profiles_sql(PROFILED)}) p GROUP BY table_name")
def b12_table_missing_pct(spark, sf):
    return _profiles(spark, sf, lambda p, r: P.table_summary(p).select("missing_pct"), distinct="none")


@query("b13_column_summary", f"""WITH p AS ({O.profiles_sql(PROFILED)}), s AS ({O.union_all([O.samples_sql(t) for t in PROFILED])})
SELECT p.table_name, p.ordinal, p.column_name, p.semantic_type, p.missing_pct, p.n_unique,
  coalesce((SELECT string_agg(s.sample_value, ', ' ORDER BY s.sample_rank) FROM s
            WHERE s.table_name = p.table_name AND s.column_name = p.column_name AND s.sample_rank <= 3), '') AS sample
FROM p""")
def b13_column_summary(spark, sf):
    return _profiles(spark, sf, lambda p, r: P.column_summary(P.with_samples(p, P.sample_values(r))))


@query("b14_default_choice", f"""WITH f AS ({_FLAGS}), g AS (
  SELECT table_name, CASE WHEN bool_or(classification_target) THEN 'classification'
                          WHEN bool_or(regression_suggested) THEN 'regression' END AS task FROM f GROUP BY table_name),
c AS (SELECT table_name, 'classification' AS task, ordinal, column_name FROM f WHERE classification_target
      UNION ALL SELECT table_name, 'regression', ordinal, column_name FROM f WHERE regression_target)
SELECT g.table_name, g.task, arg_min(c.column_name, c.ordinal) AS target
FROM g JOIN c ON g.table_name = c.table_name AND g.task = c.task GROUP BY g.table_name, g.task""")
def b14_default_choice(spark, sf):
    return _profiles(spark, sf, lambda p, r: P.default_choice(p), distinct="hybrid")


# ===========================================================================
# C. Exploratory statistics (on the messy lineitem view)
# ===========================================================================

_M = f"({V.LINEITEM_MESSY_SQL})"
_NUM = [c for c, k in V.MESSY_KINDS if k == "numeric"]
_CAT_TABLES = {"orders": ["o_orderstatus", "o_orderpriority"], "customer": ["c_mktsegment"],
               "part": ["p_name", "p_brand", "p_type"], "events": ["event_type", "props"],
               "lineitem_messy": ["l_returnflag", "l_linestatus", "flag_text"]}


def _messy_numeric(spark, sf):
    df = V.lineitem_messy(spark, sf)
    return df, E.present_columns(df, P.numeric_columns(df))


def _stats_sql(c: str) -> str:
    x = f"CAST({O.q(c)} AS DOUBLE)"
    skew = (f"CASE WHEN count({x}) < 3 THEN NULL WHEN stddev_pop({x}) = 0 THEN 0.0 "
            f"ELSE skewness({x}) END")
    return (f"SELECT {O.lit(c)} AS column_name, round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std, "
            f"round(min({x}), 4) AS min, round(max({x}), 4) AS max, round({skew}, 4) AS skew FROM {_M} m")


_STATS_SQL = O.union_all([_stats_sql(c) for c in _NUM])


@query("c2_numeric_summary", f"SELECT column_name, mean, std, min, max FROM ({_STATS_SQL}) s")
def c2_numeric_summary(spark, sf):
    df, num = _messy_numeric(spark, sf)
    return E.numeric_summary(df, num).select("column_name", "mean", "std", "min", "max")


@query("c3_skewness", f"SELECT column_name, skew FROM ({_STATS_SQL}) s")
def c3_skewness(spark, sf):
    df, num = _messy_numeric(spark, sf)
    return E.numeric_summary(df, num).select("column_name", "skew")


def _top_sql(table: str, c: str) -> str:
    return (f"SELECT {O.lit(table)} AS table_name, {O.lit(c)} AS column_name, "
            f"CAST(row_number() OVER (ORDER BY cnt DESC, v) AS INTEGER) AS value_rank, v AS value, cnt AS count "
            f"FROM (SELECT CAST({O.q(c)} AS VARCHAR) AS v, count(*) AS cnt FROM {V.relation_sql(table)} t "
            f"WHERE {O.q(c)} IS NOT NULL GROUP BY 1) g QUALIFY value_rank <= 10")


@query("c1_eda_report", f"""SELECT p.column_name, p.semantic_type, p.missing_pct, p.n_unique, s.mean, s.std, s.min, s.max, s.skew,
  CASE WHEN p.semantic_type = 'categorical' THEN t.top_values END AS top_values
FROM ({O.profile_sql('lineitem_messy')}) p LEFT JOIN ({_STATS_SQL}) s ON p.column_name = s.column_name
LEFT JOIN (SELECT column_name, string_agg(value || ' ' || count, ', ' ORDER BY value_rank) AS top_values
           FROM ({O.union_all([_top_sql('lineitem_messy', c) for c in _CAT_TABLES['lineitem_messy']])}) x GROUP BY column_name) t
  ON p.column_name = t.column_name""")
def c1_eda_report(spark, sf):
    df, num = _messy_numeric(spark, sf)
    report = E.eda_report(P.profile(df), E.numeric_summary(df, num), E.top_values(df, _CAT_TABLES["lineitem_messy"])).drop("ordinal")
    return report.withColumn("top_values", F.array_join(F.transform("top_values", lambda x: F.concat_ws(" ", x["value"], x["count"])), ", "))


@query("c4_top_values", O.union_all([_top_sql(t, c) for t, cs in _CAT_TABLES.items() for c in cs]))
def c4_top_values(spark, sf):
    out = []
    for t, cs in _CAT_TABLES.items():
        rel = V.relation(spark, sf, t)
        out.append(E.top_values(rel, cs).select(F.lit(t).alias("table_name"), "column_name",
                                                "value_rank", "value", "count"))
    return union_all(out)


def _hist_sql(c: str, bins: int = 40) -> str:
    x = f"CAST({O.q(c)} AS DOUBLE)"
    return (f"SELECT {O.lit(c)} AS column_name, CAST(b AS INTEGER) AS bin, round(lo + b * w, 4) AS bin_start, "
            f"round(lo + (b + 1) * w, 4) AS bin_end, count(*) AS count FROM ("
            f"SELECT CASE WHEN w = 0 THEN 0 ELSE least(floor(({x} - lo) / w), {bins - 1}) END AS b, lo, w "
            f"FROM {_M} m, (SELECT min({x}) AS lo, (max({x}) - min({x})) / {bins} AS w FROM {_M} m2) r "
            f"WHERE {x} IS NOT NULL) h GROUP BY b, lo, w")


@query("c5_histogram", O.union_all([_hist_sql(c) for c in _NUM]))
def c5_histogram(spark, sf):
    df, num = _messy_numeric(spark, sf)
    return E.histogram(df, num).select("column_name", "bin", "bin_start", "bin_end", "count")


def _corr_sql(cols: list[str]) -> str:
    parts = []
    for a in cols:
        for b in cols:
            x, y = f"CAST({O.q(a)} AS DOUBLE)", f"CAST({O.q(b)} AS DOUBLE)"
            r = (f"covar_pop({x}, {y}) / nullif(stddev_pop(CASE WHEN {y} IS NOT NULL THEN {x} END) * "
                 f"stddev_pop(CASE WHEN {x} IS NOT NULL THEN {y} END), 0)")
            parts.append(f"SELECT {O.lit(a)} AS col_x, {O.lit(b)} AS col_y, round({r}, 3) AS r FROM {_M} m")
    return O.union_all(parts)


_CORR_SQL = _corr_sql(_NUM)


@query("c6_correlation", _CORR_SQL)
def c6_correlation(spark, sf):
    df, num = _messy_numeric(spark, sf)
    return E.correlation(df, num)


@query("c7_heatmap_long", _CORR_SQL)
def c7_heatmap_long(spark, sf):
    df, num = _messy_numeric(spark, sf)
    return E.matrix_to_long(E.correlation_matrix(E.correlation(df, num), num), num)


@query("c9_nonnull_values", f"SELECT l_orderkey, l_linenumber, disc_nulls AS value FROM {_M} m WHERE disc_nulls IS NOT NULL")
def c9_nonnull_values(spark, sf):
    return E.nonnull_values(V.lineitem_messy(spark, sf), "disc_nulls", ["l_orderkey", "l_linenumber"])


# A1 + A2: a CSV written by Spark from ``orders`` with padded header names,
# read back through the CSV source (text columns, trimmed names, A3, A4).
_CSV_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _orders_csv(spark, sf) -> str:
    import uuid

    from quillstat.session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    o = V.load_testdata(spark, sf, "orders")
    (o.select(*[F.col(c).alias(f"  {c} ") for c in _CSV_COLS])
     .write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return path


@query("a1_csv_scan", f"""SELECT column_name, inferred_type, semantic_type, n_unique FROM (
  SELECT 'o_orderkey' AS column_name, 'bigint' AS inferred_type, 'numeric' AS semantic_type, count(DISTINCT o_orderkey) AS n_unique FROM orders
  UNION ALL SELECT 'o_custkey', 'bigint', 'numeric', count(DISTINCT o_custkey) FROM orders
  UNION ALL SELECT 'o_orderstatus', 'string', 'categorical', count(DISTINCT o_orderstatus) FROM orders
  UNION ALL SELECT 'o_totalprice', 'double', 'numeric', count(DISTINCT o_totalprice) FROM orders
  UNION ALL SELECT 'o_orderdate', 'string', 'datetime', count(DISTINCT o_orderdate) FROM orders
  UNION ALL SELECT 'o_orderpriority', 'string', 'categorical', count(DISTINCT o_orderpriority) FROM orders) x""")
def a1_csv_scan(spark, sf):
    from quillstat.sources.readers import read_table
    df = read_table(spark, _orders_csv(spark, sf) + "/*.csv")
    types = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    return P.profile(df).select("column_name", F.element_at(types, F.col("column_name")).alias("inferred_type"),
                                "semantic_type", "n_unique")


@query("a1_quoted_csv", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, md5(text) AS text_md5 FROM documents")
def a1_quoted_csv(spark, sf):
    """Texts with newlines, written as quoted CSV and read back by many tasks a file."""
    import uuid

    from quillstat.session import checkpoint_dir
    from quillstat.sources.readers import read_csv
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    (V.load_testdata(spark, sf, "documents").select("doc_id", "text", "lang")
     .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path))
    return read_csv(spark, path + "/*.csv", multiline=True).select("doc_id", "lang", F.md5("text").alias("text_md5"))
