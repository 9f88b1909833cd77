"""Catalogue sections D (preparation) and E (training-set preparation)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.functions import dates
from quillstat.functions.exprs import DATETIME_FORMATS, SPLIT_BOUND, md5_key
from quillstat.operators import prepare as D
from quillstat.operators import profile as P
from quillstat.plans import oracle as O
from quillstat.plans import views as V
from quillstat.plans.catalog_abc import PROFILED
from quillstat.plans.registry import query, union_all

_M = f"({V.LINEITEM_MESSY_SQL})"
D_TARGET = "qty_text"
_D_NUM = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "disc_nulls", "const_one", "qty_text"]
_D_CAT = ["l_returnflag", "l_linestatus", "flag_text"]
_KEYS = ["l_orderkey", "l_linenumber"]


def _round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    # "+ 0.0" turns a rounded -0.0 into 0.0 so both engines print the same value
    return df.select(*[(F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _messy_prepared(spark, sf):
    df = V.lineitem_messy(spark, sf)
    info = P.collect_info(P.profile(df))
    out, fitted = D.preprocess(df, info, D_TARGET)
    return df, info, out, fitted


def _ts_sql(expr: str) -> str:
    return "coalesce(" + ", ".join(
        f"CASE WHEN regexp_full_match({expr}, {O.lit(shape[1:-1])}) THEN try_strptime({expr}, {O.lit(f)}) END"
        for f, shape in DATETIME_FORMATS) + ")"


def _sd(expr: str) -> str:
    return f"CASE WHEN {expr} = 0 OR {expr} IS NULL THEN 1 ELSE {expr} END"


_D_MED = ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in _D_NUM)
_D_IMP = ", ".join(f"coalesce(CAST(m.{c} AS DOUBLE), med.{c}) AS {c}" for c in _D_NUM)
_D_CODES = ", ".join(f"CAST(dense_rank() OVER (ORDER BY coalesce(CAST(m.{c} AS VARCHAR), 'missing')) - 1 AS INTEGER) AS {c}"
                     for c in _D_CAT)
_D_SCALED = [c for c in _D_NUM if c != D_TARGET]
_D_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _D_SCALED)
_D_BASE = f"""WITH m AS (SELECT * FROM {_M} mm), med AS (SELECT {_D_MED} FROM m),
i AS (SELECT {_D_IMP}, {_D_CODES}, m.l_shipdate, m.ship_text, m.l_orderkey AS k_order, m.l_linenumber AS k_line FROM m, med),
s AS (SELECT {_D_STATS} FROM i)"""
_D_OUT = (", ".join(f"round((i.{c} - s.m_{c}) / {_sd('s.s_' + c)}, 4) + 0.0 AS {c}" for c in _D_SCALED)
          + f", round(i.{D_TARGET}, 4) AS {D_TARGET}, " + ", ".join(f"i.{c}" for c in _D_CAT)
          + ", CAST(year(i.l_shipdate) AS INTEGER) AS l_shipdate_year, CAST(month(i.l_shipdate) AS INTEGER) AS l_shipdate_month,"
          + " CAST(day(i.l_shipdate) AS INTEGER) AS l_shipdate_day,"
          + f" CAST(year({_ts_sql('i.ship_text')}) AS INTEGER) AS ship_text_year,"
          + f" CAST(month({_ts_sql('i.ship_text')}) AS INTEGER) AS ship_text_month,"
          + f" CAST(day({_ts_sql('i.ship_text')}) AS INTEGER) AS ship_text_day")


# ===========================================================================
# D. Preparation (target qty_text: imputed, not scaled)
# ===========================================================================

@query("d1_preprocess", f"{_D_BASE} SELECT {_D_OUT} FROM i, s")
def d1_preprocess(spark, sf):
    _, _, out, _ = _messy_prepared(spark, sf)
    return _round_doubles(out)


@query("d2_drop_sparse", f"SELECT column_name, missing_pct FROM ({O.profile_sql('lineitem_messy')}) p WHERE missing_pct > 60")
def d2_drop_sparse(spark, sf):
    info = P.collect_info(P.profile(V.lineitem_messy(spark, sf), distinct="none"))
    return spark.createDataFrame([(c, info.columns[c].missing_pct) for c in D.sparse_columns(info)], "column_name string, missing_pct double")


@query("d3_median_impute", f"{_D_BASE} SELECT k_order AS l_orderkey, k_line AS l_linenumber, "
       f"round(i.disc_nulls, 4) AS disc_nulls, round(i.qty_text, 4) AS qty_text FROM i")
def d3_median_impute(spark, sf):
    df = V.lineitem_messy(spark, sf)
    med = D.fit_medians(df, ["disc_nulls", "qty_text"])
    imp = D.impute(med)
    return df.select(*_KEYS, *[F.round(e, 4).alias(c) for c, e in imp.items()])


@query("d4_standard_scale", f"{_D_BASE} SELECT k_order AS l_orderkey, k_line AS l_linenumber, "
       + ", ".join(f"round((i.{c} - s.m_{c}) / {_sd('s.s_' + c)}, 4) + 0.0 AS {c}_scaled" for c in _D_SCALED)
       + " FROM i, s")
def d4_standard_scale(spark, sf):
    df = V.lineitem_messy(spark, sf)
    imp = D.impute(D.fit_medians(df, _D_SCALED))
    sc = D.fit_scalers(df, imp)
    return df.select(*_KEYS, *[(F.round(D.scale(imp[c], *sc[c]), 4) + F.lit(0.0)).alias(f"{c}_scaled") for c in _D_SCALED])


@query("d5_fill_missing", f"SELECT l_orderkey, l_linenumber, coalesce(CAST(flag_text AS VARCHAR), 'missing') AS flag_text FROM {_M} m")
def d5_fill_missing(spark, sf):
    df = V.lineitem_messy(spark, sf)
    return df.select(*_KEYS, D.as_category(F.col("flag_text"), D.MISSING_TOKEN).alias("flag_text"))


def _dict_sql(cols: list[str], token: str, rel: str = _M) -> str:
    return O.union_all([
        f"SELECT {O.lit(c)} AS column_name, v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT coalesce(CAST({O.q(c)} AS VARCHAR), {O.lit(token)}) AS v FROM {rel} r) d"
        for c in cols])


@query("d6_label_encoding", _dict_sql(_D_CAT, "missing"))
def d6_label_encoding(spark, sf):
    return D.fit_dictionary(V.lineitem_messy(spark, sf), _D_CAT, D.MISSING_TOKEN)


@query("d7_date_parts", f"""SELECT l_orderkey, l_linenumber,
  CAST(year(l_shipdate) AS INTEGER) AS l_shipdate_year, CAST(month(l_shipdate) AS INTEGER) AS l_shipdate_month,
  CAST(day(l_shipdate) AS INTEGER) AS l_shipdate_day,
  CAST(year({_ts_sql('ship_text')}) AS INTEGER) AS ship_text_year,
  CAST(month({_ts_sql('ship_text')}) AS INTEGER) AS ship_text_month,
  CAST(day({_ts_sql('ship_text')}) AS INTEGER) AS ship_text_day FROM {_M} m""")
def d7_date_parts(spark, sf):
    df = V.lineitem_messy(spark, sf)
    parts = {**D.date_parts(df, "l_shipdate"), **D.date_parts(df, "ship_text")}
    return df.select(*_KEYS, *[e.alias(n) for n, e in parts.items()])


_TEXT_DATES = [c for c, _, _ in V.DATE_TEXTS]


@query("d7_text_dates", f"""SELECT l_orderkey, l_linenumber, {", ".join(
    f"CAST({p}(moment) AS INTEGER) AS {c}_{p}" for c in _TEXT_DATES for p in ("year", "month", "day"))} FROM ({V.LINEITEM_DATES_SQL}) v""")
def d7_text_dates(spark, sf):
    """Date parts of every text layout; the order of day and month is settled by each column as a whole."""
    df = V.lineitem_dates(spark, sf)
    day_first = dates.day_first_columns(df, _TEXT_DATES)
    parts = {n: e for c in _TEXT_DATES for n, e in D.date_parts(df, c, c in day_first).items()}
    return df.select(*_KEYS, *[e.alias(n) for n, e in parts.items()])


@query("d8_drop_text", f"SELECT table_name, column_name FROM ({O.profiles_sql(PROFILED)}) p WHERE semantic_type = 'text'")
def d8_drop_text(spark, sf):
    infos = {t: P.collect_info(P.profile(V.relation(spark, sf, t), distinct="hybrid")) for t in PROFILED}
    return spark.createDataFrame([(t, c) for t, info in infos.items() for c in D.text_columns(info)], "table_name string, column_name string")


@query("d9_fitted_params", f"""{_D_BASE}
SELECT column_name, kind, round(median, 4) AS median, round(mean, 4) AS mean, round(std, 4) AS std, n_codes FROM (
""" + "\nUNION ALL\n".join(
    [f"SELECT {O.lit(c)} AS column_name, 'numeric' AS kind, (SELECT {c} FROM med) AS median, "
     + (f"(SELECT m_{c} FROM s) AS mean, (SELECT s_{c} FROM s) AS std, " if c != D_TARGET else
        "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, ")
     + "CAST(NULL AS BIGINT) AS n_codes" for c in _D_NUM] +
    [f"SELECT {O.lit(c)}, 'categorical', NULL, NULL, NULL, (SELECT count(DISTINCT coalesce(CAST({c} AS VARCHAR), 'missing')) FROM m)"
     for c in _D_CAT]) + ") x")
def d9_fitted_params(spark, sf):
    _, _, _, fitted = _messy_prepared(spark, sf)
    return _round_doubles(fitted.params(spark).select("column_name", "kind", "median", "mean", "std", "n_codes"))


@query("d9_decode", f"SELECT k AS row_key, {', '.join(f"coalesce(CAST({c} AS VARCHAR), 'missing') AS {c}" for c in _D_CAT)} "
       f"FROM (SELECT *, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS k FROM {_M} mm) m")
def d9_decode(spark, sf):
    df = V.lineitem_messy(spark, sf)
    dictionary = D.fit_dictionary(df, _D_CAT, D.MISSING_TOKEN)
    sizes = {r["column_name"]: r["n"] for r in dictionary.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    codes = D.encode(df.select(*_KEYS, *_D_CAT), dictionary, _D_CAT, sizes, D.MISSING_TOKEN)
    return D.decode(codes, dictionary, _D_CAT).select(F.concat_ws("|", *[F.col(k).cast("string") for k in _KEYS]).alias("row_key"), *_D_CAT)


# ===========================================================================
# E. Training-set preparation
# ===========================================================================

E_TARGET = "l_linestatus"
_E_NUM = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "disc_nulls", "tax_sparse",
          "const_one", "qty_text"]
_E_ENC = ["l_returnflag", "ship_text", "flag_text"]
_E_PARTS = {"l_shipdate_year": "year(m.l_shipdate)", "l_shipdate_month": "month(m.l_shipdate)",
            "l_shipdate_day": "day(m.l_shipdate)"}
_E_FEATS = _E_NUM + _E_ENC + list(_E_PARTS)
_E_RAW = ", ".join([f"CAST(m.{c} AS DOUBLE) AS {c}" for c in _E_NUM] +
                   [f"CAST(dense_rank() OVER (ORDER BY coalesce(CAST(m.{c} AS VARCHAR), 'nan')) - 1 AS DOUBLE) AS {c}"
                    for c in _E_ENC] +
                   [f"CAST({e} AS DOUBLE) AS {n}" for n, e in _E_PARTS.items()])
_E_BASE = f"""WITH m AS (SELECT * FROM {_M} mm),
r AS (SELECT {_E_RAW}, m.{E_TARGET} AS {E_TARGET} FROM m),
med AS (SELECT {", ".join(f"median({c}) AS {c}" for c in _E_FEATS)} FROM r),
i AS (SELECT {", ".join(f"coalesce(r.{c}, med.{c}) AS {c}" for c in _E_FEATS)}, r.{E_TARGET} FROM r, med),
s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _E_FEATS)} FROM i)"""


def _messy_features(spark, sf):
    df = V.lineitem_messy(spark, sf)
    info = P.collect_info(P.profile(df))
    return df, D.fit_features(df, info, E_TARGET)


@query("e1_feature_roles", f"""SELECT column_name, CASE WHEN column_name = '{E_TARGET}' THEN 'target'
  WHEN semantic_type = 'text' THEN 'dropped' ELSE 'feature' END AS role FROM ({O.profile_sql('lineitem_messy')}) p""")
def e1_feature_roles(spark, sf):
    df = V.lineitem_messy(spark, sf)
    roles = D.feature_roles(df, P.collect_info(P.profile(df, distinct="hybrid")), E_TARGET)
    shown = [(c, r if r in ("target", "dropped") else "feature") for c, r in roles.items()]
    return spark.createDataFrame(shown, "column_name string, role string")


@query("e2_encode_all", _dict_sql(_E_ENC, "nan"))
def e2_encode_all(spark, sf):
    _, fm = _messy_features(spark, sf)
    return fm.dictionary


@query("e3_impute_all", f"{_E_BASE} SELECT {', '.join(f'round({c}, 4) AS {c}' for c in _E_FEATS)}, {E_TARGET} FROM i")
def e3_impute_all(spark, sf):
    df, fm = _messy_features(spark, sf)
    return _round_doubles(fm.transform(df, scaled=False).select(*fm.features, E_TARGET))


@query("e4_scale_all", f"{_E_BASE} SELECT "
       + ", ".join(f"round((i.{c} - s.m_{c}) / {_sd('s.s_' + c)}, 4) + 0.0 AS {c}" for c in _E_FEATS)
       + f", i.{E_TARGET} FROM i, s")
def e4_scale_all(spark, sf):
    df, fm = _messy_features(spark, sf)
    return _round_doubles(fm.transform(df).select(*fm.features, E_TARGET))


_T = f"({V.LINEITEM_TARGETS_SQL})"


@query("e6_target_encoding", f"""SELECT 'qty_band' AS target_name, value, CAST(row_number() OVER (ORDER BY value) - 1 AS DOUBLE) AS label
FROM (SELECT DISTINCT qty_band AS value FROM {_T} t) d
UNION ALL
SELECT 'l_linenumber', CAST(value AS VARCHAR), CAST(row_number() OVER (ORDER BY value) - 1 AS DOUBLE)
FROM (SELECT DISTINCT l_linenumber AS value FROM lineitem) d""")
def e6_target_encoding(spark, sf):
    t = V.lineitem_targets(spark, sf)
    out = []
    for name in ("qty_band", "l_linenumber"):
        _, mapping = D.encode_target(t, name)
        out.append(mapping.select(F.lit(name).alias("target_name"), F.col("value").cast("string").alias("value"), "label"))
    return union_all(out)


_KEY_SQL = "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)"
_MD5_SQL = f"md5({_KEY_SQL} || '#42')"


def _row_key() -> F.Column:
    return F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("row_key")


@query("e7_hash_split", f"SELECT {_KEY_SQL} AS row_key, {_MD5_SQL} < '{SPLIT_BOUND}' AS is_validation FROM lineitem")
def e7_hash_split(spark, sf):
    li = V.load_testdata(spark, sf, "lineitem")
    return D.hash_split(li, _KEYS).select(_row_key(), "is_validation")


@query("e7_stratified_split", f"""SELECT {_KEY_SQL} AS row_key, qty_band,
  row_number() OVER (PARTITION BY qty_band ORDER BY {_MD5_SQL}, l_orderkey, l_linenumber) - 1
    < ceil(count(*) OVER (PARTITION BY qty_band) * 0.2) AS is_validation FROM {_T} t""")
def e7_stratified_split(spark, sf):
    t = V.lineitem_targets(spark, sf)
    out, _ = D.split(t, "qty_band", _KEYS, stratify=True, exact=True)
    return out.select(_row_key(), "qty_band", "is_validation")


def _rare_view(spark, sf) -> DataFrame:
    """One row (the smallest split hash) gets its own class 'rare'."""
    t = V.lineitem_targets(spark, sf).withColumn("__h", md5_key("l_orderkey", "l_linenumber"))
    first = t.agg(F.min("__h").alias("__h"), F.lit(True).alias("__rare"))
    return (t.join(F.broadcast(first), "__h", "left")
            .withColumn("label", F.when(F.col("__rare"), F.lit("rare")).otherwise(F.col("qty_band")))
            .drop("__h", "__rare"))


_RARE_SQL = f"""(SELECT *, CASE WHEN h = (SELECT min(h) FROM k0) THEN 'rare' ELSE qty_band END AS label
FROM (SELECT *, {_MD5_SQL} AS h FROM {_T} t) k1)"""
_RARE_CTE = f"WITH k0 AS (SELECT {_MD5_SQL} AS h FROM {_T} t), rv AS (SELECT * FROM {_RARE_SQL} x)"


@query("e8_split_fallback", f"""{_RARE_CTE}
SELECT {_KEY_SQL} AS row_key, label, h < '{SPLIT_BOUND}' AS is_validation, false AS stratified FROM rv""")
def e8_split_fallback(spark, sf):
    rv = _rare_view(spark, sf)
    out, stratified = D.split(rv, "label", _KEYS, stratify=True)
    return out.select(_row_key(), "label", "is_validation", F.lit(stratified).alias("stratified"))


@query("e9_train_relabel", f"""{_RARE_CTE}
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS DOUBLE) AS train_label
FROM (SELECT DISTINCT label FROM rv WHERE NOT (h < '{SPLIT_BOUND}')) d""")
def e9_train_relabel(spark, sf):
    rv, _ = D.split(_rare_view(spark, sf), "label", _KEYS, stratify=True)
    _, mapping = D.relabel_from_train(rv, "label")
    return mapping


@query("e10_unseen_class_filter", f"""{_RARE_CTE}
SELECT {_KEY_SQL} AS row_key, label FROM rv WHERE h < '{SPLIT_BOUND}'
  AND label IN (SELECT label FROM rv WHERE NOT (h < '{SPLIT_BOUND}'))""")
def e10_unseen_class_filter(spark, sf):
    rv, _ = D.split(_rare_view(spark, sf), "label", _KEYS, stratify=True)
    kept, _ = D.relabel_from_train(rv, "label")
    return kept.where("is_validation").select(_row_key(), "label")


_SMALL = {"region": "r_regionkey", "nation": "n_nationkey", "supplier": "s_suppkey", "customer": "c_custkey"}


@query("e11_validate_on_train", O.union_all([
    f"SELECT {O.lit(t)} AS table_name, count(*) FILTER (WHERE NOT v) AS n_train, count(*) FILTER (WHERE v) AS n_validation, "
    f"CASE WHEN count(*) FILTER (WHERE v) = 0 THEN 'train' ELSE 'validation' END AS validated_on "
    f"FROM (SELECT md5(CAST({k} AS VARCHAR) || '#42') < '{SPLIT_BOUND}' AS v FROM {t}) s" for t, k in _SMALL.items()]))
def e11_validate_on_train(spark, sf):
    out = []
    for t, k in _SMALL.items():
        s = D.hash_split(V.load_testdata(spark, sf, t), [k])
        out.append(D.validation_report(s).select(F.lit(t).alias("table_name"), "n_train", "n_validation", "validated_on"))
    return union_all(out)


@query("e13_class_weights", f"""SELECT 'qty_band' AS target_name, value, n_class,
  round(sum(n_class) OVER () / (count(*) OVER () * n_class), 6) AS weight
FROM (SELECT qty_band AS value, count(*) AS n_class FROM {_T} t GROUP BY 1) c
UNION ALL
SELECT 'toxic', value, n_class, round(sum(n_class) OVER () / (count(*) OVER () * n_class), 6)
FROM (SELECT CAST(toxic AS VARCHAR) AS value, count(*) AS n_class FROM labels GROUP BY 1) c""")
def e13_class_weights(spark, sf):
    t = V.lineitem_targets(spark, sf).select(F.col("qty_band").alias("value"))
    lab = V.load_testdata(spark, sf, "labels").select(F.col("toxic").cast("string").alias("value"))
    out = []
    for name, df in (("qty_band", t), ("toxic", lab)):
        w = D.class_weights(df, "value")
        out.append(w.select(F.lit(name).alias("target_name"), "value", "n_class", F.round("weight", 6).alias("weight")))
    return union_all(out)


# Positional feature names, truncated to the first n or zero-padded to n
_E_ALIGN_TRUNC = 8
_E_ALIGN_PAD = 20


@query("e5_align_features", f"{_E_BASE} SELECT "
       + ", ".join(f"round((i.{c} - s.m_{c}) / {_sd('s.s_' + c)}, 4) + 0.0 AS f_{k}" for k, c in enumerate(_E_FEATS[:_E_ALIGN_TRUNC]))
       + " FROM i, s")
def e5_align_features(spark, sf):
    df, fm = _messy_features(spark, sf)
    x = fm.transform(df)
    return _round_doubles(D.align_features(x, fm.features, _E_ALIGN_TRUNC))


@query("e12_pad_columns", f"{_E_BASE} SELECT "
       + ", ".join(f"round((i.{c} - s.m_{c}) / {_sd('s.s_' + c)}, 4) + 0.0 AS f_{k}" for k, c in enumerate(_E_FEATS))
       + ", " + ", ".join(f"CAST(0.0 AS DOUBLE) AS f_{k}" for k in range(len(_E_FEATS), _E_ALIGN_PAD))
       + " FROM i, s")
def e12_pad_columns(spark, sf):
    df, fm = _messy_features(spark, sf)
    x = fm.transform(df)
    return _round_doubles(D.align_features(x, fm.features, _E_ALIGN_PAD))
