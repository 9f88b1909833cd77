"""Edge cases."""

import pytest
from pyspark.sql import functions as F

from quillstat.operators import eda as E
from quillstat.operators import metrics as G
from quillstat.operators import prepare as D
from quillstat.operators import profile as P
from quillstat.sources.readers import normalise_missing, prepare_input, strip_headers


def test_header_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a ` int, ` a` int")
    with pytest.raises(ValueError):
        strip_headers(df)


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, s string")
    prof = {r["column_name"]: r for r in P.profile(df).collect()}
    assert prof["x"]["n_rows"] == 0 and prof["x"]["missing_pct"] == 0.0
    assert D.fit_medians(df, ["x"]) == {"x": None}


def test_one_row_and_constant_and_all_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, None)], "a double, c double, n double")
    s = {r["column_name"]: r for r in E.numeric_summary(df, ["a", "c", "n"]).collect()}
    assert s["a"]["std"] is None and s["a"]["skew"] is None and s["n"]["mean"] is None
    const = spark.createDataFrame([(1.0, float(i)) for i in range(10)], "k double, x double")
    r = {(x["col_x"], x["col_y"]): x["r"] for x in E.correlation(const, ["k", "x"]).collect()}
    assert r[("k", "x")] is None and r[("x", "x")] == 1.0
    sk = {r["column_name"]: r["skew"] for r in E.numeric_summary(const, ["k"]).collect()}
    assert sk["k"] == 0.0


def test_missing_tokens_and_inference(spark):
    df = spark.createDataFrame([("1", "NA", "2020-01-02"), ("2", "x", "2020-01-03"), ("", "null", None)],
                               "a string, b string, d string")
    out = prepare_input(df)
    assert dict(out.dtypes)["a"] == "double"        # a missing value turns integers into floats
    assert out.where(F.col("b").isNull()).count() == 2
    prof = {r["column_name"]: r["semantic_type"] for r in P.profile(out).collect()}
    assert prof["d"] == "datetime"


def test_single_class_and_rare_class_split(spark):
    df = spark.createDataFrame([(i, "a" if i else "b") for i in range(50)], "k long, y string")
    assert not D.can_stratify(df, "y")
    out, stratified = D.split(df, "y", ["k"], stratify=True)
    assert not stratified and out.count() == 50


def test_metrics_zero_division(spark):
    preds = spark.createDataFrame([("m", 0, "a", "b"), ("m", 0, "b", "b")], "model string, ordinal int, label string, prediction string")
    r = G.classification_metrics(preds).first()
    assert r["accuracy"] == 0.5 and r["f1_macro"] == round((0 + 2 / 3) / 2, 4)


def test_r2_constant_truth(spark):
    p = spark.createDataFrame([("m", 0, 1.0, 1.0), ("m", 0, 1.0, 1.0)], "model string, ordinal int, label double, prediction double")
    assert G.regression_metrics(p).first()["r2"] == 1.0
    q = spark.createDataFrame([("m", 0, 1.0, 2.0), ("m", 0, 1.0, 1.0)], "model string, ordinal int, label double, prediction double")
    assert G.regression_metrics(q).first()["r2"] == 0.0


def test_target_over_missing_threshold_raises(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(10)], "x double, y double")
    info = P.collect_info(P.profile(normalise_missing(df)))
    with pytest.raises(ValueError):
        D.preprocess(df, info, "y")


def test_samples_in_file_order(spark):
    df = spark.createDataFrame([(1, "z"), (2, "b"), (3, "z"), (4, "a"), (5, None), (6, "c")], "line int, v string")
    got = [r["sample_value"] for r in P.sample_values(df, k=3, order_col="line").orderBy("sample_rank").collect()]
    assert got == ["z", "b", "a"]
    assert [r["sample_value"] for r in P.sample_values(df.drop("line"), k=3).orderBy("sample_rank").collect()] == ["a", "b", "c"]


def test_present_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert E.present_columns(df, ["b", "x", "a"]) == ["b", "a"]


def test_numeric_columns_equal_profile_rule(spark, small_dir):
    from quillstat.plans import views as V
    for t in ("lineitem_messy", "orders", "events"):
        rel = V.relation(spark, small_dir, t)
        assert P.numeric_columns(rel) == P.collect_info(P.profile(rel)).of_type("numeric")


def test_class_tables_are_broadcast_whatever_spark_estimates(spark):
    """A shuffle join on two classes would bring half of all rows into one task."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select("id", (F.col("id") % 2).alias("y"), (F.col("id") % 5 == 0).alias("is_validation"))
        rows, _ = D.encode_target(df, "y", n_hint=2)
        kept, _ = D.relabel_from_train(rows, n_hint=2)
        for out in (rows, kept):
            assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, kept.groupBy("train_label").count().collect())) == [(0.0, 500), (1.0, 500)]
        many, _ = D.encode_target(df, "id", n_hint=D.CLASS_TABLE_ROWS + 1)      # not proven small: left to Spark
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rebalance_broadcasts_its_class_tables(spark):
    from quillstat.operators import protocol as K
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(60).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3 == 0).alias("y"), F.col("id").cast("double").alias("a"))
        out = K.rebalance(df, "y", "k", ["a"])
        assert out._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 1      # rows and their neighbours, by row
        assert sorted(map(tuple, out.groupBy("y", "synthetic").count().collect())) == [(False, False, 40), (True, False, 20), (True, True, 20)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_exact_counts_read_each_column_alone_and_dates_texts_only(spark):
    """Exact distinct counts do not repeat whole rows, and numbers do not pass through the reading of dates."""
    from quillstat.operators import profile as P
    df = spark.createDataFrame([(i % 7, float(i % 3) if i % 5 else None, f"2024-01-{1 + i % 9:02d}", "x" * (i % 50) + "y") for i in range(100)],
                               "a int, b double, day string, word string")
    prof = P.profile(df)
    plan = prof._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    read = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert read and not any("a#" in line or "b#" in line for line in read)
    got = {r.column_name: (r.n_unique, r.n_missing, r.semantic_type) for r in prof.collect()}
    assert got == {"a": (7, 0, "numeric"), "b": (3, 20, "numeric"), "day": (9, 0, "datetime"), "word": (50, 0, "categorical")}


def test_number_texts_by_first_character(spark):
    """The test of the first character before the pattern leaves no number out."""
    from quillstat.sources.readers import type_decisions
    texts = ["1", " 2", "\t3 ", "+4", "-5.", ".5", "1e9", "inf", "-Infinity", "INF", "iNf", " inf"]
    others = [":", "I", "i", "x1", "", " ", "+", "1x", "\u0661", "nan", "infinite", "e5", "1\u00a0"]
    numbers = {f"n{i}": t for i, t in enumerate(texts)} | {f"o{i}": t for i, t in enumerate(others)}
    got = {r.column_name: r.inferred_type for r in type_decisions(spark.createDataFrame([tuple(numbers.values())], [*numbers])).collect()}
    assert all(got[c] in ("bigint", "double") for c in numbers if c[0] == "n") and all(got[c] == "string" for c in numbers if c[0] == "o")
    assert got["n0"] == got["n1"] == got["n3"] == "bigint"
