"""Narrative facts and question routing.

The language-model call itself is not built; what remains is data work: the
grounded fact lines a prompt is filled with (one row per line, built with
``format_string`` over the EDA and leaderboard tables) and the parsing of a
table of model replies with ``from_json``.  Numbers are printed with
``%.4f`` so the text does not depend on an engine's double-to-text rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.functions.exprs import strip_ws

# Route reply fields and the defaults used when a reply cannot be parsed.
ROUTE_FIELDS = ["task", "target_col", "question_type", "rephrased"]
ROUTE_DEFAULT_TASK = "eda"
ROUTE_DEFAULT_QUESTION_TYPE = "exploration"
ROUTE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in ROUTE_FIELDS] +
                            [T.StructField("_corrupt_record", T.StringType())])


def num(c: Column | str, fmt: str = "%.4f") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.format_string(fmt, c), F.lit("nan"))


def py_list(items: Column) -> Column:
    """Render an array of strings like a Python list: ['a', 'b']."""
    quoted = F.transform(items, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.concat_ws(", ", quoted), F.lit("]"))


def eda_facts(report: DataFrame, top: DataFrame) -> DataFrame:
    """One line per numeric or categorical column, in column order.

    ``report``: C1 rows (ordinal, column_name, semantic_type, missing_pct,
    n_unique, mean, std, ...); ``top``: C4 rows (column_name, value_rank, value).
    """
    top3 = (top.where(F.col("value_rank") <= 3).groupBy("column_name")
            .agg(F.sort_array(F.collect_list(F.struct("value_rank", "value"))).alias("__t"))
            .select("column_name", F.col("__t.value").alias("top3")))
    r = report.join(F.broadcast(top3), "column_name", "left")
    numeric = F.format_string("- %s (numeric): mean=%s, std=%s, missing=%s%%", F.col("column_name"),
                              num("mean"), num("std"), num("missing_pct", "%.2f"))
    categorical = F.format_string("- %s (categorical): %d unique values, top: %s, missing=%s%%",
                                  F.col("column_name"), F.col("n_unique"),
                                  py_list(F.coalesce("top3", F.array().cast("array<string>"))),
                                  num("missing_pct", "%.2f"))
    line = (F.when(F.col("semantic_type") == "numeric", numeric)
            .when(F.col("semantic_type") == "categorical", categorical))
    return r.select("ordinal", "column_name", line.alias("line")).where(F.col("line").isNotNull())


def result_facts(board: DataFrame, task: str, short: bool = False) -> DataFrame:
    """J2 (and J3's shorter form): one metrics line per model."""
    if task == "classification":
        line = (F.format_string("- %s: Accuracy=%s, F1=%s", F.col("model"), num("accuracy"), num("f1_weighted"))
                if short else
                F.format_string("- %s: Accuracy=%s, F1 Weighted=%s, F1 Macro=%s", F.col("model"),
                                num("accuracy"), num("f1_weighted"), num("f1_macro")))
    else:
        line = (F.format_string("- %s: R2=%s, RMSE=%s", F.col("model"), num("r2"), num("rmse"))
                if short else
                F.format_string("- %s: R2=%s, RMSE=%s, MAE=%s", F.col("model"), num("r2"), num("rmse"), num("mae")))
    return board.select("model", "ordinal", line.alias("line"))


def question_context(prof: DataFrame, board: DataFrame, task: str) -> DataFrame:
    """Context lines for a question — performance first, then columns.

    Rows (section, ordinal, line).
    """
    perf = result_facts(board, task, short=True).select(F.lit("performance").alias("section"), "ordinal", "line")
    cols = prof.select(F.lit("columns").alias("section"), "ordinal",
                       F.format_string("- %s: %s, missing=%s%%", F.col("column_name"), F.col("semantic_type"),
                                       num("missing_pct", "%.2f")).alias("line"))
    return perf.unionByName(cols)


def top_feature_context(top5: DataFrame) -> DataFrame:
    """The top features as one list line (input has at most 5 rows)."""
    return top5.agg(py_list(F.transform(F.sort_array(F.collect_list(F.struct("position", "feature"))),
                                        lambda s: s["feature"])).alias("top_features"))


def parse_routes(replies: DataFrame, text: str = "reply", question: str = "question") -> DataFrame:
    """Strip code fences and whitespace, parse the JSON route, default on failure.

    A reply that fails to parse gets all defaults (task 'eda', no target,
    'exploration', the original question); a valid reply with missing keys
    keeps its nulls.  Adds ``parsed`` (bool).
    """
    clean = strip_ws(F.replace(F.replace(strip_ws(F.col(text)), F.lit("```json"), F.lit("")),
                               F.lit("```"), F.lit("")))
    # read as the only element of a list: trailing text or a second object then makes it malformed
    kind = T.ArrayType(T.StructType([f for f in ROUTE_SCHEMA.fields if f.name != "_corrupt_record"]))
    parsed = F.from_json(F.concat(F.lit("["), clean, F.lit("]")), kind, {"allowSingleQuotes": "false"})
    out = replies.withColumn("__l", parsed).withColumn("__p", F.get("__l", F.lit(0)))
    ok = F.coalesce((F.size("__l") == 1) & F.col("__p").isNotNull() & clean.startswith("{"), F.lit(False))
    return out.select(
        *[c for c in replies.columns],
        F.when(ok, F.col("__p.task")).otherwise(F.lit(ROUTE_DEFAULT_TASK)).alias("task"),
        F.when(ok, F.col("__p.target_col")).alias("target_col"),
        F.when(ok, F.col("__p.question_type")).otherwise(F.lit(ROUTE_DEFAULT_QUESTION_TYPE)).alias("question_type"),
        F.when(ok, F.col("__p.rephrased")).otherwise(F.col(question)).alias("rephrased"),
        ok.alias("parsed"))


def recent_questions(conversations: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` user questions of each conversation, newest first.

    The rank limit is applied per task before the shuffle (window-group
    limit), so a very long conversation never gathers in one task.
    """
    w = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return (conversations.where(F.col("role") == "user")
            .withColumn("recency", F.row_number().over(w).cast("int"))
            .where(F.col("recency") <= n)
            .select("conv_id", "recency", "turn", F.col("text").alias("question")))
