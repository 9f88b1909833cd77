"""Derived views over the driver tables (FIXTURES F-C), each with its SQL twin.

The base tables carry no nulls and no learnable signal, so nulls, constants,
text-typed numbers and learnable targets are injected by fixed rules that are
written once in Spark and once in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.functions.exprs import NA_TOKENS
from quillstat.sources.readers import load_testdata, prepare_input


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_testdata(spark, sf_dir, name)


# ---------------------------------------------------------------------------
# lineitem with nulls, a constant, text numbers, text dates and missing tokens
# ---------------------------------------------------------------------------

def lineitem_messy_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
        "l_linestatus", "l_shipdate",
        F.when(ln != 3, F.col("l_discount")).alias("disc_nulls"),
        F.when(ln <= 1, F.col("l_tax")).alias("tax_sparse"),
        F.lit(1.0).cast("double").alias("const_one"),
        F.when(ln == 4, "NA").when(ln == 5, "").when(ln == 6, "null")
         .otherwise(F.col("l_quantity").cast("string")).alias("qty_text"),
        F.col("l_shipdate").cast("date").cast("string").alias("ship_text"),
        F.when(ln == 7, "n/a").otherwise(F.col("l_returnflag")).alias("flag_text"),
    )


LINEITEM_MESSY_RAW_SQL = """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
  l_linestatus, l_shipdate,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS disc_nulls,
  CASE WHEN l_linenumber > 1 THEN NULL ELSE l_tax END AS tax_sparse,
  CAST(1.0 AS DOUBLE) AS const_one,
  CASE l_linenumber WHEN 4 THEN 'NA' WHEN 5 THEN '' WHEN 6 THEN 'null'
       ELSE CAST(l_quantity AS VARCHAR) END AS qty_text,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_text,
  CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE l_returnflag END AS flag_text
FROM lineitem"""


def na_sql(expr: str) -> str:
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"CASE WHEN {expr} IN ({toks}) THEN NULL ELSE {expr} END"


def lineitem_messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messy view after A2-A4 (qty_text is inferred as DOUBLE)."""
    return prepare_input(lineitem_messy_raw(spark, sf_dir))


LINEITEM_MESSY_SQL = f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
  l_linestatus, l_shipdate, disc_nulls, tax_sparse, const_one,
  TRY_CAST({na_sql('qty_text')} AS DOUBLE) AS qty_text,
  {na_sql('ship_text')} AS ship_text,
  {na_sql('flag_text')} AS flag_text
FROM ({LINEITEM_MESSY_RAW_SQL}) raw"""

# ---------------------------------------------------------------------------
# lineitem's ship time as text of many layouts
# ---------------------------------------------------------------------------

#: column, Spark layout, strptime layout; the time of day comes from the order key
DATE_TEXTS = [
    ("iso_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"),
    ("iso_offset", "yyyy-MM-dd HH:mm:ss'+05:30'", "%Y-%m-%d %H:%M:%S+05:30"),
    ("minutes", "yyyy/MM/dd HH:mm", "%Y/%m/%d %H:%M"),
    ("fraction", "yyyy-MM-dd HH:mm:ss.SSSSSS", "%Y-%m-%d %H:%M:%S.%f"),
    ("month_first", "M/d/yyyy", "%-m/%-d/%Y"),
    ("day_first", "dd/MM/yyyy", "%d/%m/%Y"),
    ("dotted", "d.M.yyyy HH:mm", "%-d.%-m.%Y %H:%M"),
    ("named", "dd-MMM-yyyy", "%d-%b-%Y"),
    ("spelt", "MMMM d, yyyy", "%B %-d, %Y"),
]


def lineitem_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``DATE_TEXTS``, and texts that are no dates as a whole: two layouts in one column, an impossible day, dates with remarks."""
    t = (_t(spark, sf_dir, "lineitem")
         .withColumn("at", F.timestamp_add("SECOND", (F.col("l_orderkey") % 86400).cast("int"), F.col("l_shipdate").cast("timestamp_ntz"))))
    return t.select("l_orderkey", "l_linenumber", "at", *[F.date_format("at", fmt).alias(c) for c, fmt, _ in DATE_TEXTS],
                    F.when(F.col("l_linenumber") == 1, F.date_format("at", "yyyy-MM-dd")).otherwise(F.date_format("at", "M/d/yyyy")).alias("two_layouts"),
                    F.when(F.col("l_linenumber") == 1, "2024-02-30").otherwise(F.date_format("at", "yyyy-MM-dd")).alias("impossible"),
                    F.concat(F.date_format("at", "yyyy-MM-dd"), F.lit(" about")).alias("remark"))


LINEITEM_DATES_SQL = f"""SELECT l_orderkey, l_linenumber, moment, {", ".join(f"strftime(moment, '{fmt}') AS {c}" for c, _, fmt in DATE_TEXTS)},
  CASE WHEN l_linenumber = 1 THEN strftime(moment, '%Y-%m-%d') ELSE strftime(moment, '%-m/%-d/%Y') END AS two_layouts,
  CASE WHEN l_linenumber = 1 THEN '2024-02-30' ELSE strftime(moment, '%Y-%m-%d') END AS impossible,
  strftime(moment, '%Y-%m-%d') || ' about' AS remark
FROM (SELECT *, CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_orderkey % 86400) AS moment FROM lineitem) x"""


MESSY_KINDS = [
    ("l_orderkey", "numeric"), ("l_linenumber", "numeric"), ("l_quantity", "numeric"),
    ("l_extendedprice", "numeric"), ("l_returnflag", "string"), ("l_linestatus", "string"),
    ("l_shipdate", "temporal"), ("disc_nulls", "numeric"), ("tax_sparse", "numeric"),
    ("const_one", "numeric"), ("qty_text", "numeric"), ("ship_text", "string"),
    ("flag_text", "string"),
]

# Column kinds of the base tables used by the profile queries.
TABLE_KINDS = {
    "orders": [("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_orderstatus", "string"),
               ("o_totalprice", "numeric"), ("o_orderdate", "temporal"), ("o_orderpriority", "string")],
    "customer": [("c_custkey", "numeric"), ("c_name", "string"), ("c_nationkey", "numeric"),
                 ("c_acctbal", "numeric"), ("c_mktsegment", "string")],
    "part": [("p_partkey", "numeric"), ("p_name", "string"), ("p_brand", "string"),
             ("p_type", "string"), ("p_size", "numeric"), ("p_retailprice", "numeric")],
    "events": [("event_id", "numeric"), ("ts", "temporal"), ("user_id", "numeric"),
               ("event_type", "string"), ("value", "numeric"), ("props", "string")],
    "labels": [("doc_id", "numeric"), ("quality", "numeric"), ("toxic", "numeric")],
    "documents": [("doc_id", "numeric"), ("text", "string"), ("lang", "string"),
                  ("source", "string"), ("n_chars", "numeric")],
    "lineitem_messy": MESSY_KINDS,
}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A profiled relation by name, after A2-A4."""
    if name == "lineitem_messy":
        return lineitem_messy(spark, sf_dir)
    return prepare_input(_t(spark, sf_dir, name))


def relation_sql(name: str) -> str:
    """SQL twin of ``relation`` (base tables hold no missing tokens)."""
    if name == "lineitem_messy":
        return f"({LINEITEM_MESSY_SQL})"
    cols = ", ".join(na_sql(c) + f" AS {c}" if k == "string" else c for c, k in TABLE_KINDS[name])
    return f"(SELECT {cols} FROM {name})"


# ---------------------------------------------------------------------------
# Learnable targets and rule predictions
# ---------------------------------------------------------------------------

def lineitem_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression, binary and three-class targets derived from lineitem."""
    li = _t(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
        net.alias("net_price"),
        (net > 40000).cast("int").alias("is_big"),
        F.when(F.col("l_quantity") < 16, "low").when(F.col("l_quantity") < 33, "mid")
         .otherwise("high").alias("qty_band"),
    )


LINEITEM_TARGETS_SQL = """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS net_price,
  CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) > 40000 AS INTEGER) AS is_big,
  CASE WHEN l_quantity < 16 THEN 'low' WHEN l_quantity < 33 THEN 'mid' ELSE 'high' END AS qty_band
FROM lineitem"""


def order_status_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rule 'models' guessing o_orderstatus from o_totalprice bands.

    Rows (model, ordinal, row_key, label, prediction).  Deterministic, so every
    metric can be checked in SQL without a fitted model.
    """
    o = _t(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    rules = [
        ("price_bands", F.when(p < 150000, "F").when(p < 300000, "O").otherwise("P")),
        ("price_split", F.when(p < 200000, "F").otherwise("O")),
        ("always_open", F.lit("O")),
        ("status_echo", F.col("o_orderstatus")),  # a leak: perfect score, flagged suspicious
    ]
    return _one_scan(o, rules, F.col("o_orderkey"), F.col("o_orderstatus"))


def _one_scan(df: DataFrame, rules, key, label) -> DataFrame:
    """One row per (input row, rule) from a single scan: an inline of one
    struct per rule, instead of a union that would read the table per rule."""
    structs = [F.struct(F.lit(name).alias("model"), F.lit(i).alias("ordinal"), pred.alias("prediction"))
               for i, (name, pred) in enumerate(rules)]
    return (df.select(key.alias("row_key"), label.alias("label"), F.inline(F.array(*structs)))
            .select("model", "ordinal", "row_key", "label", "prediction"))


ORDER_STATUS_RULES_SQL = """SELECT 'price_bands' AS model, 0 AS ordinal, o_orderkey AS row_key, o_orderstatus AS label,
  CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 300000 THEN 'O' ELSE 'P' END AS prediction FROM orders
UNION ALL SELECT 'price_split', 1, o_orderkey, o_orderstatus,
  CASE WHEN o_totalprice < 200000 THEN 'F' ELSE 'O' END FROM orders
UNION ALL SELECT 'always_open', 2, o_orderkey, o_orderstatus, 'O' FROM orders
UNION ALL SELECT 'status_echo', 3, o_orderkey, o_orderstatus, o_orderstatus FROM orders"""


def net_price_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rule regressors of net_price. Rows (model, ordinal, row_key, label, prediction)."""
    t = lineitem_targets(spark, sf_dir)
    key = F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    rules = [
        ("gross_price", F.col("l_extendedprice")),
        ("discounted", F.col("l_extendedprice") * (1 - F.col("l_discount"))),
        ("exact", F.col("net_price")),
    ]
    return _one_scan(t, [(n, p.cast("double")) for n, p in rules], key, F.col("net_price"))


NET_PRICE_RULES_SQL = f"""WITH t AS ({LINEITEM_TARGETS_SQL}),
k AS (SELECT *, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS row_key FROM t)
SELECT 'gross_price' AS model, 0 AS ordinal, row_key, net_price AS label, l_extendedprice AS prediction FROM k
UNION ALL SELECT 'discounted', 1, row_key, net_price, l_extendedprice * (1 - l_discount) FROM k
UNION ALL SELECT 'exact', 2, row_key, net_price, net_price FROM k"""
