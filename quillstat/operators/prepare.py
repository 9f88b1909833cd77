"""Preparation and training-set preparation.

Fitted parameters are of two sizes:

* one number per column (median, mean, population std): computed by fused
  aggregates and held on the driver as a small dict;
* one code per distinct value (label dictionaries): kept as a distributed
  DataFrame ``(column_name, value, code)``, built by a sort-based global rank,
  and joined back.  A dictionary is broadcast only when the profile's distinct
  count proves it is below ``broadcast_limit``; otherwise the join shuffles.

Splits are row-local hashes of a key (no shuffle); the exact stratified split
ranks rows within their class through a global sort rather than a
per-class window, so a class holding a third of the rows is still spread over
all tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.functions import dates
from quillstat.functions.exprs import DROP_MISSING_PCT, in_validation, md5_key
from quillstat.operators.profile import DatasetInfo
from quillstat.operators.ranking import exact_medians, global_rank

BROADCAST_LIMIT = 1_000_000
CLASS_TABLE_ROWS = 10_000   # classes of which a table is broadcast to every task
MISSING_TOKEN = "missing"   # D5
NAN_TOKEN = "nan"           # E2


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------------------
# Column decisions from the profile (driver-side, one row per column)
# ---------------------------------------------------------------------------

def sparse_columns(info: DatasetInfo, threshold: float = DROP_MISSING_PCT) -> list[str]:
    """Columns with missing_pct strictly above the threshold."""
    return [c.name for c in info.columns.values() if c.missing_pct > threshold]


def text_columns(info: DatasetInfo) -> list[str]:
    """Free-text columns, which the prepared table leaves out."""
    return [c.name for c in info.columns.values() if c.semantic_type == "text"]


def feature_roles(df: DataFrame, info: DatasetInfo, target: str, exclude: list[str] | None = None) -> dict[str, str]:
    """The role of every profiled column that ``df`` has.

    ``target``; ``excluded`` (row keys and the like); ``numeric``; ``temporal``
    (timestamps, which become date parts); ``encoded`` (categories and dates in
    text); ``dropped`` (free text).
    """
    roles = {}
    for c in info.columns.values():
        if c.name not in df.columns:
            continue
        physical = df.schema[c.name].dataType
        if c.name == target:
            roles[c.name] = "target"
        elif c.name in set(exclude or []):
            roles[c.name] = "excluded"
        elif c.semantic_type == "numeric":
            roles[c.name] = "numeric"
        elif isinstance(physical, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            roles[c.name] = "temporal"
        else:
            roles[c.name] = "encoded" if c.semantic_type in ("categorical", "datetime") else "dropped"
    return roles


# ---------------------------------------------------------------------------
# Numeric parameters
# ---------------------------------------------------------------------------

def fit_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """D3: exact interpolated medians (distributed band selection)."""
    return exact_medians(df, cols)


def impute(cols: dict[str, float | None]) -> dict[str, Column]:
    """D3: ``coalesce(c, median)``; an all-missing column stays null."""
    return {c: (F.coalesce(_q(c).cast("double"), F.lit(m)) if m is not None else _q(c).cast("double"))
            for c, m in cols.items()}


def fit_scalers(df: DataFrame, exprs: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """Mean and population std of each (imputed) column in one aggregate."""
    if not exprs:
        return {}
    names = list(exprs)
    row = df.agg(*[F.avg(exprs[c]).alias(f"m{i}") for i, c in enumerate(names)],
                 *[F.stddev_pop(exprs[c]).alias(f"s{i}") for i, c in enumerate(names)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(names)}


def scale(expr: Column, mean: float | None, std: float | None) -> Column:
    """(x - mean) / std, with std 0 (constant column) replaced by 1."""
    if mean is None:
        return expr
    s = 1.0 if (std is None or std == 0 or math.isnan(std)) else std
    return (expr - F.lit(mean)) / F.lit(s)


# ---------------------------------------------------------------------------
# Label dictionaries
# ---------------------------------------------------------------------------

def as_category(c: Column, token: str) -> Column:
    """Text form of a value with missing replaced by ``token``."""
    return F.coalesce(c.cast("string"), F.lit(token))


LOCAL_RANK_LIMIT = 1_000_000


def fit_dictionary(df: DataFrame, cols: list[str], token: str = MISSING_TOKEN,
                   sizes: dict[str, int] | None = None, local_limit: int = LOCAL_RANK_LIMIT) -> DataFrame:
    """Sorted distinct text values of each column numbered 0..k-1.

    Rows (column_name, value, code).  All columns are stacked into one
    relation and deduplicated map-side.  When ``sizes`` (from the profile)
    prove every column has at most ``local_limit`` values, each column's
    distinct values are numbered by a window partitioned by column (one job,
    bounded per task); otherwise they are globally ranked by (column, value)
    through a sort and offset by each column's first rank.
    """
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, value string, code int")
    names = F.array(*[F.lit(c) for c in cols])
    stacked = (df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), as_category(_q(c), token).alias("value"))
        for i, c in enumerate(cols)])).alias("e")).select("e.*").distinct())
    if sizes is not None and all(sizes.get(c, local_limit + 1) <= local_limit for c in cols):
        w = Window.partitionBy("ordinal").orderBy("value")
        return stacked.select(F.element_at(names, F.col("ordinal") + 1).alias("column_name"), "value",
                              (F.row_number().over(w) - 1).cast("int").alias("code"))
    ranked = global_rank(stacked, [F.col("ordinal"), F.col("value")], "r")
    starts = ranked.groupBy("ordinal").agg(F.min("r").alias("r0"))
    return (ranked.join(F.broadcast(starts), "ordinal")
            .select(F.element_at(names, F.col("ordinal") + 1).alias("column_name"), "value",
                    (F.col("r") - F.col("r0")).cast("int").alias("code")))


def encode(df: DataFrame, dictionary: DataFrame, cols: list[str], sizes: dict[str, int],
           token: str = MISSING_TOKEN, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Replace each column by its code; unseen values get null.

    ``sizes`` are the dictionary sizes known from the profile (distinct count
    plus one for the missing token), so the broadcast decision needs no job.
    """
    for c in cols:
        d = (dictionary.where(F.col("column_name") == c)
             .select(F.col("value").alias("__v"), F.col("code").alias("__code")))
        if sizes.get(c, broadcast_limit + 1) <= broadcast_limit:
            d = F.broadcast(d)
        df = (df.withColumn("__v", as_category(_q(c), token))
              .join(d, "__v", "left")
              .withColumn(c, F.col("__code"))
              .drop("__v", "__code"))
    return df


# ---------------------------------------------------------------------------
# Datetime parts
# ---------------------------------------------------------------------------


def decode(df: DataFrame, dictionary: DataFrame, cols: list[str]) -> DataFrame:
    """The inverse of ``encode``: every code becomes its value again.

    A missing value comes back as the dictionary's missing token; null and codes
    that the dictionary does not hold become null.  The dictionary's part for a column
    is left to Spark's size check: a broadcast if small, else a shuffle join.
    """
    for c in cols:
        part = dictionary.where(F.col("column_name") == c).select(F.col("code").alias("__code"), F.col("value").alias("__value"))
        rest = [_q(x) for x in df.columns]
        at = df.columns.index(c)
        df = (df.join(part, _q(c).cast("double") == F.col("__code").cast("double"), "left")
              .select(*rest[:at], F.col("__value").alias(c), *rest[at + 1:]))
    return df


def parse_any(c: Column, dtype: T.DataType, day_first: bool = False) -> Column:
    """D7 parse: timestamps pass; text is read by its shape; failures become null."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c
    return dates.wall_time(c.cast("string"), day_first)


def date_parts(df: DataFrame, col: str, day_first: bool = False) -> dict[str, Column]:
    """Year, month and day; ``day_first`` as ``dates.day_first_columns`` finds it for the whole column."""
    ts = parse_any(_q(col), df.schema[col].dataType, day_first)
    return {f"{col}_year": F.year(ts), f"{col}_month": F.month(ts), f"{col}_day": F.dayofmonth(ts)}


# ---------------------------------------------------------------------------
# The reference's stand-alone preprocessing
# ---------------------------------------------------------------------------

@dataclass
class Prepared:
    """What ``preprocess`` fitted; ``params()`` shows it as a table."""
    target: str | None
    dropped_sparse: list[str]
    dropped_text: list[str]
    numeric: list[str]
    categorical: list[str]
    datetime: list[str]
    medians: dict[str, float | None]
    scalers: dict[str, tuple[float, float]]
    dictionary: DataFrame
    dict_sizes: dict[str, int]
    output_columns: list[str] = field(default_factory=list)

    def params(self, spark) -> DataFrame:
        rows = []
        for c in self.numeric:
            m, s = self.scalers.get(c, (None, None))
            rows.append((c, "numeric", self.medians.get(c), m, s))
        for c in self.categorical:
            rows.append((c, "categorical", None, None, None))
        small = spark.createDataFrame(rows, "column_name string, kind string, median double, mean double, std double")
        sizes = self.dictionary.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_codes"))
        return small.join(sizes, "column_name", "left")


def preprocess(df: DataFrame, info: DatasetInfo, target: str | None = None,
               broadcast_limit: int = BROADCAST_LIMIT) -> tuple[DataFrame, Prepared]:
    """D1-D8 in the reference's column order; date parts appended at the end."""
    sparse = sparse_columns(info)
    if target is not None and target in sparse:
        raise ValueError(f"target {target!r} is over {DROP_MISSING_PCT}% missing and would be dropped")
    cols = [c for c in info.columns if c in df.columns and c not in sparse]
    kind = {c: info.columns[c].semantic_type for c in cols}
    numeric = [c for c in cols if kind[c] == "numeric"]
    categorical = [c for c in cols if kind[c] == "categorical"]
    datetime = [c for c in cols if kind[c] == "datetime"]
    text = [c for c in text_columns(info) if c in cols]

    medians = fit_medians(df, numeric)
    imputed = impute(medians)
    scalers = fit_scalers(df, {c: imputed[c] for c in numeric if c != target})
    sizes = {c: info.columns[c].n_unique + 1 for c in categorical}
    dictionary = fit_dictionary(df, categorical, MISSING_TOKEN, sizes).persist(StorageLevel.MEMORY_AND_DISK)

    out = encode(df, dictionary, categorical, sizes, MISSING_TOKEN, broadcast_limit)
    exprs: list[Column] = []
    names: list[str] = []
    for c in cols:
        if c in numeric:
            e = imputed[c] if c == target else scale(imputed[c], *scalers[c])
            exprs.append(e.alias(c))
            names.append(c)
        elif c in categorical:
            exprs.append(_q(c).alias(c))
            names.append(c)
    day_first = dates.day_first_columns(df, [c for c in datetime if isinstance(df.schema[c].dataType, T.StringType)])
    for c in datetime:
        for n, e in date_parts(df, c, c in day_first).items():
            exprs.append(e.alias(n))
            names.append(n)
    prepared = out.select(*exprs)
    return prepared, Prepared(target, sparse, text, numeric, categorical, datetime, medians, scalers,
                              dictionary, sizes, names)


# ---------------------------------------------------------------------------
# E: training-set preparation
# ---------------------------------------------------------------------------

def row_key(df: DataFrame, keys: list[str] | None = None) -> Column:
    """Explicit row key: given key columns, else a content hash of the row."""
    cols = keys or df.columns
    return F.concat_ws("|", *[_q(c).cast("string") for c in cols]) if keys else md5_key(*[_q(c) for c in cols], seed=0)


def hash_split(df: DataFrame, keys: list[str], flag: str = "is_validation") -> DataFrame:
    """E7 default: row-local hash split, 20% validation, seed 42; no shuffle."""
    return df.withColumn(flag, in_validation(*keys))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class; tiny (classification targets have at most 20 classes)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))


def can_stratify(df: DataFrame, label: str, test_fraction: float = 0.2) -> bool:
    """Stratifying needs two rows in every class, and on either side of the
    split at least as many rows as there are classes."""
    row = class_counts(df, label).agg(F.min("n_class").alias("m"), F.count(F.lit(1)).alias("k"), F.sum("n_class").alias("n")).first()
    if row["m"] is None or row["m"] < 2:
        return False
    test = math.ceil(row["n"] * test_fraction)
    return test >= row["k"] and row["n"] - test >= row["k"]


def stratified_split(df: DataFrame, label: str, keys: list[str], flag: str = "is_validation",
                     test_fraction: float = 0.2) -> DataFrame:
    """E7 exact: per class, the first ceil(0.2 n_class) rows in md5 order.

    Rank within class = global rank in (label, md5, key) order minus the
    class's first global rank (from the per-class counts, one row per class).
    """
    h = md5_key(*keys)
    keyed = df.withColumn("__h", h)
    order = [F.col(label), F.col("__h")] + [_q(k) for k in keys]
    ranked = global_rank(keyed, order, "__g")
    w = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    starts = (class_counts(df, label)
              .select(label, "n_class", F.coalesce(F.sum("n_class").over(w), F.lit(0)).alias("__start")))
    return (ranked.join(F.broadcast(starts), label)
            .withColumn(flag, (F.col("__g") - F.col("__start")) < F.ceil(F.col("n_class") * F.lit(test_fraction)))
            .drop("__h", "__g", "__start", "n_class"))


def split(df: DataFrame, label: str | None, keys: list[str], stratify: bool,
          exact: bool = False) -> tuple[DataFrame, bool]:
    """E7 + E8: stratified when asked and possible, else the plain hash split.

    Returns (rows with ``is_validation``, stratified?).  The default hash split
    is stratified in expectation (each class is cut by the same hash bound);
    ``exact=True`` gives exactly ceil(20%) of every class.
    """
    if stratify and label is not None and can_stratify(df, label):
        if exact:
            return stratified_split(df, label, keys), True
        return hash_split(df, keys), True
    return hash_split(df, keys), False


def _small_rank(distinct: DataFrame, col: str, out: str, n_hint: int | None) -> DataFrame:
    """Number sorted distinct values 0..k-1 as DOUBLE: a single-partition window
    when the profile proves k small, else the sort-based global rank."""
    if n_hint is not None and n_hint <= LOCAL_RANK_LIMIT:
        return distinct.select(col, (F.row_number().over(Window.orderBy(col)) - 1).cast("double").alias(out))
    return global_rank(distinct, [F.col(col)], out).select(col, F.col(out).cast("double"))


def class_table(table: DataFrame, n_hint: int | None) -> DataFrame:
    """A table of one row per class, broadcast when the profile proves the classes few.

    Spark's own estimate takes its size from the whole input, and a shuffle join on the
    class would bring all rows of a class into one task.
    """
    return F.broadcast(table) if n_hint is not None and n_hint <= CLASS_TABLE_ROWS else table


def encode_target(df: DataFrame, target: str, label_col: str = "label",
                  n_hint: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Target values numbered in their native order (numbers numerically).

    Returns (rows with ``label`` DOUBLE, mapping (value, label)).  The mapping
    is broadcast where ``n_hint`` proves it small, as are those of E9 and E10.
    """
    distinct = df.select(_q(target).alias("value")).where(F.col("value").isNotNull()).distinct()
    mapping = _small_rank(distinct, "value", "label", n_hint)
    out = df.join(class_table(mapping.withColumnRenamed("value", target), n_hint), target, "left")
    return out.withColumnRenamed("label", label_col) if label_col != "label" else out, mapping


def relabel_from_train(df: DataFrame, label: str = "label", flag: str = "is_validation",
                       n_hint: int | None = None) -> tuple[DataFrame, DataFrame]:
    """E9 + E10: contiguous labels from the classes seen in train; validation
    rows of unseen classes are dropped (left-semi on the small class table)."""
    train_classes = df.where(~F.col(flag)).select(label).distinct()
    mapping = _small_rank(train_classes, label, "train_label", n_hint)
    kept = df.join(class_table(train_classes, n_hint), label, "left_semi")
    return kept.join(class_table(mapping, n_hint), label), mapping


def validation_or_train(df: DataFrame, flag: str = "is_validation") -> tuple[DataFrame, DataFrame, bool]:
    """(train, validation, validated_on_train?) — validate on train when
    the validation side is empty."""
    train = df.where(~F.col(flag))
    val = df.where(F.col(flag))
    if val.isEmpty():
        return train, train, True
    return train, val, False


def validation_report(df: DataFrame, flag: str = "is_validation") -> DataFrame:
    """E11 as one row: rows to train on, rows held out, and the side that metrics are taken on."""
    held = F.count(F.when(F.col(flag), 1))
    return df.agg(F.count(F.when(~F.col(flag), 1)).alias("n_train"), held.alias("n_validation"),
                  F.when(held == 0, "train").otherwise("validation").alias("validated_on"))


def class_weights(df: DataFrame, label: str = "label", weight_col: str = "weight") -> DataFrame:
    """Balanced weights n / (k * n_class).

    Computed on the per-class counts (at most 20 rows for a classification
    target), so the whole-table window here spans that small table only.
    """
    counts = class_counts(df, label)
    everything = Window.partitionBy()
    return counts.select(label, "n_class",
                         (F.sum("n_class").over(everything) /
                          (F.count(F.lit(1)).over(everything) * F.col("n_class"))).alias(weight_col))


def with_class_weights(df: DataFrame, label: str = "label", weight_col: str = "weight") -> DataFrame:
    return df.join(class_weights(df, label, weight_col).drop("n_class"), label)


# ---------------------------------------------------------------------------
# The training feature matrix
# ---------------------------------------------------------------------------

def pad_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns that ``df`` lacks, as zeros behind its own (no join by position)."""
    return df.withColumns({n: F.lit(0.0) for n in names if n not in df.columns})


def align_features(df: DataFrame, features: list[str], n: int, prefix: str = "f_", keep: list[str] | None = None) -> DataFrame:
    """E5: the first ``n`` features as ``f_0 .. f_(n-1)``; if there are fewer, zeros fill up.

    ``keep`` names other columns to carry along (row key, label).
    """
    names = [f"{prefix}{k}" for k in range(n)]
    clash = sorted(set(keep or []) & set(names))
    if clash:
        raise ValueError(f"columns to keep have the names of features: {clash}")
    return pad_columns(df.select(*[_q(c) for c in keep or []], *[_q(c).alias(a) for c, a in zip(features, names)]), names)


@dataclass
class FeatureModel:
    """Fitted training preparation; ``transform`` applies it to any rows
    (training, validation, scenario tables or a stream)."""
    target: str
    numeric: list[str]
    encoded: list[str]
    temporal: list[str]
    dropped: list[str]
    medians: dict[str, float | None]
    scalers: dict[str, tuple[float, float]]
    dictionary: DataFrame
    dict_sizes: dict[str, int]
    features: list[str] = field(default_factory=list)

    def raw_features(self, df: DataFrame) -> DataFrame:
        """E2 + date parts: every feature as a (possibly null) double, unscaled."""
        out = encode(df, self.dictionary, self.encoded, self.dict_sizes, NAN_TOKEN)
        cols = {}
        for c in self.numeric:
            cols[c] = _q(c).cast("double")
        for c in self.encoded:
            cols[c] = _q(c).cast("double")
        for c in self.temporal:
            for n, e in date_parts(df, c).items():
                cols[n] = e.cast("double")
        keep = [x for x in out.columns if x not in cols]
        return out.select(*[_q(x) for x in keep], *[e.alias(n) for n, e in cols.items()])

    def transform(self, df: DataFrame, scaled: bool = True) -> DataFrame:
        """E3 + E4: median-impute then scale every kept feature."""
        raw = self.raw_features(df)
        imputed = impute({c: self.medians[c] for c in self.features})
        exprs = {c: scale(imputed[c], *self.scalers[c]) if scaled else imputed[c] for c in self.features}
        others = [x for x in raw.columns if x not in self.medians]
        return raw.select(*[_q(x) for x in others], *[e.alias(c) for c, e in exprs.items()])


def fit_features(df: DataFrame, info: DatasetInfo, target: str, fit_rows: DataFrame | None = None,
                 exclude: list[str] | None = None, broadcast_limit: int = BROADCAST_LIMIT) -> FeatureModel:
    """Fit E2-E4 on ``fit_rows`` (the training rows by default in the analysis;
    all rows gives the reference's behaviour).

    Numbers are imputed and scaled; text columns of categorical or datetime
    type are label-encoded with missing as ``"nan"`` (E2); timestamp columns
    become year/month/day; free text is dropped (documented deviation);
    features with no value at all are dropped (E3).
    """
    fit_rows = fit_rows if fit_rows is not None else df
    roles = feature_roles(df, info, target, exclude)
    numeric, encoded, temporal, dropped = ([c for c, r in roles.items() if r == role]
                                           for role in ("numeric", "encoded", "temporal", "dropped"))
    # +1 for the missing token, +10% headroom for an estimated distinct count
    sizes = {c: int(info.columns[c].n_unique * 1.1) + 1 for c in encoded}
    dictionary = fit_dictionary(fit_rows, encoded, NAN_TOKEN, sizes).persist(StorageLevel.MEMORY_AND_DISK)
    model = FeatureModel(target, numeric, encoded, temporal, dropped, {}, {}, dictionary, sizes)
    raw = model.raw_features(fit_rows)
    candidates = numeric + encoded + [f"{c}_{p}" for c in temporal for p in ("year", "month", "day")]
    medians = fit_medians(raw, candidates)
    kept = [c for c in candidates if medians[c] is not None]
    model.dropped += [c for c in candidates if medians[c] is None]
    imputed = impute({c: medians[c] for c in kept})
    model.medians = {c: medians[c] for c in kept}
    model.scalers = fit_scalers(raw, imputed)
    model.features = kept
    return model
