"""SQL text for the DuckDB twins of the catalogue queries.

Each builder writes the same definition as the Spark operator, in plain SQL,
over the driver's pre-registered views.
"""

from __future__ import annotations

from quillstat.functions.exprs import (
    DATETIME_FORMATS, INTEGER_PATTERN, MAX_CLASSES, MIN_REGRESSION_DISTINCT, NUMERIC_PATTERN,
    TEXT_RATIO,
)
from quillstat.plans.views import TABLE_KINDS, relation_sql


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


def profile_sql(table: str) -> str:
    """Rows (table_name, ordinal, column_name, semantic_type, n_rows, n_missing,
    missing_pct, n_unique, distinct_ratio) for one relation."""
    rel = relation_sql(table)
    parts = []
    for i, (c, kind) in enumerate(TABLE_KINDS[table]):
        col = q(c)
        nn, nu, n = f"count({col})", f"count(DISTINCT {col})", "count(*)"
        if kind == "numeric":
            st = "'numeric'"
        elif kind == "temporal":
            st = "'datetime'"
        else:
            parsed = "greatest(" + ", ".join(
                f"count(CASE WHEN regexp_full_match({col}, {lit(shape[1:-1])}) THEN try_strptime({col}, {lit(fmt)}) END)"
                for fmt, shape in DATETIME_FORMATS) + ")"
            st = (f"CASE WHEN {parsed} = {nn} THEN 'datetime' "
                  f"WHEN CAST({nu} AS DOUBLE) / greatest({n}, 1) > {TEXT_RATIO} THEN 'text' "
                  f"ELSE 'categorical' END")
        parts.append(
            f"SELECT {lit(table)} AS table_name, CAST({i} AS INTEGER) AS ordinal, {lit(c)} AS column_name, "
            f"{st} AS semantic_type, {n} AS n_rows, {n} - {nn} AS n_missing, "
            f"round(CAST(100.0 AS DOUBLE) * ({n} - {nn}) / greatest({n}, 1), 2) AS missing_pct, "
            f"{nu} AS n_unique, CAST({nu} AS DOUBLE) / greatest({n}, 1) AS distinct_ratio FROM {rel} t")
    return union_all(parts)


def date_layouts() -> list[tuple[str, str]]:
    """strptime layouts and the shapes of their texts: every date form with every time form."""
    n, y = "[0-9]{1,2}", "[0-9]{4}"
    days = [(f"%Y{s}%m{s}%d", f"{y}{r}{n}{r}{n}") for s, r in (("-", "-"), ("/", "/"))]
    days += [(f"%{a}{s}%{b}{s}%Y", f"{n}{r}{n}{r}{y}") for a, b in ("md", "dm") for s, r in (("/", "/"), (".", "[.]"), ("-", "-"))]
    days += [("%d-%b-%Y", f"{n}-[A-Za-z]+-{y}"), ("%B %d, %Y", f"[A-Za-z]+ {n}, {y}")]
    clock = f"{n}:[0-9]{{2}}"
    times = [("", ""), (" %H:%M", f" {clock}"), (" %H:%M:%S", f" {clock}:[0-9]{{2}}"), ("T%H:%M:%S", f"T{clock}:[0-9]{{2}}"),
             ("T%H:%M:%SZ", f"T{clock}:[0-9]{{2}}Z"), (" %H:%M:%S.%f", f" {clock}:[0-9]{{2}}[.][0-9]{{1,6}}"),
             (" %H:%M:%S%z", f" {clock}:[0-9]{{2}}[+-][0-9]{{2}}:[0-9]{{2}}")]
    return [(d + t, ds + ts) for d, ds in days for t, ts in times]


def date_types_sql(rel: str, cols: list[str]) -> str:
    """Rows (column_name, semantic_type) of text columns by ``date_layouts``."""
    def one(c: str) -> str:
        parsed = ", ".join(f"count(CASE WHEN regexp_full_match({q(c)}, {lit(shape)}) THEN try_strptime({q(c)}, {lit(fmt)}) END)" for fmt, shape in date_layouts())
        return (f"SELECT {lit(c)} AS column_name, CASE WHEN greatest({parsed}) = count({q(c)}) THEN 'datetime' "
                f"WHEN CAST(count(DISTINCT {q(c)}) AS DOUBLE) / greatest(count(*), 1) > {TEXT_RATIO} THEN 'text' ELSE 'categorical' END AS semantic_type FROM v")
    return f"WITH v AS MATERIALIZED ({rel}) " + union_all([one(c) for c in cols])


def profiles_sql(tables: list[str]) -> str:
    return union_all([profile_sql(t) for t in tables])


def flags_sql(tables: list[str]) -> str:
    """Profile rows with the target flags of B7-B9 (a SELECT usable as a CTE)."""
    ok = "NOT (lower(column_name) LIKE '%id%' OR lower(column_name) = 'index')"
    return f"""SELECT *, NOT ({ok}) AS id_excluded,
  ({ok}) AND ((semantic_type = 'categorical' AND n_unique BETWEEN 2 AND {MAX_CLASSES})
     OR (semantic_type = 'numeric' AND n_unique <= {MAX_CLASSES})) AS classification_target,
  ({ok}) AND semantic_type = 'numeric' AND n_unique > 2 AS regression_suggested,
  ({ok}) AND semantic_type = 'numeric' AND n_unique > {MIN_REGRESSION_DISTINCT} AS regression_target
FROM ({profiles_sql(tables)}) p"""


def samples_sql(table: str, k: int = 5, first_seen: bool = False) -> str:
    """The k smallest, or the k first seen, distinct values of every column."""
    rel = f"(SELECT *, row_number() OVER () AS place FROM {table})" if first_seen else relation_sql(table)
    order, source = ("place", "min(place) AS place, ") if first_seen else ("v", "")
    parts = []
    for c, _ in TABLE_KINDS[table]:
        col = q(c)
        parts.append(
            f"SELECT {lit(table)} AS table_name, {lit(c)} AS column_name, "
            f"CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS sample_rank, CAST(v AS VARCHAR) AS sample_value "
            f"FROM (SELECT {source}{col} AS v FROM {rel} t WHERE {col} IS NOT NULL GROUP BY {col}) d QUALIFY sample_rank <= {k}")
    return union_all(parts)


def infer_type_sql(col: str, rel: str) -> str:
    """A4 decision for one text column, as a scalar subquery result."""
    c = q(col)
    return (f"SELECT CASE WHEN count({c}) = 0 THEN 'double' "
            f"WHEN count(CASE WHEN regexp_full_match({c}, {lit(INTEGER_PATTERN[1:-1])}) "
            f"AND TRY_CAST({c} AS BIGINT) IS NOT NULL THEN 1 END) = count({c}) AND count({c}) = count(*) THEN 'bigint' "
            f"WHEN count(CASE WHEN regexp_full_match({c}, {lit(NUMERIC_PATTERN[1:-1])}) THEN 1 END) = count({c}) THEN 'double' "
            f"WHEN count(CASE WHEN {c} IN ('True','False','true','false','TRUE','FALSE') THEN 1 END) = count({c}) "
            f"AND count({c}) = count(*) THEN 'boolean' "
            f"ELSE 'string' END AS inferred_type FROM {rel} t")
