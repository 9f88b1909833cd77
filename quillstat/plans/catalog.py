"""Query catalogue: one Spark query per SURVEY §2 operator, with its SQL twin.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the driver's tables
(whole tables, no row caps); ``ORACLE[name]`` is the same definition in SQL
for DuckDB.  Names are ``<id>_<snake_name>``.  Operators whose result depends
on a fitted model or on randomised trees have no SQL twin (rows-only check)
and are covered by property tests instead.
"""

from quillstat.plans import catalog_abc, catalog_de, catalog_g, catalog_hij, catalog_fk  # noqa: F401  (registration)
from quillstat.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
