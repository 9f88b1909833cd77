"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from quillstat.functions.exprs import *  # noqa: F401,F403
