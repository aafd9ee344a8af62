"""Reshape: metadata-driven column selection and wide -> long unpivot.

The column list is resolved from ``df.columns`` when the plan is built (no
dynamic SQL text); the unpivot itself is ``DataFrame.unpivot`` (an ``Expand``
that keeps NULL values, unlike SQL ``UNPIVOT``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import like_to_regex

# Fixed selection of the surveyed workload: question columns are ``P%`` or ``VFI``.
SURVEY_INCLUDE = ("P%", "VFI")


def select_columns_like(
    columns: Sequence[str],
    include: Sequence[str] = SURVEY_INCLUDE,
    exclude: Sequence[str] = (),
    case_sensitive: bool = False,
) -> list[str]:
    """Columns matching any ``include`` LIKE pattern and no ``exclude`` pattern, in
    column order. Matching is case-insensitive by default (a case-insensitive
    collation); note ``P%`` also selects e.g. ``Provincia``. Raises when nothing matches."""
    flags = 0 if case_sensitive else re.IGNORECASE
    inc = [re.compile(like_to_regex(p), flags) for p in include]
    exc = [re.compile(like_to_regex(p), flags) for p in exclude]
    out = [c for c in columns if any(r.match(c) for r in inc) and not any(r.match(c) for r in exc)]
    if not out:
        raise ValueError(f"no columns match {list(include)} (excluding {list(exclude)})")
    return out


def unpivot_to_text(
    df: DataFrame,
    ids: Sequence[str],
    value_columns: Sequence[str],
    name_col: str = "NOMBRE_CAMPO",
    value_col: str = "VALOR",
) -> DataFrame:
    """One output row per (input row, value column): ids, column name, value as text (NULLs kept)."""
    if not value_columns:
        raise ValueError("no value columns to unpivot")
    as_text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in value_columns])
    return as_text.unpivot(list(ids), list(value_columns), name_col, value_col)


def unpivot_values(df: DataFrame, exprs: Sequence[str], name: str) -> DataFrame:
    """Fixed unpivot of a few expressions into one column (``CROSS APPLY (VALUES ...)``)."""
    return df.select(F.explode(F.array(*[F.expr(e) for e in exprs])).alias(name))
