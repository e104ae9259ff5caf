"""Evaluating an expression once for each row, and a pattern's groups in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "\u0001"


def once(df: DataFrame, keep: list[str], **cols: Column) -> DataFrame:
    """``keep`` and ``cols``, which are evaluated exactly once per row.  They are
    produced by a one-element ``inline`` generator, so neither a later filter on them
    nor a lambda that reads them often can evaluate them again."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))))


def groups(v: Column, pattern: str, n: int) -> Column:
    """The ``n`` groups of a pattern as an array, NULL when the line does not match.

    Lines without the separator character (all real ones) take one regex
    pass: the rewrite of a matching line splits into exactly ``n`` parts, a
    non-matching line comes back unchanged as one part.  A line that itself
    contains the separator falls back to one extraction per group."""
    rewrite = SEPARATOR.join(f"${i}" for i in range(1, n + 1))
    parts = F.split(F.regexp_replace(v, pattern + r"(?s:.*)", rewrite), SEPARATOR)
    exact = F.array(*[F.regexp_extract(v, pattern, i) for i in range(1, n + 1)])
    return (F.when(F.instr(v, SEPARATOR) == 0, F.when(F.size(parts) == n, parts))
            .when(v.rlike(pattern), exact))
