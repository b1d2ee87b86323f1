"""Aggregates with the missing-value rules the reconciliation reports rely on.

* a sum over a group is NULL as soon as one input is NULL;
* a distinct count counts NULL as one more value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_sum(c) -> Column:
    """Sum that is NULL when any input is NULL (no silent skipping)."""
    c = _c(c)
    return F.when(F.max(c.isNull().cast("int")) == 1, F.lit(None)).otherwise(F.sum(c))


def distinct_with_null(c) -> Column:
    """Number of distinct values, NULL counted as one value."""
    c = _c(c)
    return F.count_distinct(c) + F.max(c.isNull().cast("int")).cast("long")


def count_where(cond: Column) -> Column:
    """Rows where ``cond`` is TRUE (NULL counts as not TRUE)."""
    return F.count(F.when(cond, F.lit(1)))
