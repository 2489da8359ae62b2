"""NULL and zero rules of the reports, as Column helpers.

Two membership rules coexist and must not be unified:

* client-side ``x %in% set`` is FALSE for a missing x, so its negation keeps
  missing values                         -> ``in_set`` / ``not_in_set``
* warehouse SQL ``x NOT IN (...)`` is NULL for a missing x, so the row is
  dropped unless ``OR x IS NULL`` is written -> ``sql_not_in`` / ``not_in_or_null``
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_set(c: Column, values: Iterable) -> Column:
    """Membership that is FALSE (not NULL) for a NULL input."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def not_in_set(c: Column, values: Iterable) -> Column:
    """Negated client membership: keeps NULL inputs."""
    return ~in_set(c, values)


def sql_not_in(c: Column, values: Iterable) -> Column:
    """SQL ``NOT IN``: a NULL input is not kept (the predicate is NULL)."""
    return ~c.isin(list(values))


def not_in_or_null(c: Column, values: Iterable) -> Column:
    """SQL ``(x NOT IN (..) OR x IS NULL)``."""
    return (~c.isin(list(values))) | c.isNull()


def cond_sum(pred: Column, x: Column) -> Column:
    """Sum of ``x`` where ``pred`` holds; 0 (not NULL) when nothing qualifies."""
    return F.coalesce(F.sum(F.when(pred, x)), F.lit(0))


def cond_count(pred: Column) -> Column:
    """Rows where ``pred`` is TRUE (NULL counts as not true)."""
    return F.count(F.when(pred, F.lit(1)))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b as double; NULL instead of Inf/NaN/errors for a zero or NULL divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def na_subtract(a: Column, b: Column) -> Column:
    """a - b with a missing side read as zero."""
    return F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))


def fill_bads(x: Column) -> Column:
    """NaN -> NULL, negative -> 0, NULL stays NULL."""
    return F.when(x.isNull() | F.isnan(x), F.lit(None)).otherwise(F.greatest(x, F.lit(0.0)))


def round_half_even(x: Column, digits: int = 0) -> Column:
    """Client-side rounding of the reports (banker's rounding).

    Scaled to an integer first (x * 10^digits is one IEEE product), then
    rounded at the integer, where a half is exactly representable, so the
    result does not depend on how an engine turns a double into decimal text.
    """
    if digits == 0:
        return F.bround(x, 0)
    f = float(10 ** digits)
    return F.bround(x * f, 0) / f


def round_half_up(x: Column, digits: int = 0) -> Column:
    """Warehouse rounding (half away from zero), computed like ``round_half_even``."""
    if digits == 0:
        return F.round(x, 0)
    f = float(10 ** digits)
    return F.round(x * f, 0) / f
