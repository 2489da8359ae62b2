"""Money: currency normalisation and currency text.

Amounts are divided by the currency's rate (units per USD) in double. Before
any sum they become whole *money units* of 1/10000 USD (``money``), so totals
are exact integers, independent of partitioning and summation order, and
identical in any engine: the rounding happens at the integer, where a half is
exactly representable. Totals leave a plan as double USD (``usd``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 10000
UNITS = "decimal(22,0)"


def to_usd(amount: Column, rate: Column) -> Column:
    """Local amount -> USD as double (NULL when either side is NULL)."""
    return amount / rate


def money(x: Column) -> Column:
    """USD double -> whole money units (1/10000 USD) for exact aggregation."""
    return F.round(x * SCALE).cast(UNITS)


def usd(units: Column) -> Column:
    """Money units (e.g. a sum of ``money``) -> USD double."""
    return units.cast("double") / F.lit(float(SCALE))


def scrub_usd(text: Column, allow_negative: bool = False) -> Column:
    """'USD 2,000.00' -> 2000.0.

    Any '-' makes the value missing (so negative amounts become NULL) unless
    ``allow_negative``; text that is not a number after cleaning is NULL.
    """
    return _scrub(F.regexp_replace(text, "USD ", ""), allow_negative)


def scrub_currency(text: Column, codes_pattern: Column, allow_negative: bool = False) -> Column:
    """Like :func:`scrub_usd` for every code of the currency table.

    ``codes_pattern`` is a regex alternation of '<CODE> ' built from the
    currency table (see :func:`currency_codes_pattern`), passed as a column so
    no driver code reads the table (the pattern is one scalar subquery, bounded by the list of codes).
    """
    return _scrub(F.regexp_replace(text, codes_pattern, F.lit("")), allow_negative)


def currency_codes_pattern(currency: DataFrame) -> Column:
    """Scalar subquery: '(USD |EUR |...)' from the currency table."""
    return currency.select(
        F.concat(F.lit("("),
                 F.concat_ws("|", F.array_sort(F.collect_set(F.concat(F.col("IsoCode"), F.lit(" "))))),
                 F.lit(")"))
    ).scalar()


def _scrub(no_code: Column, allow_negative: bool) -> Column:
    value = F.trim(F.regexp_replace(no_code, ",", "")).try_cast("double")
    if allow_negative:
        return value
    return F.when(no_code.contains("-"), F.lit(None).cast("double")).otherwise(value)


def format_money(x: Column, digits: int = 2) -> Column:
    """'$1,234.50' text."""
    return F.concat(F.lit("$"), F.format_number(x, digits))
