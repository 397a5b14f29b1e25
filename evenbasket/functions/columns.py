"""Column expressions shared by the operators. All built-in, JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ACTION_ADD, ACTION_REMOVE


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ticker_code(prefix: str, key: str | Column, width: int = 6) -> Column:
    """Ticker symbol for an integer key: prefix + key zero-padded to at least
    ``width`` digits (never truncated, so keys stay distinct at any scale)."""
    return F.format_string(f"{prefix}%0{width}d", col_(key))


def cents(c: str | Column) -> Column:
    """Money as whole cents (BIGINT); exact for 2-decimal amounts."""
    return F.rint(col_(c) * 100.0).cast("bigint")


def cents_sum(c: str | Column) -> Column:
    """Exact, order-independent sum of money in cents (BIGINT, hash-aggregatable)."""
    return F.sum(cents(c))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(col_(num), col_(den))


def round_to_long(c: str | Column) -> Column:
    """Round half-even then cast, as the reference's float -> BIGINT insert."""
    return F.rint(col_(c)).cast("bigint")


def is_priced(c: str | Column = "close") -> Column:
    """A bar can be ranked and bought only with a positive, known price (NaN is none)."""
    return col_(c).isNotNull() & ~F.isnan(col_(c).cast("double")) & (col_(c) > 0)


def currency_text(c: str | Column) -> Column:
    """'$1,234.50'; zero or missing renders '-'."""
    x = col_(c)
    return F.when(x.isNull() | (x == 0), F.lit("-")).otherwise(F.concat(F.lit("$"), F.format_number(x, 2)))


def percent_text(c: str | Column, times_100: bool = True) -> Column:
    """'12.34%' with two decimals, no grouping; optionally scales a fraction by 100."""
    x = col_(c) * 100 if times_100 else col_(c)
    return F.concat(F.call_function("format_number", x, F.lit("0.00")), F.lit("%"))


def action_display_class(c: str | Column) -> Column:
    """Colour label used when listing trades."""
    x = col_(c)
    # Display style per action tag.
    return F.when(x == ACTION_ADD, F.lit("color: green")).when(x == ACTION_REMOVE, F.lit("color: red")).otherwise(F.lit(""))


# Significant-digit tiers used to compare accumulated doubles between engines:
# |ref| >= 10^k rounds to (digits - 1 - k) decimals.
SIG_TIERS = range(9, -13, -1)


def round_sig(c: str | Column, ref: str | Column | None = None, digits: int = 9) -> Column:
    """Round ``c`` to about ``digits`` significant digits of ``ref`` (default ``c``).

    Spark's ``round`` takes a literal scale only, so the scale is picked from a
    fixed ladder of magnitudes. Use ``ref`` for differences (e.g. a share change
    rounded at the precision of the holding it changes).
    """
    x = col_(c)
    r = F.abs(col_(ref) if ref is not None else x)
    out = None
    for k in SIG_TIERS:
        branch = F.round(x, digits - 1 - k)
        out = F.when(r >= 10.0**k, branch) if out is None else out.when(r >= 10.0**k, branch)
    return out.otherwise(F.round(x, digits + 12))
