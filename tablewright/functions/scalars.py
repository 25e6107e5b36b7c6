"""Scalar expressions whose results must not depend on engine quirks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_skip_null(*parts: ColumnOrName) -> Column:
    """CONCAT: a NULL part counts as the empty string."""
    return F.concat(*[F.coalesce(as_column(p).cast("string"), F.lit("")) for p in parts])


def format_text(template: str, *args: ColumnOrName) -> Column:
    """FORMAT with ``%s`` places: a NULL argument prints nothing."""
    return F.format_string(
        template, *[F.coalesce(as_column(a).cast("string"), F.lit("")) for a in args]
    )


def whole_years(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole years from ``earlier`` to ``later``; negative when the order is reversed."""
    later, earlier = as_column(later), as_column(earlier)
    hi, lo = F.greatest(later, earlier), F.least(later, earlier)
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    years = F.year(hi) - F.year(lo) - (month_day(hi) < month_day(lo)).cast("int")
    # least/greatest skip NULL, so guard: no date, no age
    return F.when(
        later.isNotNull() & earlier.isNotNull(), F.when(later < earlier, -years).otherwise(years)
    ).cast("bigint")


def round_to_int(c: ColumnOrName) -> Column:
    """Assignment of a number to an INTEGER column: rounds half away from zero."""
    return F.round(as_column(c)).cast("int")


def money(c: ColumnOrName, precision: int = 18) -> Column:
    """Two decimals, rounded half away from zero."""
    return as_column(c).cast(f"decimal({precision},2)")


def above(amount: ColumnOrName, limits: dict[str, int], otherwise: str) -> Column:
    """The label of the first limit that ``amount`` exceeds; NULL exceeds none."""
    amount = as_column(amount)
    label = F
    for name, limit in limits.items():
        label = label.when(amount > limit, name)
    return label.otherwise(otherwise)


def three_bands(amount: ColumnOrName, bands: tuple[str, int, str, int, str]) -> Column:
    """Above the first limit, between both limits (inclusive), or the rest with NULL."""
    top, high, middle, low, rest = bands
    amount = as_column(amount)
    return F.when(amount > high, top).when(amount.between(low, high), middle).otherwise(rest)


def total(c: ColumnOrName) -> Column:
    """SUM of amounts of at most two decimals, with room for very large tables."""
    return F.sum(as_column(c).cast("decimal(28,2)"))


def average(c: ColumnOrName) -> Column:
    """ROUND(AVG(c), 2) of amounts of at most two decimals, rounded once; NULL when there is no value."""
    return ratio(total(c), F.count(as_column(c))).cast("decimal(18,2)")


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """ROUND(numerator / denominator, 2) of an amount and a whole number.

    Half away from zero; NULL when the denominator is zero. Worked out in whole cents:
    dividing a wide decimal would round to six digits first, and twice is once too often.
    """
    cents = rounded_quotient(as_column(numerator) * 100, denominator)
    return (cents * F.expr("0.01")).cast("decimal(38,2)")


def rounded_quotient(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """ROUND(numerator / denominator) of two whole numbers, half away from zero."""
    n = as_column(numerator).cast("decimal(38,0)")
    d = as_column(denominator).cast("decimal(19,0)")
    doubled = F.nullif(F.abs(d) * 2, F.lit(0).cast("decimal(20,0)"))
    size = F.call_function("div", F.abs(n) * 2 + F.abs(d), doubled)
    return size * (F.signum(n) * F.signum(d)).cast("int")
