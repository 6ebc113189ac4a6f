"""Lenient casts, and sums that do not depend on the order of the rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Six decimals, and room for amounts below 10^24. Sums of doubles change with the row order,
# and with them rounded averages; decimal sums come out the same however Spark splits, spills
# or retries the work.
EXACT = "decimal(30,6)"

# Amounts have to be below this, or their row fails a rule: sums of a billion of them still fit.
LARGEST = 1e15


def real(name: str) -> Column:
    """As double; null if malformed, NaN or infinite."""
    value = F.col(name).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def in_range(*names: str) -> Column:
    """Whether all amounts are ones that ``exact`` can hold; nulls are."""
    return F.greatest(F.lit(0.0), *[F.abs(F.col(name)) for name in names]) < LARGEST


def whole(name: str, to: str = "int") -> Column:
    """As whole number; a fraction is cut off, anything malformed or out of range is null."""
    value = F.col(name)
    return F.coalesce(value.try_cast(to), value.try_cast("double").try_cast(to))


def exact(value: Column | str) -> Column:
    """As decimal with six places; null if it doesn't fit (see ``in_range``), NaN or infinite."""
    return (F.col(value) if isinstance(value, str) else value).try_cast(EXACT)


def exact_sum(value: Column | str, digits: int) -> Column:
    """Aggregate: rounded sum."""
    return rounded(F.sum(exact(value)), digits)


def exact_mean(value: Column | str, digits: int) -> Column:
    """Aggregate: rounded mean of the values that are summed."""
    return ratio(F.sum(exact(value)), F.count(exact(value)), digits)


def rounded(total: Column, digits: int) -> Column:
    """Half up on the decimal text of the double."""
    return F.round(total.cast("double"), digits)


def ratio(total: Column, count: Column, digits: int) -> Column:
    return F.round(F.try_divide(total.cast("double"), count), digits)
