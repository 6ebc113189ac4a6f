"""Age and names."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_on(as_of: dt.date | None, birth_date: Column) -> Column:
    """Full years between birth and ``as_of`` (today if none)."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return F.floor(F.months_between(day, birth_date) / 12).cast("int")


def age_band(age: Column) -> Column:
    """Closed bands; everything else, null included, counts as ``51+``."""
    return (
        F.when(age.between(16, 25), "16-25")
        .when(age.between(26, 35), "26-35")
        .when(age.between(36, 50), "36-50")
        .otherwise("51+")
    )


def full_name(first: str, last: str) -> Column:
    """Null if either part is."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))
