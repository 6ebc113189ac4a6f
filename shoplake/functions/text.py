"""Text normalisation."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(name: str) -> Column:
    return F.trim(F.col(name))


def clean_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def or_unknown(text: Column) -> Column:
    """Null or empty text becomes ``unknown``."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("unknown"))
