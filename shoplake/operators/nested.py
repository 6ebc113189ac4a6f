"""Arrays of structs to rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_documents(documents: DataFrame, entity: str) -> DataFrame:
    """One row per record of a document; a null or empty array gives none."""
    return documents.select(F.inline(F.col(entity)))


def explode_keeping(df: DataFrame, parents: list[Column], array: str, alias: str) -> DataFrame:
    """One row per array element, next to columns of its parent."""
    return df.select(*parents, F.explode(array).alias(alias))
