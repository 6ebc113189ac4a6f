"""Named row rules. A rule that comes out null counts as failed."""

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILED_RULE = "failed_rule"

Rules = Mapping[str, Column]


def passing(rules: Rules) -> Column:
    """Filter condition. Kept as plain conjuncts, so Spark can push down those on keys."""
    return reduce(and_, rules.values())


def first_failure(rules: Rules) -> Column:
    """Name of the first rule a row fails, null if it passes all."""
    return F.coalesce(
        *[
            F.when(~F.coalesce(condition, F.lit(False)), F.lit(name))
            for name, condition in rules.items()
        ]
    )


def rejects_by_rule(df: DataFrame, rules: Rules) -> DataFrame:
    return (
        df.select(first_failure(rules).alias(FAILED_RULE))
        .filter(F.col(FAILED_RULE).isNotNull())
        .groupBy(FAILED_RULE)
        .agg(F.count(F.lit(1)).alias("rejected"))
    )
