"""Dashboard panels over the gold tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions import bucket, exact_sum
from shoplake.operators.ranking import top


def revenue_panel(product_performance: DataFrame) -> DataFrame:
    return (
        product_performance.groupBy("category")
        .agg(exact_sum("total_revenue", 2).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def spend_tier_panel(customer_360: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """Users per bucket of total spend."""
    tier = bucket(F.col("total_spend"), bounds)
    return customer_360.groupBy(tier.alias("spend_tier")).agg(F.count(F.lit(1)).alias("users"))


def stock_alert_panel(stock_risk: DataFrame) -> DataFrame:
    """Products at critical or high risk; reads those two partitions of a stored table only."""
    return stock_risk.filter(F.col("risk_level").isin("critical", "high"))


def top_customers_panel(customer_360: DataFrame, n: int = 10) -> DataFrame:
    columns = customer_360.select("user_id", "first_name", "last_name", "email", "total_spend")
    return top(columns, n, F.desc("total_spend"), F.asc("user_id"))
