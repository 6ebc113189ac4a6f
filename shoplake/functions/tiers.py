"""Business classifications."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Highest net stock of each risk level, and units from which a tier starts.
CRITICAL, HIGH, MEDIUM = 0, 5, 20
MEDIUM_UNITS, HIGH_UNITS = 5, 20

RISK_LEVELS = ("critical", "high", "medium", "healthy")
DEMAND_TIERS = ("no_sales", "low", "medium", "high")


def demand_tier(units: Column) -> Column:
    """Tier by units sold. A null count falls through to ``high``; fill it first."""
    return (
        F.when(units == 0, "no_sales")
        .when(units < MEDIUM_UNITS, "low")
        .when(units < HIGH_UNITS, "medium")
        .otherwise("high")
    )


def risk_level(
    net_stock: Column, critical: int = CRITICAL, high: int = HIGH, medium: int = MEDIUM
) -> Column:
    return (
        F.when(net_stock <= critical, "critical")
        .when(net_stock <= high, "high")
        .when(net_stock <= medium, "medium")
        .otherwise("healthy")
    )


def coverage_ratio(stock: Column, demand: Column) -> Column:
    """How many times the stock covers the demand; null without demand."""
    return F.when(demand > 0, stock / demand)


def bucket(value: Column, bounds: Sequence[float]) -> Column:
    """Label of the half-open interval ``[low, high)`` a value falls in. Bounds are written out
    in full, so different intervals have different labels."""
    if not bounds or sorted(set(bounds)) != list(bounds):
        raise ValueError("bounds must be ascending and at least one")
    names = [str(int(b)) if b == int(b) else repr(float(b)) for b in bounds]
    label = F.when(value < bounds[0], f"<{names[0]}")
    for low, name, high in zip(names, names[1:], bounds[1:]):
        label = label.when(value < high, f"{low}-{name}")
    return label.when(value >= bounds[-1], f"{names[-1]}+")
