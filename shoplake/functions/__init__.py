from shoplake.functions.numbers import exact, exact_mean, exact_sum, real, whole
from shoplake.functions.people import age_band, age_on, full_name
from shoplake.functions.text import clean, clean_lower, or_unknown
from shoplake.functions.tiers import bucket, coverage_ratio, demand_tier, risk_level

__all__ = [
    "age_band",
    "age_on",
    "bucket",
    "clean",
    "clean_lower",
    "coverage_ratio",
    "demand_tier",
    "exact",
    "exact_mean",
    "exact_sum",
    "full_name",
    "or_unknown",
    "real",
    "risk_level",
    "whole",
]
