"""Insurance pricing summaries on PySpark."""

from rateloom.operators.extracts import Factor
from rateloom.params import PricingParams
from rateloom.plans.report import FactorPlan, Sources, pricing_inputs, pricing_report
from rateloom.plans.summary import pricing_summary, stat_table
from rateloom.sources.sinks import read_result
from rateloom.sources.store import Store

__all__ = [
    "Factor", "FactorPlan", "PricingParams", "Sources", "Store", "pricing_inputs", "pricing_report", "pricing_summary", "read_result",
    "stat_table",
]
