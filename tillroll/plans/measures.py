"""The report's measures as (measure, value) rows. Values are decimals; shares have 4 places."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money
from tillroll.functions.predicates import AT_RISK, INACTIVE
from tillroll.params import Parameters
from tillroll.operators.cohorts import settled
from tillroll.plans.report import PROFILES, in_profile, segment_summary

_VALUE = "decimal(30,4)"


def _rows(frame: DataFrame, measures: dict[str, Column]) -> DataFrame:
    names = [f"m{i}" for i in range(len(measures))]
    totals = frame.agg(*[c.cast(_VALUE).alias(n) for n, c in zip(names, measures.values())])
    rows = [
        F.struct(F.lit(label).alias("measure"), F.col(n).alias("value"))
        for n, label in zip(names, measures)
    ]
    return totals.select(F.inline(F.array(*rows)))


def _mean(name: str, condition: Column | None = None) -> Column:
    value = F.col(name) if condition is None else F.when(condition, F.col(name))
    # Four-place shares in ten-thousandths keep the quotient exact.
    return money.ratio(F.sum(value) * 10000, F.count(value) * 10000, 4)


def customer_measures(customers: DataFrame) -> DataFrame:
    """The measures over customers, for whichever are given (all, or one profile)."""
    n = F.count(F.lit(1))
    at_risk = F.col("churn_status") == AT_RISK
    return _rows(
        customers,
        {
            "customers": n,
            "net revenue": F.sum("net_revenue"),
            "average ticket": money.ratio(F.sum("net_revenue"), F.sum("frequency"), 2),
            "churned customers": F.count_if("is_churned"),
            "churned share": money.ratio(F.count_if("is_churned"), n, 4),
            "at risk": F.count_if(at_risk),
            "inactive": F.count_if(F.col("churn_status") == INACTIVE),
            "revenue at risk": F.sum(F.when(at_risk, F.col("revenue_12m"))),
            "clv 6 months": F.sum("clv_6m"),
        },
    )


def by_profile(customers: DataFrame, measured: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `measured` makes of each profile's customers, as a report's slicer shows it."""
    parts = [
        measured(in_profile(customers, profile)).select(F.lit(profile).alias("profile"), "*")
        for profile in PROFILES
    ]
    return reduce(DataFrame.unionByName, parts)


def measures(
    *,
    monthly: DataFrame,
    customers: DataFrame,
    churn_validation: DataFrame,
    churn_band: DataFrame,
    cohorts: DataFrame,
    clv_validation_customer: DataFrame,
    quality: DataFrame,
    params: Parameters,
) -> DataFrame:
    sold, unknown = F.sum("sale_with_customer"), F.sum("sale_without_customer")
    both = F.coalesce(sold, F.lit(0)) + F.coalesce(unknown, F.lit(0))
    rule = F.col("chosen") & (F.col("cutoff") == F.lit(params.cutoff))
    parts = [
        _rows(
            monthly,
            {
                "product revenue": F.sum("net_product_revenue"),
                "sale with customer": sold,
                "sale without customer": unknown,
                "share without customer": money.ratio(unknown, both, 4),
            },
        ),
        customer_measures(customers),
        _rows(churn_band, {"not returned": _mean("rate")}),
        _rows(
            churn_validation,
            {
                "precision of the rule": _mean("precision", rule),
                "precision": _mean("precision"),
                "recall": _mean("recall"),
            },
        ),
        _rows(cohorts, {"retention": money.ratio(F.sum("active"), F.sum("size"), 4)}),
        _rows(
            settled(cohorts),
            {"retention, settled months": money.ratio(F.sum("active"), F.sum("size"), 4)},
        ),
        _rows(
            clv_validation_customer,
            {
                "clv predicted (validation)": F.sum("predicted"),
                "clv naive (validation)": F.sum("naive"),
                "clv seasonal naive (validation)": F.sum("seasonal_naive"),
                "actual revenue (validation)": F.sum("actual"),
            },
        ),
        _rows(quality, {"checks ok": F.count_if("ok"), "checks": F.count(F.lit(1))}),
    ]
    return reduce(DataFrame.unionByName, parts)


def segment_shares(customers: DataFrame) -> DataFrame:
    """Share of customers and of revenue per segment, within the customers given."""
    return segment_summary(customers).select("segment", "customer_share", "revenue_share")


def checks_card(quality: DataFrame) -> DataFrame:
    """`18 of 18`"""
    counts = quality.agg(F.count_if("ok").alias("ok"), F.count(F.lit(1)).alias("n"))
    return counts.select(F.concat_ws(" of ", "ok", "n").alias("checks"))
