"""Churn by days without a purchase: validation back in time, bands, status."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions import money
from tillroll.functions.predicates import banded
from tillroll.operators.metrics import At, FactSpec, customer_facts, returned_column, span
from tillroll.params import Parameters, add_months
from tillroll.reference_data import CHURN_BANDS

_COUNTS = ("customers", "not_returned", "flagged", "tp", "fp", "fn", "tn")


def needs(params: Parameters) -> FactSpec:
    months = params.churn_window_months
    return FactSpec.of(
        refs=params.churn_cutoffs,
        returns=[(cut, add_months(cut, months)) for cut in params.churn_cutoffs],
    )


def _return_window(cutoff: date | datetime, months: int):
    return span(cutoff, add_months(cutoff, months))


def _matrix(facts: DataFrame, cutoffs, months: int, thresholds: Iterable[int]) -> DataFrame:
    """All cut-offs and thresholds in one pass of conditional counts: one row, then unfolded."""
    columns: list[Column] = []
    rows: list[Column] = []
    for i, cutoff in enumerate(cutoffs):
        at = At.of(cutoff)
        known = at.known
        gone = ~F.col(returned_column(_return_window(cutoff, months)))
        columns.append(F.count_if(known).alias(f"n{i}"))
        columns.append(F.count_if(known & gone).alias(f"gone{i}"))
        for days in thresholds:
            marked = known & (at.recency_days > days)
            columns.append(F.count_if(marked).alias(f"marked{i}_{days}"))
            columns.append(F.count_if(marked & gone).alias(f"tp{i}_{days}"))
            n, lost = F.col(f"n{i}"), F.col(f"gone{i}")
            flagged, tp = F.col(f"marked{i}_{days}"), F.col(f"tp{i}_{days}")
            values = (n, lost, flagged, tp, flagged - tp, lost - tp, n - lost - flagged + tp)
            rows.append(
                F.struct(
                    F.lit(at.ref.date()).alias("cutoff"),
                    F.lit(months).alias("window_months"),
                    F.lit(days).alias("days"),
                    *[v.alias(name) for name, v in zip(_COUNTS, values)],
                )
            )
    unfolded = facts.agg(*columns).select(F.inline(F.array(*rows)))
    # A cut-off without customers has no rows.
    return unfolded.filter(F.col("customers") > 0)


def churn_matrix(
    facts: DataFrame, cutoffs: Iterable[date | datetime], months: int, thresholds: Iterable[int]
) -> DataFrame:
    """Confusion matrix of the rule "idle for more than X days" per cut-off and X."""
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    return _matrix(facts, list(cutoffs), months, list(thresholds)).withColumns(
        {
            "precision": money.ratio(tp, tp + fp, 4, 6),
            "recall": money.ratio(tp, tp + fn, 4, 6),
            "f1": money.ratio(tp * 2, tp * 2 + fp + fn, 4, 6),
            "accuracy": money.ratio(tp + tn, F.col("customers"), 4, 6),
        }
    )


def validate_churn(
    orders: DataFrame, cutoff: date | datetime, months: int, thresholds: Iterable[int]
) -> DataFrame:
    """The same, straight from orders, for one cut-off."""
    spec = FactSpec.of(refs=[cutoff], returns=[_return_window(cutoff, months)])
    return churn_matrix(customer_facts(orders, spec), [cutoff], months, thresholds)


def churn_validation(facts: DataFrame, params: Parameters) -> DataFrame:
    matrix = churn_matrix(
        facts, params.churn_cutoffs, params.churn_window_months, params.churn_thresholds
    )
    return matrix.withColumn("chosen", F.col("days") == params.churn_days)


def churn_bands(facts: DataFrame, params: Parameters) -> DataFrame:
    """Per cut-off and recency band: how many did not return. Empty bands have no row."""
    entries = []
    for cutoff in params.churn_cutoffs:
        at = At.of(cutoff)
        back = F.col(returned_column(_return_window(cutoff, params.churn_window_months)))
        entries.append(
            F.struct(
                F.lit(at.ref.date()).alias("cutoff"),
                F.when(at.known, at.recency_days).alias("recency_days"),
                (~back).alias("gone"),
            )
        )
    recency = F.col("recency_days")
    people = facts.select(F.inline(F.array(*entries))).filter(recency.isNotNull())
    order = banded(recency, [(bound, order) for bound, order, _ in CHURN_BANDS])
    label = banded(recency, [(bound, label) for bound, _, label in CHURN_BANDS])
    counted = (
        people.withColumns({"ord": order, "band": label})
        .groupBy("cutoff", "ord", "band")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count_if("gone").alias("not_returned"),
        )
    )
    rate = money.ratio(F.col("not_returned"), F.col("customers"), 4, 6)
    return counted.withColumn("rate", rate)


def purchase_intervals(orders: DataFrame) -> DataFrame:
    """Days since the customer's previous purchase, one row per purchase.

    The window runs over the customer's distinct purchase days, which the calendar bounds, not
    over the orders. A day of n purchases gives one row with the gap and n - 1 rows that are 0
    days apart.
    """
    others = F.array_repeat(F.lit(0), (F.col("n") - 1).cast("int"))
    return _day_gaps(_purchase_days(orders)).select(
        "customer_id",
        "day",
        F.explode(F.concat(F.array("gap"), others)).alias("days_since_previous"),
    )


def _purchase_days(orders: DataFrame) -> DataFrame:
    purchases = orders.filter(F.col("is_purchase") & F.col("customer_id").isNotNull())
    return purchases.groupBy("customer_id", F.to_date("ts_local").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _day_gaps(days: DataFrame) -> DataFrame:
    by_day = Window.partitionBy("customer_id").orderBy("day")
    return days.withColumn("gap", F.datediff(F.col("day"), F.lag("day").over(by_day)))


def interval_counts(orders: DataFrame) -> DataFrame:
    """How many purchases follow the previous one after each number of days.

    Same as counting `purchase_intervals`, but from customer-days alone.
    """
    gaps = _day_gaps(_purchase_days(orders)).select(
        F.inline(
            F.array(
                F.struct(
                    F.col("gap").alias("days"),
                    F.when(F.col("gap").isNotNull(), F.lit(1).cast("bigint")).alias("n"),
                ),
                F.struct(F.lit(0).alias("days"), (F.col("n") - 1).alias("n")),
            )
        )
    )
    return gaps.filter(F.col("n") > 0).groupBy("days").agg(F.sum("n").alias("purchases"))
