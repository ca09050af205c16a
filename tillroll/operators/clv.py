"""Customer value over the next months: estimate, and its validation against naive models."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money
from tillroll.operators import rank
from tillroll.operators.metrics import At, FactSpec, net_column, returned_column, span
from tillroll.operators.rfm import Limits, rfm_at
from tillroll.params import Parameters, add_months
from tillroll.reference_data import MODELS

_SHARE = "decimal(20,16)"
_PER_MONTH = "decimal(22,12)"


def needs(ref: date | datetime, months: int) -> FactSpec:
    """Facts for an estimate at `ref`: its own history, and the same season a year before."""
    year_before = add_months(ref, -12)
    return FactSpec.of(
        refs=[ref, year_before], returns=[(year_before, add_months(year_before, months))]
    )


def validation_windows(params: Parameters) -> dict[str, tuple[datetime, datetime]]:
    cut, months = params.cutoff, params.clv_validation_months
    year_before = add_months(cut, -12)
    return {
        "naive": span(add_months(cut, -months), cut),
        "actual": span(cut, add_months(cut, months)),
        "seasonal_naive": span(year_before, add_months(year_before, months)),
    }


def validation_needs(params: Parameters) -> FactSpec:
    own = needs(params.cutoff, params.clv_validation_months)
    return own | FactSpec.of(nets=validation_windows(params).values())


def segment_retention(
    facts: DataFrame,
    start: date | datetime,
    months: int,
    wholesale_units: int,
    limits: Limits | None = None,
) -> DataFrame:
    """Per segment at `start`: customers, and those who bought in the months after."""
    back = F.col(returned_column(span(start, add_months(start, months))))
    scored = rfm_at(facts, start, wholesale_units, back.alias("back"), limits=limits)
    counted = scored.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if("back").alias("returned")
    )
    return counted.withColumn(
        "p_active", money.ratio(F.col("returned"), F.col("customers"), 4, 6)
    )


def _base_rate(facts: DataFrame, ref: date | datetime) -> Column:
    """Purchases per month of life over all customers, with 16 decimals."""
    at = At.of(ref)
    totals = facts.filter(at.known).agg(
        F.sum(at.frequency).alias("purchases"), F.sum(at.months_of_life).alias("months")
    )
    rate = F.col("purchases").cast("decimal(20,0)") / F.nullif(F.col("months"), F.lit(0))
    return totals.select(rate.cast("decimal(24,16)").alias("rate")).scalar()


def purchases_per_month(frequency: Column, months: Column, rate: Column, prior: int) -> Column:
    """Own rate pulled towards the base rate, as if `prior` months at the base rate were added."""
    weight = F.lit(prior).cast("decimal(4,0)")
    expected = (frequency.cast("decimal(20,0)") + weight * rate).cast("decimal(36,16)")
    return (expected / (months + weight)).cast(_PER_MONTH)


def expected_value(p_active: Column, ticket: Column, per_month: Column, months: int) -> Column:
    """p(active) x ticket x purchases per month x months, never below zero, in cents."""
    amount = (p_active * ticket * F.lit(months)).cast("decimal(22,8)")
    value = F.round(amount * per_month, 2).cast(money.CENTS)
    return F.greatest(F.lit(0).cast(money.CENTS), value)


def estimate_inputs(
    facts: DataFrame,
    ref: date | datetime,
    months: int,
    wholesale_units: int,
    *extra: Column | str,
    limits: Limits | None = None,
) -> DataFrame:
    """Scored customers at `ref` with p(active) of their segment and the base rate.

    p(active) is the segment's return rate in the same season one year before; without one,
    the return rate of everybody then; without anybody, 0.
    """
    calibration = segment_retention(
        facts, add_months(ref, -12), months, wholesale_units, limits
    )
    share = F.sum("returned").cast("decimal(20,0)") / F.nullif(F.sum("customers"), F.lit(0))
    overall = calibration.agg(share.cast(_SHARE).alias("p")).scalar()
    scored = rfm_at(facts, ref, wholesale_units, *extra, limits=limits)
    # At most ten segments.
    known = F.broadcast(calibration.select("segment", F.col("p_active").alias("_p")))
    chance = F.coalesce(F.col("_p").cast(_SHARE), overall, F.lit(0).cast(_SHARE))
    return (
        scored.join(known, "segment", "left")
        .withColumns({"p_active": chance, "base_rate": _base_rate(facts, ref)})
        .drop("_p")
    )


def with_estimate(inputs: DataFrame, prior: int, months: int) -> DataFrame:
    per_month = purchases_per_month(
        F.col("frequency"), F.col("months_of_life"), F.col("base_rate"), prior
    )
    return inputs.withColumn("_per_month", per_month).withColumns(
        {
            "purchases_per_month": F.round("_per_month", 4).cast("decimal(22,4)"),
            "clv": expected_value(
                F.col("p_active"), F.col("avg_ticket"), F.col("_per_month"), months
            ),
        }
    ).drop("_per_month")


def predict_clv(
    facts: DataFrame,
    ref: date | datetime,
    months: int,
    params: Parameters,
    *extra: str,
    limits: Limits | None = None,
) -> DataFrame:
    """One row per customer with a purchase before `ref`; `extra` fact columns are kept."""
    inputs = estimate_inputs(
        facts, ref, months, params.wholesale_units, *extra, limits=limits
    )
    return with_estimate(inputs, params.clv_prior_months, months).select(
        "customer_id",
        "segment",
        "p_active",
        "avg_ticket",
        "purchases_per_month",
        "clv",
        *extra,
    )


def clv_validation_customer(
    facts: DataFrame, params: Parameters, limits: Limits | None = None
) -> DataFrame:
    """Per customer at the cut-off: the estimate, two naive ones, and what was spent."""
    windows = validation_windows(params)
    columns = {name: net_column(window) for name, window in windows.items()}
    predicted = predict_clv(
        facts,
        params.cutoff,
        params.clv_validation_months,
        params,
        *columns.values(),
        limits=limits,
    )
    return predicted.select(
        "customer_id",
        "segment",
        F.col("clv").alias("predicted"),
        *[F.round(c, 2).cast(money.CENTS).alias(name) for name, c in columns.items()],
    )


def compare_models(customers: DataFrame, models: Sequence[str]) -> DataFrame:
    """Per model (a column of estimates beside `actual`): total error, mean absolute error, and
    the share of actual revenue that the best-estimated fifth of customers brings, relative to
    the truly best fifth.

    `customers` is read three times, so pass a stored table.
    """
    by = {**{model: model for model in models}, "truth": "actual"}
    ordered = customers.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("key"),
                        money.hundredths(F.col(column)).alias("v"),
                        F.col("customer_id").alias("id"),
                    )
                    for name, column in by.items()
                ]
            )
        )
    )
    limits = rank.top_fifth_limits(ordered)

    def top(name: str) -> Column:
        value = money.hundredths(F.col(by[name]))
        best = rank.in_top(value, F.col("customer_id"), limits.get(name))
        return F.sum(F.when(best, F.col("actual")))

    columns = [
        F.count(F.lit(1)).alias("customers"),
        F.sum("actual").alias("actual"),
        top("truth").alias("top_truth"),
    ]
    for model in models:
        columns += [
            F.sum(model).alias(f"sum_{model}"),
            F.sum(F.abs(F.col(model) - F.col("actual"))).alias(f"off_{model}"),
            top(model).alias(f"top_{model}"),
        ]
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.col("customers"),
            F.col(f"sum_{model}").alias("total_predicted"),
            F.col("actual").alias("total_actual"),
            F.col(f"off_{model}").alias("off"),
            F.col(f"top_{model}").alias("top"),
            F.col("top_truth"),
        )
        for model in models
    ]
    unfolded = customers.agg(*columns).select(F.inline(F.array(*rows)))
    predicted, actual = (F.col(f"total_{x}").cast(money.CENTS) for x in ("predicted", "actual"))
    return unfolded.filter(F.col("customers") > 0).select(
        "model",
        "customers",
        predicted.alias("total_predicted"),
        actual.alias("total_actual"),
        money.ratio((predicted - actual) * 100, actual, 2).alias("total_error_pct"),
        money.ratio(F.col("off"), F.col("customers"), 2).alias("mean_abs_error"),
        money.ratio(F.col("top"), F.col("top_truth"), 4, 12).alias("capture_top20"),
    )


def clv_validation(customers: DataFrame) -> DataFrame:
    """The estimate against the two naive models, over `clv_validation_customer` (stored)."""
    return compare_models(customers, MODELS)


def _prior_column(prior: int) -> str:
    return f"prior_{prior}"


def estimates_by_prior(
    facts: DataFrame, params: Parameters, priors: Sequence[int], limits: Limits | None = None
) -> DataFrame:
    """The estimate at the cut-off under several prior weights, side by side, and the truth."""
    months = params.clv_validation_months
    actual = net_column(validation_windows(params)["actual"])
    inputs = estimate_inputs(
        facts, params.cutoff, months, params.wholesale_units, actual, limits=limits
    )
    rate, life = F.col("base_rate"), F.col("months_of_life")

    def value(prior: int) -> Column:
        per_month = purchases_per_month(F.col("frequency"), life, rate, prior)
        return expected_value(F.col("p_active"), F.col("avg_ticket"), per_month, months)

    return inputs.select(
        "customer_id",
        F.round(actual, 2).cast(money.CENTS).alias("actual"),
        *[value(prior).alias(_prior_column(prior)) for prior in priors],
    )


def clv_sensitivity(estimates: DataFrame, priors: Sequence[int]) -> DataFrame:
    """Errors and capture per prior weight, over `estimates_by_prior` (stored)."""
    compared = compare_models(estimates, [_prior_column(prior) for prior in priors])
    prior = F.regexp_extract("model", r"_(\d+)$", 1).cast("int")
    return compared.withColumn("prior_months", prior).drop("model", "customers")
