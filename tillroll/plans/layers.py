"""The layers of one run, each built once from the layer below."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money
from tillroll.functions.predicates import churn_status
from tillroll.operators import churn, clv, cohorts
from tillroll.operators.clean import clean, customer_dim, overlap_start_value
from tillroll.operators.metrics import FactSpec, customer_facts, net_column, span
from tillroll.operators.orders import build_invoices, orders_of
from tillroll.operators.rfm import Limits, score_limits
from tillroll.params import Parameters, add_months
from tillroll.workspace import Workspace


def year_before_end(params: Parameters):
    return span(add_months(params.end, -12), params.end)


def snapshot_needs(params: Parameters) -> FactSpec:
    return clv.needs(params.end, params.clv_horizon_months) | FactSpec.of(
        nets=[year_before_end(params)]
    )


def all_needs(params: Parameters) -> FactSpec:
    """Everything the published tables need, for one pass over the orders."""
    return snapshot_needs(params) | churn.needs(params) | clv.validation_needs(params)


class Layers:
    """Lazy layers over raw lines.

    `keep` names the layers to store when first used, for plans that read them more than once;
    others stay part of the plan that uses them. `unread` names columns that no reader of the
    stored layers wants: they are not worked out. The facts are always stored: every ranking
    reads them twice, and they are one row per customer.
    """

    def __init__(
        self,
        raw: DataFrame,
        codes: DataFrame,
        params: Parameters,
        spec: FactSpec | None = None,
        keep: tuple[str, ...] = (),
        workspace: Workspace | None = None,
        overlap_from: Column | None = None,
        unread: tuple[str, ...] = (),
    ):
        self.spark = raw.sparkSession
        self.raw, self.codes, self.params = raw, codes, params
        self.spec = spec or all_needs(params)
        self.keep = keep
        self.workspace = workspace or Workspace(self.spark)
        self.unread = unread
        self._overlap_from = overlap_from

    def _layer(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        frame = build()
        return self.workspace.store(frame.drop(*self.unread), name) if name in self.keep else frame

    @cached_property
    def overlap_from(self) -> Column | None:
        """First day of the overlap: as the source gives it; else found once when the lines are
        read for several layers, or left to a subquery of the one plan that needs it."""
        if self._overlap_from is not None:
            return self._overlap_from
        if "clean_line" in self.keep:
            return overlap_start_value(self.raw, self.params.batches)
        return None

    @cached_property
    def clean_line(self) -> DataFrame:
        return self._layer(
            "clean_line",
            lambda: clean(self.raw, self.codes, self.params.batches, self.overlap_from),
        )

    @cached_property
    def customer_dim(self) -> DataFrame:
        return self._layer("customer_dim", lambda: customer_dim(self.clean_line))

    @cached_property
    def invoices(self) -> DataFrame:
        """Lines grouped by invoice, once for the orders and for the checks."""
        return self._layer("invoices", lambda: build_invoices(self.clean_line))

    @cached_property
    def orders(self) -> DataFrame:
        return self._layer("orders", lambda: orders_of(self.invoices))

    @cached_property
    def facts(self) -> DataFrame:
        return self.workspace.store(customer_facts(self.orders, self.spec), "facts")

    @cached_property
    def limits(self) -> Limits:
        """Score limits at every reference date, ranked in one pass."""
        return score_limits(self.facts, self.spec.refs)

    @cached_property
    def snapshot(self) -> DataFrame:
        """Customers at the end: metrics, scores, churn, last twelve months, expected value."""
        return self._layer("snapshot", self._snapshot)

    def _snapshot(self) -> DataFrame:
        params = self.params
        recent = net_column(year_before_end(params))
        inputs = clv.estimate_inputs(
            self.facts,
            params.end,
            params.clv_horizon_months,
            params.wholesale_units,
            recent,
            limits=self.limits,
        )
        valued = clv.with_estimate(inputs, params.clv_prior_months, params.clv_horizon_months)
        recency = F.col("recency_days")
        return valued.select(
            "customer_id",
            "first_purchase",
            "last_purchase",
            "recency_days",
            "frequency",
            "gross_revenue",
            "cancelled_value",
            "net_revenue",
            "avg_ticket",
            "cancel_rate",
            "units_per_order",
            "r",
            "f",
            "m",
            "segment",
            "is_wholesale",
            "net_not_positive",
            (recency > params.churn_days).alias("is_churned"),
            F.col(recent).cast(money.MONEY).alias("revenue_12m"),
            F.coalesce("clv", F.lit(0).cast(money.CENTS)).alias("clv_6m"),
            F.round("p_active", 4).cast("decimal(6,4)").alias("p_active_6m"),
            churn_status(recency, params.churn_days, params.inactive_days).alias("churn_status"),
        )

    @cached_property
    def customer(self) -> DataFrame:
        """The snapshot with the customer's country, under one stored table in a full run."""
        return self._layer(
            "customer", lambda: self.snapshot.join(self.customer_dim, "customer_id")
        )

    @cached_property
    def churn_validation(self) -> DataFrame:
        return self._layer(
            "churn_validation", lambda: churn.churn_validation(self.facts, self.params)
        )

    @cached_property
    def churn_band(self) -> DataFrame:
        return self._layer("churn_band", lambda: churn.churn_bands(self.facts, self.params))

    @cached_property
    def cohort_retention(self) -> DataFrame:
        return self._layer("cohort_retention", lambda: cohorts.cohort_retention(self.orders))

    @cached_property
    def clv_validation_customer(self) -> DataFrame:
        frame = clv.clv_validation_customer(self.facts, self.params, self.limits)
        return self.workspace.store(frame, "clv_validation_customer")

    @cached_property
    def clv_validation(self) -> DataFrame:
        return self._layer(
            "clv_validation", lambda: clv.clv_validation(self.clv_validation_customer)
        )

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
