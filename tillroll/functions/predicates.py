"""Business predicates shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SALE, CANCEL, NO_VALUE, DEBT_ADJUST, ANOMALY = (
    "sale",
    "cancel",
    "no_value",
    "debt_adjust",
    "anomaly",
)
KINDS = (SALE, CANCEL, NO_VALUE, DEBT_ADJUST, ANOMALY)
ACTIVE, AT_RISK, INACTIVE = "active", "at_risk", "inactive"


def matches(text: Column, pattern: str) -> Column:
    """Whole-string match. `\\z`, not `$`, which would accept a final newline."""
    return text.rlike(rf"\A(?:{pattern})\z")


def line_kind(invoice: Column, quantity: Column, price: Column) -> Column:
    """The kind of an invoice line; the first rule that holds wins."""
    numbered = invoice.rlike(r"\A[0-9]")
    return (
        F.when(invoice.startswith("A"), F.lit(DEBT_ADJUST))
        .when(invoice.startswith("C") & (quantity < 0) & (price > 0), F.lit(CANCEL))
        .when(numbered & (price == 0), F.lit(NO_VALUE))
        .when(numbered & (quantity > 0) & (price > 0), F.lit(SALE))
        .otherwise(F.lit(ANOMALY))
    )


def is_purchase(kind: Column, product_revenue: Column) -> Column:
    """A sale with product value; an invoice with freight alone is not a purchase."""
    return (kind == SALE) & (product_revenue > 0)


def counts_as_revenue(kind: Column, purchase: Column) -> Column:
    """Orders that make up net revenue: purchases and cancellations."""
    return purchase | (kind == CANCEL)


def churn_status(recency_days: Column, churn_days: int, inactive_days: int) -> Column:
    return (
        F.when(recency_days <= churn_days, F.lit(ACTIVE))
        .when(recency_days <= inactive_days, F.lit(AT_RISK))
        .otherwise(F.lit(INACTIVE))
    )


def banded(value: Column, upper_bounds: list[tuple[int | None, object]]) -> Column:
    """The label of the first band whose upper bound holds the value (None = no bound)."""
    bounded = [(bound, label) for bound, label in upper_bounds if bound is not None]
    rest = [label for bound, label in upper_bounds if bound is None]
    column = None
    for bound, label in bounded:
        test = value <= bound
        column = F.when(test, F.lit(label)) if column is None else column.when(test, F.lit(label))
    return column.otherwise(F.lit(rest[0])) if rest else column
