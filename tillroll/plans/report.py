"""Reporting relations over the published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions import money
from tillroll.functions.predicates import AT_RISK, INACTIVE, banded
from tillroll.operators.measurements import top10_share
from tillroll.reference_data import RECENCY_BANDS, segments

WHOLESALE, RETAIL = "Wholesale", "Retail"
PROFILES = (RETAIL, WHOLESALE)


def profile() -> Column:
    return F.when(F.col("is_wholesale"), F.lit(WHOLESALE)).otherwise(F.lit(RETAIL))


def in_profile(customers: DataFrame, name: str) -> DataFrame:
    """Customers of one profile: reports over the result keep their shares inside it."""
    return customers.filter(profile() == name)


def customer_view(customers: DataFrame) -> DataFrame:
    """The snapshot with segment order and action, profile and recency band."""
    recency = F.col("recency_days")
    band = banded(recency, [(bound, label) for bound, _, label in RECENCY_BANDS])
    order = banded(recency, [(bound, order) for bound, order, _ in RECENCY_BANDS])
    labelled = customers.withColumns(
        {"profile": profile(), "recency_band": band, "recency_band_order": order}
    )
    return labelled.join(F.broadcast(segments(customers.sparkSession)), "segment").withColumnRenamed(
        "action", "segment_action"
    )


def segment_summary(customers: DataFrame) -> DataFrame:
    """One row per segment, ten always. Customers are merged per segment before the join."""
    churned = F.col("is_churned")
    totals = customers.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("net_revenue").alias("net"),
        F.sum("recency_days").alias("recency"),
        F.sum("frequency").alias("frequency"),
        F.sum("avg_ticket").alias("ticket"),
        F.count_if(churned).alias("churned"),
        F.count_if(F.col("churn_status") == AT_RISK).alias("at_risk"),
        F.count_if(F.col("churn_status") == INACTIVE).alias("inactive"),
        F.sum(F.when(churned, F.col("revenue_12m"))).alias("churned_12m"),
        F.sum("clv_6m").alias("clv"),
        F.count_if("is_wholesale").alias("wholesale"),
    )
    rows = segments(customers.sparkSession).join(totals, "segment", "left")
    # Ten rows from here on.
    everyone = Window.partitionBy(F.lit(1))
    n = F.coalesce("n", F.lit(0))
    net = F.coalesce("net", F.lit(0))

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint").alias(name)

    return rows.select(
        "segment_order",
        "segment",
        "action",
        n.cast("bigint").alias("customers"),
        money.ratio(n, F.sum("n").over(everyone), 4, 6).alias("customer_share"),
        net.cast(money.MONEY).alias("net_revenue"),
        money.ratio(net, F.sum("net").over(everyone), 4, 8).alias("revenue_share"),
        money.ratio(F.col("recency"), F.col("n"), 0, 10).alias("mean_recency_days"),
        money.ratio(F.col("frequency"), F.col("n"), 1, 12).alias("mean_frequency"),
        money.ratio(F.col("ticket"), F.col("n"), 2, 24).alias("mean_ticket"),
        count("churned"),
        count("at_risk"),
        count("inactive"),
        money.total_or_zero(F.col("churned_12m")).alias("churned_revenue_12m"),
        money.total_or_zero(F.col("clv"), money.CENTS).alias("clv_6m"),
        count("wholesale"),
    )


def profile_split(customers: DataFrame) -> DataFrame:
    """Wholesale and retail: customers, net revenue and share of it."""
    totals = customers.groupBy(profile().alias("profile")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("net_revenue").cast(money.MONEY).alias("net_revenue"),
    )
    total = F.sum("net_revenue").over(Window.partitionBy(F.lit(1)))
    return totals.withColumn("revenue_share", money.ratio(F.col("net_revenue"), total, 4, 8))


def status_summary(customers: DataFrame) -> DataFrame:
    return customers.groupBy("churn_status").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("revenue_12m").cast(money.MONEY).alias("revenue_12m"),
    )


def clv_by_segment(validation: DataFrame) -> DataFrame:
    """Predicted, naive and actual totals per segment, in display order."""
    totals = validation.groupBy("segment").agg(
        *[
            F.sum(name).cast(money.CENTS).alias(name)
            for name in ("predicted", "naive", "seasonal_naive", "actual")
        ]
    )
    known = segments(validation.sparkSession).drop("action")
    return totals.join(F.broadcast(known), "segment")


def headline(monthly: DataFrame, customers: DataFrame, quality: DataFrame) -> DataFrame:
    """One row: the figures at the top of the report.

    `monthly` has a row per month and `quality` one per check; the single figures taken from
    them, and the top-tenth share, are scalar subqueries.
    """
    with_customer = F.coalesce(F.sum("sale_with_customer"), F.lit(0))
    without = F.coalesce(F.sum("sale_without_customer"), F.lit(0))
    revenue = monthly.agg(F.sum("net_product_revenue").cast(money.MONEY)).scalar()
    unattributed = monthly.agg(money.ratio(without, with_customer + without, 4, 6)).scalar()
    at_risk = F.col("churn_status") == AT_RISK
    base = customers.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("net_revenue").cast(money.MONEY).alias("net_revenue"),
        F.count_if(F.col("frequency") >= 2).alias("repeat_customers"),
        F.count_if("is_churned").alias("churned"),
        F.count_if(at_risk).alias("at_risk"),
        F.count_if(F.col("churn_status") == INACTIVE).alias("inactive"),
        money.total_or_zero(F.sum(F.when(at_risk, F.col("revenue_12m")))).alias("revenue_at_risk"),
        F.sum("clv_6m").cast(money.CENTS).alias("clv_6m"),
    )
    return base.select(
        revenue.alias("product_revenue"),
        unattributed.alias("without_customer_share"),
        "customers",
        "net_revenue",
        money.ratio(F.col("repeat_customers"), F.col("customers"), 4, 6).alias("repurchase_rate"),
        "churned",
        "at_risk",
        "inactive",
        "revenue_at_risk",
        "clv_6m",
        quality.agg(F.count_if("ok")).scalar().alias("checks_ok"),
        quality.agg(F.count(F.lit(1))).scalar().alias("checks"),
        top10_share(customers).scalar().alias("top10_share"),
    )
