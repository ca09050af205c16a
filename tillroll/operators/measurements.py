"""Measurements behind the analysis's choices: thresholds, distributions, comparisons."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions import clock, money
from tillroll.functions.predicates import AT_RISK, CANCEL, SALE
from tillroll.operators import rank
from tillroll.operators.churn import interval_counts
from tillroll.operators.cohorts import customer_months
from tillroll.workspace import Workspace, row_parts


def kind_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("kind").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("value").cast(money.MONEY).alias("value")
    )


def interval_percentiles(orders: DataFrame) -> DataFrame:
    """Days between purchases: percentiles, intervals, and how many fall on the same day."""
    counts = interval_counts(orders).filter(F.col("days").isNotNull())
    values = counts.select(
        F.lit(1).alias("key"), F.col("days").cast("bigint").alias("v"), "purchases"
    )
    spread = rank.percentiles(values, "key", (50, 75, 80, 90, 95), F.col("purchases"))
    same_day = counts.filter(F.col("days") == 0).agg(
        F.coalesce(F.sum("purchases"), F.lit(0)).alias("n")
    )
    return spread.withColumnRenamed("rows", "intervals").drop("key").withColumn(
        "same_day", same_day.scalar()
    )


def first_return_months(orders: DataFrame, cutoff: date | datetime) -> DataFrame:
    """Customers known at the cut-off, by the month of their first purchase after it."""
    cut = clock.moment(cutoff)
    bought = orders.filter(F.col("is_purchase") & F.col("customer_id").isNotNull())
    ts = F.col("ts_local")
    people = bought.groupBy("customer_id").agg(
        F.bool_or(ts < cut).alias("known"), F.min(F.when(ts >= cut, ts)).alias("back")
    )
    return (
        people.filter(F.col("known") & F.col("back").isNotNull())
        .groupBy(clock.month_of(F.col("back")).alias("month"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def new_customers_censored(orders: DataFrame, look_back_months: int) -> DataFrame:
    """New customers per month, judged with an equal look-back in every month.

    `first_seen` counts first purchases in the base; `new_in_window` counts buyers without a
    purchase in the months of the look-back. A month nearer to the start of the base than the
    look-back is marked, its window is cut.
    """
    months = customer_months(orders).filter(
        F.col("customer_id").isNotNull() & (F.col("purchases") > 0)
    )
    per_customer = Window.partitionBy("customer_id").orderBy("month")
    gap = clock.months_between_starts(F.col("month"), F.lag("month").over(per_customer))
    judged = months.withColumn("gap", gap)
    totals = judged.groupBy("month").agg(
        F.count_if(F.col("month") == F.col("cohort")).alias("first_seen"),
        F.count_if(F.col("gap").isNull() | (F.col("gap") > look_back_months)).alias(
            "new_in_window"
        ),
    )
    # One row per month: the calendar bounds this window.
    first = F.min("month").over(Window.partitionBy(F.lit(1)))
    since = clock.months_between_starts(F.col("month"), first)
    return totals.withColumn("full_window", since >= look_back_months)


def countries_per_customer(dim: DataFrame) -> DataFrame:
    return dim.groupBy("n_countries").agg(F.count(F.lit(1)).alias("customers"))


def country_share(dim: DataFrame) -> DataFrame:
    """Customers per country. One row per country, so the total is a window over few rows."""
    counts = dim.groupBy("country").agg(F.count(F.lit(1)).alias("customers"))
    total = F.sum("customers").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", money.ratio(F.col("customers"), total, 4, 6))


def units_quantiles(customers: DataFrame) -> DataFrame:
    """Median and 90th percentile of units per purchase, the basis of the wholesale limit."""
    values = customers.select(
        F.lit(1).alias("key"), (F.col("units_per_order") * 10).cast("bigint").alias("v")
    )
    tenths = rank.percentiles(values, "key", (50, 90))
    return tenths.select(
        F.col("rows").alias("customers"),
        *[(F.col(p) / 10).cast("decimal(24,3)").alias(f"units_{p}") for p in ("p50", "p90")],
    )


def sold_products(lines: DataFrame) -> DataFrame:
    """The columns of product sales that `order_medians` reads."""
    sold = lines.filter((F.col("kind") == SALE) & F.col("is_product"))
    return sold.select("invoice", "stock_code", "value", "unit_price")


def order_medians(sold: DataFrame) -> DataFrame:
    """The typical purchase: products and value (medians), and the typical unit price.

    The sold lines are stored, as both halves read them. They are dealt out by invoice and product,
    then their sums by invoice, to as many partitions as there are rows for: no task holds all lines
    of one invoice, and none holds more groups as the table grows.
    """
    spark = sold.sparkSession
    sold = Workspace(spark).store(sold, "sold")
    parts = row_parts(spark, sold.count())
    pairs = sold.repartition(parts, "invoice", "stock_code").groupBy("invoice", "stock_code")
    pairs = pairs.agg(F.sum("value").alias("value"))
    invoices = pairs.repartition(parts, "invoice").groupBy("invoice").agg(
        F.count(F.lit(1)).alias("products"), F.sum("value").cast(money.MONEY).alias("value")
    )
    values = invoices.select(
        F.inline(
            F.array(
                F.struct(F.lit("products").alias("what"), F.col("products").alias("v")),
                F.struct(F.lit("value").alias("what"), money.thousandths(F.col("value")).alias("v")),
            )
        )
    ).withColumn("lines", F.lit(1).cast("bigint"))
    prices = sold.groupBy("unit_price").agg(F.count(F.lit(1)).alias("lines"))
    prices = prices.select(
        F.lit("unit_price").alias("what"), money.thousandths(F.col("unit_price")).alias("v"), "lines"
    )
    spread = rank.percentiles(values.unionByName(prices), "what", (50,), F.col("lines"))
    scaled = F.when(F.col("what") == "products", F.col("p50")).otherwise(F.col("p50") / 1000)
    return spread.select(
        "what", "rows", scaled.cast("decimal(24,5)").alias("median")
    )


def score_distribution(customers: DataFrame) -> DataFrame:
    """Frequency score: range of frequencies and customers."""
    return customers.groupBy("f").agg(
        F.min("frequency").alias("min_frequency"),
        F.max("frequency").alias("max_frequency"),
        F.count(F.lit(1)).alias("customers"),
    )


def non_product_revenue(lines: DataFrame, codes: DataFrame) -> DataFrame:
    """Value of lines with a customer that are not goods, by kind of code and of line."""
    known = F.col("customer_id").isNotNull() & ~F.col("is_product")
    # Merged per code before the join, so one much-used code is a single row there.
    per_code = (
        lines.filter(known & F.col("kind").isin(SALE, CANCEL))
        .groupBy("stock_code", "kind")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("value").alias("value"))
    )
    kinds = codes.select(F.col("code").alias("stock_code"), F.col("kind").alias("code_kind"))
    return (
        per_code.join(kinds, "stock_code")
        .groupBy("code_kind", "kind")
        .agg(F.sum("lines").alias("lines"), F.sum("value").cast(money.MONEY).alias("value"))
    )


def risk_priority(customers: DataFrame) -> DataFrame:
    """Customers at risk by segment, with what they spent in the last twelve months."""
    return (
        customers.filter(F.col("churn_status") == AT_RISK)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("revenue_12m").cast(money.MONEY).alias("revenue_12m"),
        )
    )


def clv_bias(customers: DataFrame) -> DataFrame:
    """Per segment: predicted, naive and actual totals, and the prediction's error in percent."""
    models = ("predicted", "naive", "seasonal_naive", "actual")
    totals = customers.groupBy("segment").agg(
        *[F.sum(name).cast(money.CENTS).alias(name) for name in models]
    )
    error = (F.col("predicted") - F.col("actual")) * 100
    return totals.withColumn("bias_pct", money.ratio(error, F.col("actual"), 2))


def clv_summary(customers: DataFrame) -> DataFrame:
    """Total, mean and median of the expected value, in whole units."""
    values = customers.select(F.lit(1).alias("key"), money.hundredths(F.col("clv_6m")).alias("v"))
    middle = rank.percentiles(values, "key", (50,)).select("p50").scalar()
    totals = customers.agg(F.sum("clv_6m").alias("total"), F.count(F.lit(1)).alias("customers"))
    return totals.select(
        "customers",
        F.round("total", 0).cast("decimal(24,0)").alias("clv_total"),
        money.ratio(F.col("total"), F.col("customers"), 0).alias("clv_mean"),
        F.round(middle / 100, 0).cast("decimal(24,0)").alias("clv_median"),
    )


def clv_top20_share(customers: DataFrame) -> DataFrame:
    """Share of the expected value held by the top fifth of customers."""
    values = customers.select(money.hundredths(F.col("clv_6m")).alias("v"))
    parts = rank.top_share(values, 1, 5)
    return parts.select(
        F.col("top").cast("decimal(27,0)").alias("top_cents"),
        F.col("everything").cast("decimal(27,0)").alias("all_cents"),
        money.ratio(F.col("top"), F.col("everything"), 4, 6).alias("share"),
    )


def top10_share(customers: DataFrame) -> DataFrame:
    """Share of net revenue of the customers within the best tenth (cume_dist <= 0.1)."""
    values = customers.select(money.thousandths(F.col("net_revenue")).alias("v"))
    parts = rank.within_top_tenth(values)
    return parts.select(money.ratio(F.col("top"), F.col("everything"), 4, 8).alias("top10_share"))
