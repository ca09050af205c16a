"""One grouping of lines by invoice: orders, and what the checks ask of invoices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import clock, money
from tillroll.functions.predicates import ANOMALY, CANCEL, SALE, is_purchase


def build_invoices(lines: DataFrame) -> DataFrame:
    """Roll all lines up to invoices. Every aggregate merges on the map side, so an invoice with
    very many lines costs one row per task in the shuffle.

    The first columns are over sale and cancellation lines, the last five over all lines.
    """
    product = F.col("is_product")
    traded = F.col("kind").isin(SALE, CANCEL)
    # quantity x price in whole thousandths, equal to the line's value.
    price = (F.col("unit_price") * F.lit(1000)).cast("bigint")
    worth = F.col("quantity").cast("bigint") * price
    customer = F.col("customer_id")
    return lines.groupBy("invoice").agg(
        F.min(F.when(traded, customer)).alias("customer_id"),
        # Not min(kind): a string minimum would turn hash aggregation into sorting.
        F.bool_or(F.col("kind") == CANCEL).alias("cancels"),
        F.min(F.when(traded, F.col("ts_local"))).alias("ts_local"),
        F.sum(F.when(traded, F.when(product, worth).otherwise(F.lit(0)))).alias("product_revenue"),
        F.sum(F.when(traded, F.when(product, F.lit(0)).otherwise(worth))).alias("other_revenue"),
        F.sum(F.when(traded & product, F.col("quantity"))).alias("units"),
        F.count_if(traded).alias("lines"),
        F.min(customer).alias("least_customer"),
        F.max(customer).alias("most_customer"),
        F.count(customer).alias("lines_with_customer"),
        F.count(F.lit(1)).alias("all_lines"),
        F.count_if(F.col("kind") == ANOMALY).alias("anomalies"),
    )


def build_orders(lines: DataFrame) -> DataFrame:
    """One order per invoice with sale or cancellation lines."""
    return orders_of(build_invoices(lines))


def orders_of(invoices: DataFrame) -> DataFrame:
    orders = invoices.filter(F.col("lines") > 0).select(
        "invoice",
        "customer_id",
        F.when(F.col("cancels"), F.lit(CANCEL)).otherwise(F.lit(SALE)).alias("kind"),
        "ts_local",
        clock.to_utc(F.col("ts_local")).alias("ts_utc"),
        clock.month_of(F.col("ts_local")).alias("month"),
        money.from_thousandths(F.col("product_revenue")).alias("product_revenue"),
        money.from_thousandths(F.col("other_revenue")).alias("other_revenue"),
        F.coalesce("units", F.lit(0)).cast("bigint").alias("units"),
        "lines",
    )
    return orders.withColumn("is_purchase", is_purchase(F.col("kind"), F.col("product_revenue")))
