"""Monthly cohorts: who bought again, and net revenue, by months since the first purchase."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions import clock, money
from tillroll.functions.predicates import CANCEL, SALE, counts_as_revenue


def customer_months(orders: DataFrame) -> DataFrame:
    """Orders reduced to one row per customer and month, with the customer's first month.

    Orders without a customer stay, under a NULL customer without a cohort, as the month totals
    need them; they are summed by month alone. After this step no customer has more rows than
    there are months, so the window below is bounded by the calendar. Both groupings need the
    orders by customer only, so orders that are stored so are not shuffled.
    """
    purchase = F.col("is_purchase")
    revenue = F.col("_revenue")
    counted = counts_as_revenue(F.col("kind"), purchase)
    whole = {
        "_revenue": money.thousandths(F.col("product_revenue")),
        "_other": money.thousandths(F.col("other_revenue")),
    }
    totals = [
        F.count_if(purchase).alias("purchases"),
        F.min(F.when(purchase, F.col("ts_local"))).alias("first_ts"),
        money.from_thousandths(F.sum(F.when(counted, revenue))).alias("net"),
        money.from_thousandths(F.sum(F.when(F.col("kind") == SALE, revenue))).alias("sold"),
        money.from_thousandths(F.sum(F.when(F.col("kind") == CANCEL, revenue))).alias("cancelled"),
        money.from_thousandths(F.sum(revenue)).alias("product"),
        money.from_thousandths(F.sum("_other")).alias("other"),
    ]
    orders, known = orders.withColumns(whole), F.col("customer_id").isNotNull()
    months = orders.filter(known).groupBy("customer_id", "month").agg(*totals)
    bought = F.when(F.col("purchases") > 0, F.col("month"))
    per_customer = Window.partitionBy("customer_id")
    months = months.withColumns(
        {"cohort": F.min(bought).over(per_customer), "first_purchase": F.min("first_ts").over(per_customer)}
    )
    unknown = orders.filter(~known).groupBy("month").agg(*totals)
    return months.unionByName(unknown, allowMissingColumns=True)


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Full grid: each cohort by each month from it to the last month of the base.

    Net revenue before the first purchase (a cancellation of an older sale) counts in month 0.
    From the second aggregate on, the table holds at most one row per pair of months.
    """
    months = customer_months(orders)
    cells = months.groupBy("cohort", F.greatest("month", "cohort").alias("month")).agg(
        F.count_if(F.col("purchases") > 0).alias("active"),
        money.total_or_zero(F.sum("net")).alias("net_revenue"),
        F.min("month").alias("_first"),
        F.max("month").alias("_last"),
    )
    # Limits over all orders, those without a customer included.
    everything = Window.partitionBy(F.lit(1))
    per_cohort = Window.partitionBy("cohort")
    cells = cells.withColumns(
        {
            "_base_first": F.min("_first").over(everything),
            "_base_last": F.max("_last").over(everything),
        }
    ).filter(F.col("cohort").isNotNull())
    following = F.lead("month").over(per_cohort.orderBy("month"))
    # Each cell stands for itself and for the empty months up to the next cell.
    until = F.coalesce(F.add_months(following, -1), F.col("_base_last"))
    start_size = F.max(F.when(F.col("month") == F.col("cohort"), F.col("active")))
    cells = cells.withColumns({"_until": until, "size": start_size.over(per_cohort)})
    one_month = F.make_ym_interval(F.lit(0), F.lit(1))
    grid = cells.withColumn(
        "_month", F.explode(F.sequence(F.col("month"), F.col("_until"), one_month))
    )
    own = F.col("_month") == F.col("month")
    active = F.when(own, F.col("active")).otherwise(F.lit(0))
    net = F.when(own, F.col("net_revenue")).otherwise(F.lit(0).cast(money.MONEY))
    return grid.select(
        "cohort",
        (F.col("cohort") == F.col("_base_first")).alias("pre_existing"),
        "size",
        clock.months_between_starts(F.col("_month"), F.col("cohort")).alias("months_since"),
        F.col("_month").alias("month"),
        (F.col("_month") == F.col("_base_last")).alias("partial_month"),
        active.alias("active"),
        money.ratio(active, F.col("size"), 4, 6).alias("retention"),
        net.alias("net_revenue"),
    )


def settled(cohorts: DataFrame, last_month: int = 12) -> DataFrame:
    """Months 1 to 12 of the cohorts that can be compared: not the pre-existing one, and not
    the month the base ends in."""
    return cohorts.filter(
        ~F.col("pre_existing")
        & ~F.col("partial_month")
        & F.col("months_since").between(1, last_month)
    )


def cohort_matrix(cohorts: DataFrame, last_month: int = 12) -> DataFrame:
    """Cohorts in rows, months since the first purchase in columns m1..m12."""
    months = [f"m{i}" for i in range(1, last_month + 1)]
    return (
        settled(cohorts, last_month)
        .withColumn("column", F.concat(F.lit("m"), F.col("months_since")))
        .groupBy("cohort")
        .pivot("column", months)
        .agg(F.max("retention"))
    )


def cohort_flags(cohorts: DataFrame) -> DataFrame:
    """Per cohort: whether it was there from the start, and its partial months, in order."""
    partial = F.array_sort(F.collect_list(F.when(F.col("partial_month"), F.col("month"))))
    return cohorts.groupBy("cohort").agg(
        F.bool_or("pre_existing").alias("pre_existing"),
        F.array_join(F.transform(partial, lambda day: day.cast("string")), ",").alias("partial_months"),
    )


def cohort_arrays(orders: DataFrame) -> DataFrame:
    """Per customer with a purchase: the months bought in, in order, their net revenue in the same
    order, whether any month gave back more than it bought, and whether every month had a purchase.

    Arrays hold at most a month each, which the calendar bounds, and are ordered by month whatever
    the order of the rows; months without a purchase are left out of them.
    """
    months = customer_months(orders).filter(F.col("cohort").isNotNull())
    bought = F.when(F.col("purchases") > 0, F.struct("month", "net"))
    own = F.array_sort(F.collect_list(bought))  # collect_list leaves out nulls
    return (
        months.groupBy("customer_id", "cohort")
        .agg(
            own.alias("_own"),
            F.bool_or(F.coalesce(F.col("net") < 0, F.lit(False))).alias("ever_negative"),
            F.bool_and(F.col("purchases") > 0).alias("always_bought"),
        )
        .select(
            "customer_id",
            "cohort",
            F.array_join(F.transform("_own", lambda x: x["month"].cast("string")), ",").alias("months"),
            F.array_join(F.transform("_own", lambda x: x["net"].cast("string")), ",").alias("net"),
            F.size("_own").cast("bigint").alias("n_months"),
            "ever_negative",
            "always_bought",
        )
    )


def retention_curve(cohorts: DataFrame) -> DataFrame:
    """Retention by months since the first purchase, weighted by cohort size."""
    usable = cohorts.filter(~F.col("pre_existing") & ~F.col("partial_month"))
    sums = usable.groupBy("months_since").agg(
        F.sum("active").alias("active"), F.sum("size").alias("size")
    )
    return sums.withColumn("retention", money.ratio(F.col("active"), F.col("size"), 4, 6))


def monthly_revenue(orders: DataFrame, end) -> DataFrame:
    """Per month: revenue by origin, purchases, active and new customers.

    Sums stay NULL where a month has no such order.
    """
    months = customer_months(orders)
    known = F.col("customer_id").isNotNull()
    bought = F.col("purchases") > 0
    is_new = known & bought & (F.col("month") == F.col("cohort"))
    is_new = is_new & (F.col("first_purchase") < clock.moment(end))
    totals = months.groupBy("month").agg(
        F.sum(F.when(known, F.col("sold"))).cast(money.MONEY).alias("sale_with_customer"),
        F.sum(F.when(~known, F.col("sold"))).cast(money.MONEY).alias("sale_without_customer"),
        F.sum("cancelled").cast(money.MONEY).alias("cancelled_product"),
        F.sum("product").cast(money.MONEY).alias("net_product_revenue"),
        F.sum("other").cast(money.MONEY).alias("other_revenue"),
        F.sum("purchases").alias("purchases"),
        F.sum(F.when(known, F.col("purchases")).otherwise(F.lit(0))).alias(
            "purchases_with_customer"
        ),
        F.count_if(known & bought).alias("active_customers"),
        F.count_if(is_new).alias("new_customers"),
    )
    # One row per month here, so the unpartitioned window is bounded by the calendar.
    last = F.max("month").over(Window.partitionBy(F.lit(1)))
    return totals.withColumn("partial_month", F.col("month") == last)
