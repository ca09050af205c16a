"""Bands and time windows that are held in a table, however many.

Points meet ranges by bins: a range is listed once for each bin that it touches, a point is in one
bin, and rows of a bin are compared. So a plan does not grow with the number of ranges, and no row
is compared with all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions import clock

#: Bins of the longest range at most, about.
BINS = 64
_DAY = 86_400


def range_join(points: DataFrame, point: Column, ranges: DataFrame, start: str, end: str) -> DataFrame:
    """All columns of both for every point (bigint) with start <= point < end.

    The bin is as wide as the longest range's BINS-th part, so a range is listed BINS + 1 times at
    most; null bounds and points match nothing. Ranges may overlap; a point in several has a row for
    each. Neither side carries a hint: a table of few ranges is broadcast by its size, a large one
    is shuffled by bin, where Spark splits hot bins. Reads the ranges' lengths when called.
    """
    longest = ranges.agg(F.max(F.col(end) - F.col(start))).first()[0] or 1
    width = F.lit(max(1, -(-longest // BINS)))

    def bin_of(value: Column) -> Column:
        return F.floor(value / width).cast("bigint")

    kept = ranges.filter(F.col(start) < F.col(end))
    listed = kept.withColumn("_bin", F.explode(F.sequence(bin_of(F.col(start)), bin_of(F.col(end) - 1))))
    own = points.withColumn("_point", point).withColumn("_bin", bin_of(F.col("_point")))
    inside = (F.col("_point") >= F.col(start)) & (F.col("_point") < F.col(end))
    return own.join(listed, "_bin").filter(inside).drop("_bin", "_point")


def seconds(wall_clock: Column) -> Column:
    """A wall-clock moment as whole seconds, for ranges of moments."""
    return clock.seconds_between(wall_clock, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def in_bands(values: DataFrame, value: str, bands: DataFrame) -> DataFrame:
    """values with the columns of the band that holds an integer column: bands have from_ and upto
    (both inclusive; null: no limit) and do not overlap. Values in no band are left out, as NULLs
    are."""
    least, most = F.min(value), F.max(value)
    ends = values.agg(least.alias("least"), most.alias("most")).first()
    low = F.coalesce(F.col("from_").cast("bigint"), F.lit(ends.least))
    high = F.coalesce(F.col("upto").cast("bigint"), F.lit(ends.most))
    # Bands are cut to the values there are, so one without a limit is no longer than those.
    cut = bands.withColumns(
        {"_low": F.greatest(low, F.lit(ends.least)), "_high": F.least(high, F.lit(ends.most)) + 1}
    )
    joined = range_join(values, F.col(value).cast("bigint"), cut, "_low", "_high")
    return joined.drop("_low", "_high", "from_", "upto")


def returns_in_windows(orders: DataFrame, windows: DataFrame) -> DataFrame:
    """For each window (id, start, end: wall-clock, half-open): customers with a purchase before its
    start, those of them with one inside, and their net of purchases inside.

    Purchases are reduced to customer and moment of the day first; customers before a start are a
    running count by moment, which is looked up. Windows without such customers have noughts.
    """
    bought = orders.filter(F.col("is_purchase") & F.col("customer_id").isNotNull())
    moments = bought.groupBy("customer_id", seconds(F.col("ts_local")).alias("at")).agg(
        F.sum("product_revenue").alias("spent")
    )
    moments = moments.filter(F.col("at").isNotNull())
    own = Window.partitionBy("customer_id").orderBy("at")
    moments = moments.withColumns(
        {
            "first": F.first("at").over(own.rowsBetween(Window.unboundedPreceding, 0)),
            "before": F.lag("at").over(own),
        }
    )
    spans = windows.select("id", seconds(F.col("start")).alias("from_"), seconds(F.col("end")).alias("until"))
    inside = range_join(moments, F.col("at"), spans, "from_", "until").filter(F.col("first") < F.col("from_"))
    # A customer is counted at the first moment inside, the one whose predecessor is before the
    # start: so a task holds a row per window, not one per window and customer.
    returned = inside.groupBy("id").agg(
        F.count_if(F.col("before") < F.col("from_")).alias("returned"), F.sum("spent").alias("spent")
    )
    # A first purchase on an earlier day than the start is counted by day, which the calendar
    # bounds; one on the same day by its second.
    firsts = bought.groupBy("customer_id").agg(F.min(seconds(F.col("ts_local"))).alias("first"))
    day = F.floor(F.col("first") / _DAY).cast("bigint")
    days = firsts.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    calendar = Window.partitionBy(F.lit(1)).orderBy("day")
    up_to = F.sum("n").over(calendar.rowsBetween(Window.unboundedPreceding, 0))
    days = days.select("day", up_to.alias("known"), F.lead("day").over(calendar).alias("next"))
    own = spans.select("id", "from_", F.floor(F.col("from_") / _DAY).cast("bigint").alias("own_day"))
    # The last day before each start that has a first purchase.
    last = own.agg(F.max("own_day")).first()[0] or 0
    days = days.withColumn("next", F.coalesce("next", F.lit(last)))
    earlier = range_join(own, F.col("own_day") - 1, days, "day", "next").select("id", "known")
    same_day = own.join(firsts.withColumn("own_day", day), "own_day").filter("first < from_")
    same_day = same_day.groupBy("id").agg(F.count(F.lit(1)).alias("today"))
    return (
        windows.select("id")
        .join(earlier, "id", "left")
        .join(same_day, "id", "left")
        .join(returned, "id", "left")
        .select(
            "id",
            (F.coalesce("known", F.lit(0)) + F.coalesce("today", F.lit(0))).cast("bigint").alias("customers"),
            F.coalesce("returned", F.lit(0)).cast("bigint").alias("returned"),
            F.coalesce("spent", F.lit(0)).cast("decimal(24,3)").alias("spent"),
        )
    )
