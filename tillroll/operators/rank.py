"""Exact ranks over a whole table without putting it into one partition.

`Window.orderBy(x)` alone sorts every row in a single task. Here the rows are first reduced
to one row per distinct value, and the running count is then built level by level: 64-bit
values are cut into blocks by their high bits, so a window partition never holds more than
2**21 rows (2**22 at the top level), whatever the data. A value shared by many rows is one
row after the first step. Blocks depend on the values only, not on sampling, so a task that
is run again gives the same blocks.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.workspace import Workspace

_BITS = 21


def _running(weight: str, keys: list[str], order: str) -> Column:
    """Sum of the weights strictly before this row."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(weight).over(frame), F.lit(0))


def value_positions(
    values: DataFrame, keys: list[str], value: str = "v", weight: Column | None = None
) -> DataFrame:
    """Per key and distinct value (bigint, not null): `n` rows hold it, `before` rows hold a
    smaller one, `total` rows in the key. A row may stand for `weight` rows.

    rank = before + 1; percent_rank = before / (total - 1); cume_dist = (before + n) / total.

    The counts per value are stored, as three steps read them: what `values` is made of runs
    once.
    """
    mid, top = F.shiftright(value, _BITS), F.shiftright(value, 2 * _BITS)
    counts = values.groupBy(*keys, value).agg(
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n")
    )
    distinct = (
        Workspace(values.sparkSession)
        .store(counts, "counts")
        .withColumns({"_mid": mid, "_top": top})
    )
    mids = distinct.groupBy(*keys, "_top", "_mid").agg(F.sum("n").alias("_n"))
    tops = mids.groupBy(*keys, "_top").agg(F.sum("_n").alias("_n"))

    whole_key = Window.partitionBy(*keys)
    tops = tops.select(
        *keys,
        "_top",
        _running("_n", keys, "_top").alias("_before_top"),
        F.sum("_n").over(whole_key).alias("total"),
    )
    mids = mids.select(
        *keys, "_top", "_mid", _running("_n", [*keys, "_top"], "_mid").alias("_before_mid")
    ).join(tops, [*keys, "_top"])
    mids = mids.select(
        *keys, "_mid", (F.col("_before_top") + F.col("_before_mid")).alias("_offset"), "total"
    )
    inside = distinct.select(
        *keys, "_mid", value, "n", _running("n", [*keys, "_mid"], value).alias("_inside")
    )
    return inside.join(mids, [*keys, "_mid"]).select(
        *keys, value, "n", (F.col("_offset") + F.col("_inside")).alias("before"), "total"
    )


def score_limits(values: DataFrame, key: str = "key") -> dict[str, tuple[int | None, ...]]:
    """Per key, the four values at which the scores 2, 3, 4 and 5 begin.

    score = least(5, 1 + floor(5 * percent_rank)), in whole numbers. It never falls as the
    value grows, so four limits say it all: nothing is joined back to the rows, and the
    limits enter later plans as literals. The result has one row per key, whatever the data.
    """
    positions = value_positions(values, [key])
    span = F.greatest(F.col("total") - 1, F.lit(1))
    score = F.least(F.lit(5), 1 + F.call_function("div", F.col("before") * 5, span))
    limits = (
        positions.withColumn("_score", score)
        .groupBy(key)
        .agg(*[F.min(F.when(F.col("_score") >= s, F.col("v"))).alias(f"s{s}") for s in (2, 3, 4, 5)])
    )
    return {row[key]: (row.s2, row.s3, row.s4, row.s5) for row in limits.collect()}


def score_of(value: Column, limits: tuple[int | None, ...]) -> Column:
    """The score 1..5 of a value under the four limits."""
    score = F.lit(1)
    for limit in limits:
        if limit is not None:
            score = score + (value >= F.lit(limit)).cast("int")
    return score.cast("int")


def top_fifth_limits(values: DataFrame, key: str = "key") -> dict[str, tuple[int, int]]:
    """Per key, where the first ceil(20%) rows end when ordered by (v descending, id).

    Returns (v_limit, id_limit): a row is in when v > v_limit, or v = v_limit and
    id <= id_limit. Rows that tie on the limit are ranked by id the same distributed way, as
    they may be a large part of the table. One row per key, whatever the data.
    """
    positions = value_positions(
        values.select(key, (-F.col("v")).alias("v")), [key]
    ).withColumn("_k", F.call_function("div", F.col("total") + 4, F.lit(5)))
    block = positions.filter(
        (F.col("before") < F.col("_k")) & (F.col("_k") <= F.col("before") + F.col("n"))
    ).select(key, (-F.col("v")).alias("v_limit"), (F.col("_k") - F.col("before")).alias("needed"))
    blocks = {row[key]: (row.v_limit, row.needed) for row in block.collect()}
    if not blocks:
        return {}
    on_limit = [(F.col(key) == k) & (F.col("v") == v) for k, (v, _) in blocks.items()]
    ids = value_positions(values.filter(reduce(or_, on_limit)), [key], "id")
    last = [(F.col(key) == k) & (F.col("before") == n - 1) for k, (_, n) in blocks.items()]
    rows = ids.filter(reduce(or_, last)).select(key, "id").collect()
    return {row[key]: (blocks[row[key]][0], row.id) for row in rows}


def in_top(value: Column, identity: Column, limit: tuple[int, int] | None) -> Column:
    if limit is None:
        return F.lit(False)
    v_limit, id_limit = limit
    return (value > v_limit) | ((value == v_limit) & (identity <= id_limit))


def percentiles(
    values: DataFrame, key: str, percents: tuple[int, ...], weight: Column | None = None
) -> DataFrame:
    """Exact continuous percentiles per key: columns p50, ... with two more decimals than v,
    and the number of rows."""
    positions = value_positions(values, [key], weight=weight)

    def at(index: Column) -> Column:
        holds = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
        return F.max(F.when(holds, F.col("v")))

    picked = []
    for percent in percents:
        steps = (F.col("total") - 1) * percent
        low = F.call_function("div", steps, F.lit(100))
        high = F.least(low + 1, F.col("total") - 1)
        picked += [at(low).alias(f"low{percent}"), at(high).alias(f"high{percent}")]
    rows = positions.groupBy(key, "total").agg(*picked)

    def between(percent: int) -> Column:
        low, high = (F.col(f"{side}{percent}").cast("decimal(24,0)") for side in ("low", "high"))
        part = ((F.col("total") - 1) * percent % 100).cast("decimal(3,0)")
        value = (low * 100 + (high - low) * part) * F.lit(Decimal("0.01"))
        return value.cast("decimal(24,2)").alias(f"p{percent}")

    return rows.select(key, F.col("total").alias("rows"), *[between(p) for p in percents])


def top_share(values: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Sum of v over the first ceil(total * numerator / denominator) rows, largest first, and
    over all rows. Ties need no order here: equal values add the same."""
    flipped = values.select(F.lit(1).alias("key"), (-F.col("v")).alias("v"))
    positions = value_positions(flipped, ["key"])
    wanted = F.call_function(
        "div", F.col("total") * numerator + (denominator - 1), F.lit(denominator)
    )
    taken = F.greatest(F.lit(0), F.least(F.col("n"), wanted - F.col("before")))
    amount = (-F.col("v")).cast("decimal(27,0)")
    return positions.agg(
        F.sum(amount * taken).cast("decimal(38,0)").alias("top"),
        F.sum(amount * F.col("n")).cast("decimal(38,0)").alias("everything"),
    )


def within_top_tenth(values: DataFrame) -> DataFrame:
    """Sum of v over rows with cume_dist (largest first) <= 0.1, and over all rows."""
    flipped = values.select(F.lit(1).alias("key"), (-F.col("v")).alias("v"))
    positions = value_positions(flipped, ["key"])
    inside = (F.col("before") + F.col("n")) * 10 <= F.col("total")
    amount = (-F.col("v")).cast("decimal(27,0)") * F.col("n")
    return positions.agg(
        F.sum(F.when(inside, amount)).cast("decimal(38,0)").alias("top"),
        F.sum(amount).cast("decimal(38,0)").alias("everything"),
    )
