import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.operators import rank


def frame(spark, values, key="k"):
    return spark.createDataFrame([(key, v, i) for i, v in enumerate(values)], "key string, v bigint, id bigint")


def spread(seed=1, n=400):
    """Negative, tied, tiny and huge values; one value holds a third of the rows."""
    rng = random.Random(seed)
    pool = [rng.choice([rng.randint(-50, 50), rng.randint(-(2**45), 2**45)]) for _ in range(n)]
    return pool + [7] * (n // 2)


def test_positions_equal_plain_windows(spark):
    data = frame(spark, spread()).union(frame(spark, spread(2, 60), "other"))
    plain = Window.partitionBy("key").orderBy("v")
    wanted = data.select(
        "key",
        "v",
        (F.rank().over(plain) - 1).alias("before"),
        F.round(F.percent_rank().over(plain), 9).alias("pr"),
        F.round(F.cume_dist().over(plain), 9).alias("cd"),
    ).distinct()
    found = rank.value_positions(data, ["key"])
    span = F.greatest(F.col("total") - 1, F.lit(1))
    found = found.select(
        "key",
        "v",
        "before",
        F.round(F.col("before") / span, 9).alias("pr"),
        F.round((F.col("before") + F.col("n")) / F.col("total"), 9).alias("cd"),
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


@pytest.mark.parametrize("values", [[5], [1, 1, 1, 1, 2, 3, 4, 5, 6, 7], [4] * 9, spread(3, 90)])
def test_scores_equal_the_formula(spark, values):
    data = frame(spark, values)
    limits = rank.score_limits(data)["k"]
    pr = F.percent_rank().over(Window.partitionBy("key").orderBy("v"))
    wanted = F.least(F.lit(5), 1 + F.floor(5 * pr)).cast("int")
    rows = data.select("v", wanted.alias("wanted"), rank.score_of(F.col("v"), limits).alias("got"))
    assert [r.got for r in rows.collect()] == [r.wanted for r in rows.collect()]


@pytest.mark.parametrize("values", [[10, 20, 90, 40, 50], [0] * 50 + [3, 9], spread(4, 120)])
def test_top_fifth_equals_row_number(spark, values):
    data = frame(spark, values)
    order = Window.partitionBy("key").orderBy(F.desc("v"), "id")
    wanted = data.withColumn("pos", F.row_number().over(order)).filter(
        F.col("pos") <= -(-len(values) // 5)
    )
    limit = rank.top_fifth_limits(data)["k"]
    found = data.filter(rank.in_top(F.col("v"), F.col("id"), limit))
    assert {r.id for r in found.collect()} == {r.id for r in wanted.collect()}


def test_percentiles_and_shares(spark):
    data = frame(spark, [1, 2, 4, 8])
    row = rank.percentiles(data, "key", (50, 75)).first()
    assert (row.rows, float(row.p50), float(row.p75)) == (4, 3.0, 5.0)
    weighted = spark.createDataFrame([("k", 1, 3), ("k", 9, 1)], "key string, v bigint, w bigint")
    assert float(rank.percentiles(weighted, "key", (50,), F.col("w")).first().p50) == 1.0
    share = rank.top_share(frame(spark, [10, 20, 30, 30, 10]), 2, 5).first()
    assert (share.top, share.everything) == (60, 100)
    tenth = rank.within_top_tenth(frame(spark, list(range(1, 21)))).first()
    assert (tenth.top, tenth.everything) == (39, 210)


def test_no_row_is_sorted_in_a_single_partition(spark):
    data = spark.range(1000).select((F.col("id") % 3).alias("key"), F.col("id").alias("v"))
    plan = rank.value_positions(data, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
