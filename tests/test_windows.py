"""Bands and windows from tables against plain loops and the literal forms; quantile sketches
against exact percentiles."""

import random
from bisect import bisect_left, bisect_right
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scenarios import lines_of, orders_of, trade
from tillroll.operators import sketches, windows
from tillroll.operators.metrics import FactSpec, customer_facts, returned_column, span

PLAIN = "NestedLoop"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(4))
def test_range_join_by_brute_force(spark, seed):
    own = random.Random(seed)
    points = [(k, own.choice([None, own.randint(-500, 500)])) for k in range(120)]
    ranges = []
    for k in range(60):
        start = own.randint(-600, 600)
        ranges.append((k, start, start + own.choice([-3, 0, 1, 2, 30, 400])))
    ranges += [(100, None, 5), (101, 5, None)]
    left = spark.createDataFrame(points, "k int, at long")
    right = spark.createDataFrame(ranges, "r int, low long, high long")
    found = windows.range_join(left, F.col("at"), right, "low", "high")
    assert PLAIN not in plan(found)
    expected = {
        (k, r) for k, at in points for r, low, high in ranges
        if None not in (at, low, high) and low <= at < high
    }
    rows = [(x.k, x.r) for x in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected
    for one, other in ((left.limit(0), right), (left, right.limit(0))):
        assert windows.range_join(one, F.col("at"), other, "low", "high").isEmpty()


def test_bands_from_a_table(spark):
    values = [None, -5, 0, 29, 30, 31, 90, 91, 365, 366, 10**9]
    frame = spark.createDataFrame([(v,) for v in values], "v int")
    bands = spark.createDataFrame(
        [("low", None, 30), ("mid", 31, 90), ("high", 91, 365), ("top", 1000, None)], "band string, from_ int, upto int"
    )
    found = {(r.v, r.band) for r in windows.in_bands(frame, "v", bands).collect()}
    assert found == {(-5, "low"), (0, "low"), (29, "low"), (30, "low"), (31, "mid"), (90, "mid"), (91, "high"),
                     (365, "high"), (10**9, "top")}
    assert windows.in_bands(frame.limit(0), "v", bands).isEmpty()


def test_two_hundred_windows_from_a_table_are_those_of_literals(spark, tmp_path):
    events = trade(51, customers=30, purchases=400)
    orders_of(spark, lines_of(events)).write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")
    own, made = random.Random(5), []
    for k in range(200):
        start = datetime(2009, 11, 1) + timedelta(minutes=own.randrange(800 * 24 * 60))
        start = start.replace(hour=0, minute=0) if k % 2 else start
        made.append((k, start, start + timedelta(days=own.choice([1, 30, 180]))))
    made[0] = (0, *sorted([events[3][1], events[4][1]]))  # begins with a purchase
    table = spark.createDataFrame([(k, str(a), str(b)) for k, a, b in made], "id int, start string, end string")
    table = table.select("id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")])
    frame = windows.returns_in_windows(orders, table)
    assert PLAIN not in plan(frame) and "CartesianProduct" not in plan(frame)
    found = {r.id: (r.customers, r.returned, float(r.spent)) for r in frame.collect()}

    bought = [(who, at, 10.0 * units) for who, at, units in events if who is not None and units > 0]
    firsts = {who: min(at for w, at, _ in bought if w == who) for who, _, _ in bought}
    for k, start, end in made:
        back = [(who, spent) for who, at, spent in bought if start <= at < end and firsts[who] < start]
        known = sum(first < start for first in firsts.values())
        assert found[k] == (known, len({who for who, _ in back}), sum(s for _, s in back)), (k, start)

    for k, start, end in made[:3]:  # the literal form
        window = span(start, end)
        facts = customer_facts(orders, FactSpec.of(refs=[start], returns=[window]))
        known = facts.filter(F.col([c for c in facts.columns if c.startswith("frequency_")][0]) > 0)
        counted = known.agg(F.count(F.lit(1)), F.count_if(returned_column(window))).first()
        assert tuple(counted) == found[k][:2]


def test_sketches_are_exact_up_to_k_rows(spark):
    own = random.Random(6)
    rows = [(k % 3, own.randint(0, 10**6)) for k in range(900)] + [(0, None), (7, None)]
    frame = spark.createDataFrame(rows, "key int, v long").repartition(5)
    found = sketches.percentiles(sketches.sketched(frame, ["key"], k=512), (1, 50, 100))
    for row in found.collect():
        values = sorted(v for key, v in rows if key == row.key and v is not None)
        assert row.rows == len(values) == 300
        assert (row.p1, row.p50, row.p100) == (values[2], values[149], values[-1])
    assert sketches.sketched(frame.limit(0), ["key"]).isEmpty()


@pytest.mark.parametrize("k", [64, 256])
def test_merged_sketches_stay_within_the_bound(spark, k):
    """Sketches of days merged to a window, and one of the whole window, against exact ranks."""
    values = spark.range(60_000).select(
        (F.col("id") % 50).alias("day"), (F.abs(F.hash("id")) % 10_000).cast("long").alias("v")
    )
    exact = sorted(r.v for r in values.collect())
    days = sketches.sketched(values, ["day"], k=k)
    window = sketches.merged(days.withColumn("all", F.lit(1)), ["all"], k=k)
    whole = sketches.sketched(values.withColumn("all", F.lit(1)), ["all"], k=k)
    bound = 2 * sketches.rank_error(k)
    for sketch in (window, whole):
        row = sketches.percentiles(sketch, (5, 25, 50, 75, 95)).first()
        assert row.rows == 60_000
        for percent in (5, 25, 50, 75, 95):
            low, high = (f(exact, row[f"p{percent}"]) / 60_000 for f in (bisect_left, bisect_right))
            assert low - bound <= percent / 100 <= high + bound
    part = sketches.merged(days.filter("day < 10").withColumn("all", F.lit(1)), ["all"], k=k)
    assert part.first().rows == 12_000


def test_a_smaller_error_needs_a_larger_sketch():
    assert sketches.rank_error(4096) < 0.0015 < sketches.rank_error(200) < 0.02
