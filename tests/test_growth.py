"""Steps whose tasks or shuffles must not grow with the tables: plans, and results by brute force."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillroll import workspace
from tillroll.functions import clock
from tillroll.operators import clean, duplicates, measurements, windows
from tillroll.params import LONDON
from tillroll.plans.layers import Layers
from tillroll.sources import tables


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Tables too large for Spark to broadcast by their size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most", [workspace.BROADCAST_ROWS, 0])
def test_repeated_rows_stay_where_they_are(spark, no_broadcast, monkeypatch, most):
    monkeypatch.setattr(workspace, "BROADCAST_ROWS", most)
    rows = [(k, "x" if k % 2 else None) for k in range(40)] + [(3, "x"), (4, None), (4, None), (None, None), (None, None)]
    found = duplicates.repeated_rows(spark.createDataFrame(rows, "k int, t string"), ("k", "t"))
    assert ("BroadcastHashJoin" in plan(found)) == (most > 0)
    assert ("Exchange hashpartitioning" in plan(found)) == (most == 0)
    listed = sorted((r.k or -1, r.t or "") for r in found.collect())
    assert listed == [(-1, ""), (-1, ""), (3, "x"), (3, "x"), (4, ""), (4, ""), (4, "")]


@pytest.mark.parametrize("most", [workspace.BROADCAST_ROWS, 0])
def test_lines_are_not_shuffled_by_code(spark, no_broadcast, monkeypatch, most):
    monkeypatch.setattr(workspace, "BROADCAST_ROWS", most)
    raw = spark.sql(
        "SELECT 'a' AS sheet, 'f' AS source_file, id AS source_row, '100001' AS invoice, "
        "concat('code ', id, ' ') AS stock_code, 'd' AS description, '2' AS quantity, '2010-01-05 10:00:00' AS "
        "invoice_date, '1.500' AS unit_price, '12345' AS customer_id, 'c' AS country FROM range(20)"
    )
    codes = spark.createDataFrame([("code 3", "post", ""), ("code 3", "post", ""), ("other", "post", "")], "code string, kind string, reason string")
    lines = clean.clean(raw, codes, tables.PARAMETERS.batches, clock.moment(clock.FAR_FUTURE))
    assert ("BroadcastHashJoin" in plan(lines)) == (most > 0)
    assert [r.stock_code for r in lines.filter("NOT is_product").collect()] == ["code 3"] and lines.count() == 20


def test_returns_are_counted_by_window_alone(spark):
    days = [(1, "2010-01-05"), (1, "2010-02-10"), (1, "2010-02-11"), (2, "2010-02-03"), (2, "2010-02-20"),
            (1, None), (None, "2010-02-09"), (4, "2010-01-31"), (4, "2010-03-01")]
    orders = spark.createDataFrame(days, "customer_id bigint, day string").select(
        "customer_id",
        F.col("day").cast("timestamp_ntz").alias("ts_local"),
        F.lit(True).alias("is_purchase"),
        F.lit(5).cast("decimal(24,3)").alias("product_revenue"),
    )
    made = [("feb", "2010-02-01", "2010-03-01"), ("long", "2010-02-01", "2010-04-01"), ("inside", "2010-02-11", "2010-03-01")]
    table = spark.createDataFrame(made, "id string, start string, end string")
    table = table.select("id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")])
    found = windows.returns_in_windows(orders, table)
    assert {r.id: (r.customers, r.returned, int(r.spent)) for r in found.collect()} == {
        "feb": (2, 1, 10), "long": (2, 2, 15), "inside": (3, 2, 10)
    }
    by_window = [line for line in plan(found).splitlines() if "Aggregate(keys=[id#" in line]
    assert by_window and not any("customer_id" in line.split("]")[0] for line in by_window)


def test_lines_are_dealt_to_partitions_by_their_number(spark, tmp_path, monkeypatch):
    assert [workspace.row_parts(spark, n) for n in (0, 1, 360_000_000)] == [1, 1, 1440]
    made = {
        "lineitem": [(k % 50, k % 7, 0, k % 8, 3.0, 0.1, 0.08, "R") for k in range(300)],
        "orders": [(k, k % 5, datetime(1996, 1, 1), "1-URGENT") for k in range(50)],
        "part": [(k, f"part {k}", 5, 2.5) for k in range(7)],
        "supplier": [(0, 0)],
        "nation": [(0, "FRANCE")],
    }
    for name, rows in made.items():
        schema = tables._SCHEMAS[name]
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    before = tables.raw_lines(spark, str(tmp_path)).drop("source_file").collect()
    monkeypatch.setattr(workspace, "PART_ROWS", 20)
    raw = tables.raw_lines(spark, str(tmp_path))
    assert plan(raw).count("hashpartitioning(l_orderkey") == 2
    assert all(", 15)" in line for line in plan(raw).splitlines() if "hashpartitioning(l_orderkey" in line)
    assert sorted(map(str, raw.drop("source_file").collect())) == sorted(map(str, before)) and len(before) == 300
    assert {len(r.stock_code) for r in before} == {5, 6} and {r.invoice[0] for r in before} == {"C"}


def test_sold_lines_are_dealt_to_partitions_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(measurements, "row_parts", lambda spark, rows: 13)
    asked = []
    own = measurements.rank.percentiles
    monkeypatch.setattr(measurements.rank, "percentiles", lambda v, *a, **b: asked.append(plan(v)) or own(v, *a, **b))
    rows = [("i1", "a", 2), ("i1", "a", 3), ("i1", "b", 5), ("i2", "a", 2), ("i3", "c", 9), (None, "c", 2)]
    sold = spark.createDataFrame(rows, "invoice string, stock_code string, p int").select(
        "invoice", "stock_code", F.col("p").cast("decimal(14,3)").alias("value"), F.col("p").cast("decimal(12,3)").alias("unit_price")
    )
    found = {r.what: (r.rows, float(r.median)) for r in measurements.order_medians(sold).collect()}
    assert found == {"products": (4, 1.0), "value": (4, 5.5), "unit_price": (6, 2.5)}
    assert asked[0].count(", 13)") == 2 and "invoice#" in asked[0]


def test_utc_by_rule_is_utc_by_zone(spark):
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 30).cast("int"))
    at = spark.range(50 * 366 * 48).select((F.lit("1990-01-01 00:00:00").cast("timestamp_ntz") + minutes).alias("at"))
    at = at.union(spark.sql("SELECT CAST(NULL AS timestamp_ntz)")).union(spark.sql("SELECT timestamp_ntz'2030-10-27 01:59:59.999999'"))
    by_zone = F.convert_timezone(F.lit(LONDON), F.lit("UTC"), "at")
    assert at.filter(~clock.to_utc(F.col("at")).eqNullSafe(by_zone)).isEmpty()


def test_unread_columns_are_not_stored(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, ts_utc int")
    layers = Layers(frame, frame, tables.PARAMETERS, keep=("own",), unread=("ts_utc",))
    assert layers._layer("own", lambda: frame).columns == ["a"]
    assert layers._layer("passing", lambda: frame).columns == ["a", "ts_utc"]
