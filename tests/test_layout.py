"""Published tables stored by customer: read without a shuffle by customer, from any session."""

import pytest
from pyspark.sql import functions as F

from scenarios import PARAMS, buy, raw_of
from test_run import full_base, log_of
from tillroll.operators import cohorts
from tillroll.operators.metrics import customer_facts
from tillroll.plans import publish, quality
from tillroll.plans.layers import all_needs
from tillroll.reference_data import non_product_codes


def lines():
    return [*full_base(), *[buy(None, f"6{i:02d}001", f"2011-0{1 + i % 9}-05", 2) for i in range(20)]]


def published(spark, root):
    raw = raw_of(spark, lines())
    return publish.process(raw, non_product_codes(spark), log_of(spark, len(lines())), PARAMS, root)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("published"))
    published(spark, where)
    return where


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    """The same run where one customer has more orders than a bucket may hold."""
    before, publish.BUCKET_ROWS = publish.BUCKET_ROWS, 3
    try:
        return published(spark, str(tmp_path_factory.mktemp("plain")))
    finally:
        publish.BUCKET_ROWS = before


def exchanges(spark, frame):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return [line for line in plan.splitlines() if "Exchange" in line and "customer_id" in line]


def test_nothing_is_shuffled_by_customer(spark, root, plain):
    run = publish.current(spark, root)
    assert run.buckets > 0

    def plans(own):
        orders = own.table("orders")
        return (
            customer_facts(orders, all_needs(PARAMS)),
            cohorts.cohort_retention(orders),
            quality._order_checks(orders, own.table("customer")),
            orders.join(own.table("customer"), "customer_id"),
        )

    assert [exchanges(spark, frame) for frame in plans(run)] == [[], [], [], []]
    assert all(exchanges(spark, frame) for frame in plans(plain))


def test_orders_without_a_customer_are_kept_apart_and_read_with_the_others(spark, root):
    run = publish.current(spark, root)
    orders = run.table("orders")
    assert orders.filter("customer_id IS NULL").count() == 20
    assert orders.count() == run.table("clean_line").select("invoice").distinct().count()
    assert spark.read.parquet(run.path("orders")).filter("customer_id IS NULL").isEmpty()
    assert spark.read.parquet(run.path(publish.UNKNOWN)).count() == 20


def test_another_session_reads_the_same_layout(spark, root):
    other = spark.newSession()
    run = publish.current(other, root)
    for name in publish.BY_CUSTOMER:  # as if another driver had written them
        other.sql(f"DROP TABLE IF EXISTS {run._listed(name)}")
    orders = run.table("orders")
    assert orders.count() == publish.current(spark, root).table("orders").count()
    assert exchanges(other, orders.filter("customer_id IS NOT NULL").groupBy("customer_id").count()) == []


def test_a_hot_customer_makes_the_layout_plain_and_changes_no_row(spark, root, plain):
    run = publish.current(spark, root)
    assert plain.buckets == 0 and plain.counted.keys() == quality.table_rules(PARAMS).keys()
    for name in publish.TABLES:
        one, other = run.table(name), plain.table(name)
        assert one.count() == other.count() > 0
        assert one.select(other.columns).exceptAll(other).isEmpty(), name
    assert sorted(r.violations for r in run.table("row_rules").collect()) == [
        0 for _ in range(plain.table("row_rules").count())
    ]


def test_customers_without_orders_of_their_own(spark, tmp_path):
    """No order with a customer at all: the tables by customer are there, and empty."""
    run = publish.Run(spark, str(tmp_path), "run", PARAMS)
    own = [buy(None, f"6{i:02d}001", "2011-03-05", 2) for i in range(3)]
    layers = publish.run_layers(raw_of(spark, own), non_product_codes(spark), PARAMS, run)
    for name in ("clean_line", "invoices"):
        layers.table(name)
    run.lay_out(layers.invoices)
    assert layers.orders.count() == 3 and layers.facts.isEmpty()
    assert cohorts.monthly_revenue(layers.orders, PARAMS.end).agg(F.sum("purchases")).first()[0] == 3
