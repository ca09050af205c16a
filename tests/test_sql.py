"""The SQL table functions against the DataFrame functions, and the set and array operations."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from scenarios import PARAMS, lines_of, orders_of, trade
from tillroll import sql
from tillroll.operators import churn, clv, cohorts, duplicates
from tillroll.operators.metrics import FactSpec, customer_facts, customer_metrics, span
from tillroll.operators.rfm import rfm_at
from tillroll.params import add_months

DATES = (date(2011, 12, 10), date(2011, 1, 5), date(2009, 11, 1))


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("sql") / "orders")
    orders_of(spark, lines_of(trade(21, customers=45, purchases=500))).write.parquet(place)
    own = spark.read.parquet(place)
    sql.register(spark, own, PARAMS)
    return own


def same(spark, select, frame):
    found = spark.sql(select)
    assert sorted(found.columns) == sorted(frame.columns)
    assert dict(found.dtypes) == dict(frame.dtypes)
    rows = sorted(map(str, found.collect()))
    assert rows == sorted(map(str, frame.select(found.columns).collect()))
    return len(rows)


@pytest.mark.parametrize("ref", DATES, ids=str)
def test_metrics_and_scores(spark, orders, ref):
    n = same(spark, f"SELECT * FROM customer_metrics(DATE '{ref}')", customer_metrics(orders, ref))
    facts = customer_facts(orders, FactSpec.of(refs=[ref]))
    assert same(spark, f"SELECT * FROM rfm(DATE '{ref}')", rfm_at(facts, ref, PARAMS.wholesale_units)) == n
    assert (n > 0) == (ref.year > 2009)


@pytest.mark.parametrize("months", [1, 6, 12])
def test_churn_retention_and_value(spark, orders, months):
    cut, days = date(2011, 3, 10), (0, 30, 90, 91, 400)
    select = f"SELECT * FROM validate_churn(DATE '{cut}', {months}, array{days})"
    assert same(spark, select, churn.validate_churn(orders, cut, months, days)) == len(days)
    facts = customer_facts(orders, FactSpec.of(refs=[cut], returns=[span(cut, add_months(cut, months))]))
    frame = clv.segment_retention(facts, cut, months, PARAMS.wholesale_units)
    assert same(spark, f"SELECT * FROM segment_retention(DATE '{cut}', {months})", frame) > 3
    facts = customer_facts(orders, clv.needs(cut, months))
    frame = clv.predict_clv(facts, cut, months, PARAMS)
    assert same(spark, f"SELECT * FROM predict_clv(DATE '{cut}', {months})", frame) > 20


def test_a_date_without_customers_has_no_rows(spark, orders):
    for call in ("validate_churn(DATE '2009-01-01', 6, array(30))", "segment_retention(DATE '2009-01-01', 6)",
                 "predict_clv(DATE '2009-01-01', 6)"):
        assert spark.sql(f"SELECT * FROM {call}").isEmpty()


def test_a_time_of_day_and_two_calls_in_one_query(spark, orders):
    ref = datetime(2011, 6, 1, 13, 30)
    assert same(spark, f"SELECT * FROM customer_metrics(TIMESTAMP_NTZ '{ref}')", customer_metrics(orders, ref)) > 0
    moved = spark.sql(
        "SELECT count(*) FROM rfm(DATE '2011-06-01') a JOIN rfm(DATE '2011-12-01') b USING (customer_id) "
        "WHERE a.segment != b.segment"
    ).first()[0]
    before, after = (
        {r.customer_id: r.segment for r in spark.sql(f"SELECT * FROM rfm(DATE '{d}')").collect()}
        for d in ("2011-06-01", "2011-12-01")
    )
    assert moved == sum(before[c] != after[c] for c in before.keys() & after.keys()) > 0


def test_the_date_reaches_the_scan(spark, orders):
    plan = spark.sql("SELECT customer_id, frequency FROM customer_metrics(DATE '2011-02-01')")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts_local,2011-02-01T00:00)" in text
    assert "other_revenue" not in text and "invoice" not in text


def test_ranks_are_built_in_blocks(spark, orders):
    plan = spark.sql("SELECT * FROM rfm(DATE '2011-12-10')")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("[k#" in line for line in windows)


def test_a_second_registration_replaces_the_first(spark, orders):
    planned = spark.sql("SELECT count(*) FROM customer_metrics(DATE '2011-12-10')")
    everyone = planned.first()[0]
    try:
        sql.register(spark, orders.filter("customer_id < 20020"), PARAMS)
        fewer = spark.sql("SELECT count(*) FROM customer_metrics(DATE '2011-12-10')").first()[0]
        assert 0 < fewer < everyone == planned.first()[0]
    finally:
        sql.register(spark, orders, PARAMS)


def test_set_difference_by_brute_force(spark):
    own = random.Random(4)

    def rows(n):
        return [(own.choice([None, *range(6)]), own.choice([None, "a", "b", ""])) for _ in range(n)]

    for n, m in ((30, 30), (60, 3), (0, 5), (0, 0)):
        left, right = rows(n), rows(m)
        frames = [spark.createDataFrame(x, "a int, __b string") for x in (left, right)]
        found = duplicates.set_difference(*frames)
        assert found.columns == ["a", "__b", "side"]
        wanted = [(*r, "left") for r in set(left) - set(right)] + [(*r, "right") for r in set(right) - set(left)]
        assert Counter(map(tuple, found.collect())) == Counter(wanted)


def test_set_difference_shuffles_hashes_before_rows(spark):
    frame = spark.range(100).select("id", F.repeat(F.lit("x"), 50).alias("wide"))
    plan = duplicates.set_difference(frame, frame)._jdf.queryExecution().optimizedPlan().toString()
    first = next(line for line in plan.splitlines()[::-1] if "Aggregate" in line)
    assert "wide" not in first.split("],")[0]


def test_cohort_arrays_by_brute_force(spark, orders):
    net, bought = defaultdict(int), Counter()
    for row in orders.filter("customer_id IS NOT NULL").collect():
        if row.is_purchase or row.kind == "cancel":
            net[row.customer_id, row.month] += row.product_revenue
        else:
            net[row.customer_id, row.month] += 0
        bought[row.customer_id, row.month] += row.is_purchase
    wanted = {}
    for customer in {c for c, _ in net}:
        months = sorted(m for c, m in net if c == customer)
        active = [m for m in months if bought[customer, m]]
        if active:
            wanted[customer] = (
                active[0], ",".join(map(str, active)), ",".join(f"{net[customer, m]:.3f}" for m in active),
                len(active), any(net[customer, m] < 0 for m in months), active == months,
            )
    found = {r.customer_id: tuple(r)[1:] for r in cohorts.cohort_arrays(orders).collect()}
    assert found == wanted


def test_cohort_flags(spark, orders):
    grid = cohorts.cohort_retention(orders)
    rows, flags = grid.collect(), {r.cohort: r for r in cohorts.cohort_flags(grid).collect()}
    assert set(flags) == {r.cohort for r in rows}
    for cohort, flag in flags.items():
        own = [r for r in rows if r.cohort == cohort]
        assert flag.pre_existing == any(r.pre_existing for r in own)
        assert flag.partial_months == ",".join(str(r.month) for r in sorted(own, key=lambda r: r.month) if r.partial_month)
