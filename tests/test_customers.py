from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
from zoneinfo import ZoneInfo

import pytest

from scenarios import PARAMS, buy, by, layers_of, lines_of, orders_of, trade
from tillroll.operators.metrics import At, FactSpec, customer_facts, customer_metrics
from tillroll.operators.rfm import rfm_at
from tillroll.params import add_months
from tillroll.plans import report
from tillroll.reference_data import SEGMENT_OF_SCORES, SEGMENTS

END = PARAMS.end


def rfm(spark, lines, ref=END):
    spec = FactSpec.of(refs=[ref])
    return rfm_at(layers_of(spark, lines, spec=spec).facts, ref, PARAMS.wholesale_units)


def test_freight_is_not_product_revenue(spark):
    goods, freight = [(3, "1.25"), (7, "0.40")], [(1, "4.95"), (2, "6.30")]
    lines = []
    for code, cells in (("22086", goods), ("POST", freight)):
        lines += [buy(20011, "700001", "2010-05-04", n, price, code) for n, price in cells]
    lines += [buy(20012, "700002", "2010-05-04", n, price, "POST") for n, price in freight]
    lines += [buy(20012, "A700003", "2010-05-04", 1, "9.00")]
    worth = {name: sum(n * Decimal(p) for n, p in cells) for name, cells in (("g", goods), ("f", freight))}
    columns = ("product_revenue", "other_revenue", "units", "lines", "is_purchase")
    found = by(orders_of(spark, lines), "invoice", *columns)
    assert found == {
        "700001": (worth["g"], worth["f"], 10, 4, True),
        "700002": (0, worth["f"], 0, 2, False),
    }


def half_up(value, places):
    return Decimal(value).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def london_seconds(moment):
    return moment.replace(tzinfo=ZoneInfo("Europe/London")).timestamp()


def metrics_by_hand(events, ref):
    """Every customer with a purchase before ref; each unit is worth 10."""
    found = {}
    for who in {who for who, _, _ in events if who is not None}:
        seen = [(at, units) for other, at, units in events if other == who and at < ref]
        bought = [(at, units) for at, units in seen if units > 0]
        if not bought:
            continue
        first, last = min(bought)[0], max(bought)[0]
        gross, units = 10 * sum(u for _, u in bought), sum(u for _, u in bought)
        back = -10 * sum(u for _, u in seen if u < 0)
        months = Fraction(int(london_seconds(ref) - london_seconds(first)), 2_629_800)
        found[who] = (
            first, last, (ref.date() - last.date()).days, len(bought), gross, back, gross - back,
            half_up(Decimal(gross - back) / len(bought), 2), half_up(Decimal(back) / gross, 4),
            half_up(Decimal(units) / len(bought), 1),
            max(Decimal(1), half_up(Decimal(months.numerator) / months.denominator, 2)),
        )
    return found


METRICS = (
    "first_purchase", "last_purchase", "recency_days", "frequency", "gross_revenue", "cancelled_value",
    "net_revenue", "avg_ticket", "cancel_rate", "units_per_order", "months_of_life",
)


@pytest.mark.parametrize("ref", [datetime(2011, 12, 10), datetime(2010, 10, 31, 12, 30), datetime(2010, 1, 1)])
def test_metrics_against_brute_force(spark, ref):
    """At any reference date, and whatever happens from it on."""
    events = trade(31, customers=15, purchases=150)
    expected = metrics_by_hand(events, ref)
    assert by(customer_metrics(orders_of(spark, lines_of(events)), ref), "customer_id", *METRICS) == expected
    before = [event for event in events if event[1] < ref]
    if before:
        assert by(customer_metrics(orders_of(spark, lines_of(before)), ref), "customer_id", *METRICS) == expected


def score(values, own):
    """1 to 5 by the share of other values that are smaller, as whole numbers."""
    below = sum(v < own for v in values)
    return min(5, 1 + 5 * below // max(1, len(values) - 1))


@pytest.mark.parametrize("seed", [3, 4])
def test_scores_against_brute_force(spark, seed):
    """Few distinct values, so many ties; customers whose net revenue is not positive get M 1."""
    events = [e for e in trade(seed, customers=25, purchases=120) if e[0] is not None]
    bought = {who for who, _, units in events if units > 0}
    figures = {}
    for who in bought:
        own = [(moment, units) for other, moment, units in events if other == who]
        last = max(moment for moment, units in own if units > 0)
        figures[who] = (
            -(END - last.date()).days,
            sum(units > 0 for _, units in own),
            sum(units for _, units in own),
        )
    columns = list(zip(*figures.values()))
    expected = {
        who: (score(columns[0], r), score(columns[1], f), score(columns[2], m) if m > 0 else 1)
        for who, (r, f, m) in figures.items()
    }
    assert by(rfm(spark, lines_of(events)), "customer_id", "r", "f", "m") == expected


def test_net_not_positive_and_wholesale_edges(spark):
    lines = [
        buy(10001, "536001", "2011-01-10", 50),
        buy(10001, "C536002", "2011-01-11", -50),
        buy(10002, "536003", "2011-01-10", 399, "0.010"),
        buy(10003, "536004", "2011-01-10", 400, "0.010"),
        # 7999 units in 20 purchases are 399.95, which rounds to 400.0.
        *[buy(10004, f"5361{k:02d}", "2011-01-10", 400 if k else 399, "0.010") for k in range(20)],
    ]
    found = by(
        rfm(spark, lines), "customer_id", "net_revenue", "m", "net_not_positive", "is_wholesale"
    )
    assert found[10001] == (0, 1, True, False)
    assert [found[c][3] for c in (10002, 10003, 10004)] == [False, True, True]


def test_segment_map_never_worsens(spark):
    order = {name: position for name, position, _ in SEGMENTS}
    grid = {(r, f): order[s] for r, row in SEGMENT_OF_SCORES.items() for f, s in enumerate(row, 1)}
    assert len(grid) == 25 and set(grid.values()) == set(range(1, 11))
    for (r, f), place in grid.items():
        assert place >= grid.get((r + 1, f), 0) or r == 5
        assert place >= grid.get((r, f + 1), 0) or f == 5


def test_months_are_added_on_the_calendar():
    assert add_months(date(2011, 8, 31), 6) == datetime(2012, 2, 29)
    assert add_months(date(2011, 1, 10), -12) == datetime(2010, 1, 10)


@pytest.mark.parametrize("zone", ["Europe/London", "UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_session_time_zone_changes_nothing(spark, zone):
    lines = [
        buy(10001, "536001", "2010-03-28 00:30:00"),
        buy(10001, "536002", "2011-03-27 23:30:00"),
        buy(10001, "536003", "2011-07-31 23:30:00"),
        buy(10002, "536004", "2011-06-09 23:59:59"),
        buy(10002, "C536005", "2011-06-10 00:00:00", -1),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        orders = orders_of(spark, lines)
        months = by(orders, "invoice", "month")
        assert months["536003"] == (date(2011, 7, 1),)
        spec = FactSpec.of(refs=[PARAMS.cutoff], returns=[(PARAMS.cutoff, date(2011, 12, 10))])
        facts = customer_facts(orders, spec)
        at = At.of(PARAMS.cutoff)
        columns = [at.recency_days.alias("recency"), at.months_of_life.alias("months")]
        found = by(facts.select("customer_id", *columns), "customer_id", "recency", "months")
        # 2010-03-28 00:30 GMT to 2011-06-10 00:00 BST: 438 days and 22.5 hours.
        assert found == {10001: (75, Decimal("14.42")), 10002: (1, Decimal("1.00"))}
        columns = ("first_purchase", "recency_days", "cancelled_value")
        metrics = by(customer_metrics(orders, PARAMS.cutoff), "customer_id", *columns)
        assert metrics[10001] == (datetime(2010, 3, 28, 0, 30), 75, 0)
        assert metrics[10002][2] == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_views_over_customers(spark):
    ages = [0, 30, 31, 90, 91, 180, 181, 365, 366]
    lines = [
        buy(10001 + i, f"53600{i}", str(END.fromordinal(END.toordinal() - age)) + " 00:00:00")
        for i, age in enumerate(ages)
        if age
    ]
    snapshot = layers_of(spark, lines).snapshot
    view = by(
        report.customer_view(snapshot), "recency_days", "recency_band_order", "churn_status", "is_churned"
    )
    assert {age: band for age, (band, *_) in view.items()} == {
        30: 1, 31: 2, 90: 2, 91: 3, 180: 3, 181: 4, 365: 4, 366: 5,
    }
    assert view[90][1:] == ("active", False) and view[91][1:] == ("at_risk", True)
    assert view[365][1] == "at_risk" and view[366][1] == "inactive"
    summary = report.segment_summary(snapshot).collect()
    assert len(summary) == 10 and sum(r.customers for r in summary) == 8
    assert abs(sum(r.customer_share for r in summary) - 1) < Decimal("0.001")
    empty = report.segment_summary(snapshot.filter("false")).collect()
    assert len(empty) == 10
    assert {(r.customers, r.customer_share, r.revenue_share) for r in empty} == {(0, None, None)}


def test_revenue_of_twelve_months(spark):
    lines = [
        buy(12345, "536001", "2010-12-09 23:59:59", 100),
        buy(12345, "536002", "2010-12-10 00:00:00", 5),
        buy(12345, "C536003", "2011-02-01", -2),
    ]
    assert layers_of(spark, lines).snapshot.first().revenue_12m == Decimal("30.000")
