"""Customer metrics at reference dates, from one pass over the orders.

Every figure an analysis needs about a customer at some date is a conditional aggregate over
that customer's orders. `FactSpec` names the dates and windows wanted; `customer_facts` gets
them all in one shuffle, merged on the map side.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import clock, money
from tillroll.functions.predicates import CANCEL, counts_as_revenue
from tillroll.params import as_datetime

# Mean month length in seconds (30.4375 days).
MONTH_SECONDS = 2_629_800

Span = tuple[datetime, datetime]


def span(start: date | datetime, end: date | datetime) -> Span:
    return (as_datetime(start), as_datetime(end))


@dataclass(frozen=True)
class FactSpec:
    """refs: dates whose history is wanted. returns: windows for "bought in it". nets: windows
    for net revenue."""

    refs: frozenset[datetime] = frozenset()
    returns: frozenset[Span] = frozenset()
    nets: frozenset[Span] = frozenset()

    @staticmethod
    def of(refs=(), returns=(), nets=()) -> FactSpec:
        return FactSpec(
            frozenset(as_datetime(r) for r in refs),
            frozenset(span(*w) for w in returns),
            frozenset(span(*w) for w in nets),
        )

    def __or__(self, other: FactSpec) -> FactSpec:
        return FactSpec(
            self.refs | other.refs, self.returns | other.returns, self.nets | other.nets
        )

    def latest(self) -> datetime:
        ends = [w[1] for w in self.returns | self.nets]
        return max([*self.refs, *ends])


def _stamp(when: date | datetime) -> str:
    when = as_datetime(when)
    return when.strftime("%Y%m%d" if when.time() == when.min.time() else "%Y%m%dT%H%M%S")


def returned_column(window: Span) -> str:
    return f"back_{_stamp(window[0])}_{_stamp(window[1])}"


def net_column(window: Span) -> str:
    return f"net_{_stamp(window[0])}_{_stamp(window[1])}"


def customer_facts(orders: DataFrame, spec: FactSpec) -> DataFrame:
    ts = F.col("ts_local")
    purchase = F.col("is_purchase")
    revenue = F.col("_revenue")
    aggregates: list[Column] = []
    for ref in sorted(spec.refs):
        tag = _stamp(ref)
        before = ts < clock.moment(ref)
        bought = purchase & before
        cancelled = (F.col("kind") == CANCEL) & before
        aggregates += [
            F.min(F.when(bought, ts)).alias(f"first_{tag}"),
            F.max(F.when(bought, ts)).alias(f"last_{tag}"),
            F.count(F.when(bought, F.lit(1))).alias(f"frequency_{tag}"),
            money.from_thousandths(F.sum(F.when(bought, revenue))).alias(f"gross_{tag}"),
            _total(cancelled, -revenue).alias(f"cancelled_{tag}"),
            F.sum(F.when(bought, F.col("units"))).alias(f"units_{tag}"),
        ]
    for window in sorted(spec.returns):
        back = purchase & clock.within(ts, *window)
        aggregates.append(
            F.coalesce(F.bool_or(back), F.lit(False)).alias(returned_column(window))
        )
    for window in sorted(spec.nets):
        counted = counts_as_revenue(F.col("kind"), purchase) & clock.within(ts, *window)
        aggregates.append(_total(counted, revenue).alias(net_column(window)))
    known = F.col("customer_id").isNotNull() & (ts < clock.moment(spec.latest()))
    seen = orders.filter(known).withColumn(
        "_revenue", money.thousandths(F.col("product_revenue"))
    )
    return seen.groupBy("customer_id").agg(*aggregates)


def _total(condition: Column, amount: Column) -> Column:
    return money.from_thousandths(F.sum(F.when(condition, amount).otherwise(F.lit(0))))


@dataclass(frozen=True)
class At:
    """The metric columns of a facts table at one reference date."""

    ref: datetime

    @staticmethod
    def of(ref: date | datetime) -> At:
        return At(as_datetime(ref))

    def _col(self, name: str) -> Column:
        return F.col(f"{name}_{_stamp(self.ref)}")

    @property
    def known(self) -> Column:
        """At least one purchase before the date."""
        return self.frequency > 0

    @property
    def frequency(self) -> Column:
        return self._col("frequency")

    @property
    def recency_days(self) -> Column:
        return clock.days_between(clock.moment(self.ref), self._col("last"))

    @property
    def net_revenue(self) -> Column:
        return (self._col("gross") - self._col("cancelled")).cast(money.MONEY)

    @property
    def units_per_order(self) -> Column:
        return money.ratio(self._col("units"), self.frequency, 1, 15)

    @property
    def avg_ticket(self) -> Column:
        return money.ratio(self.net_revenue, self.frequency, 2, 24)

    @property
    def months_of_life(self) -> Column:
        """Months since the first purchase, at least 1."""
        ref_utc = clock.to_utc(clock.moment(self.ref))
        seconds = clock.seconds_between(ref_utc, clock.to_utc(self._col("first")))
        months = money.ratio(seconds, F.lit(MONTH_SECONDS), 2, 12)
        return F.greatest(F.lit(1).cast("decimal(12,2)"), months)

    def columns(self) -> list[Column]:
        return [
            F.col("customer_id"),
            self._col("first").alias("first_purchase"),
            self._col("last").alias("last_purchase"),
            self.recency_days.alias("recency_days"),
            self.frequency.alias("frequency"),
            self._col("gross").alias("gross_revenue"),
            self._col("cancelled").alias("cancelled_value"),
            self.net_revenue.alias("net_revenue"),
            self.avg_ticket.alias("avg_ticket"),
            money.ratio(self._col("cancelled"), self._col("gross"), 4, 12).alias("cancel_rate"),
            self.units_per_order.alias("units_per_order"),
            self.months_of_life.alias("months_of_life"),
        ]


def metrics_at(facts: DataFrame, ref: date | datetime, *extra: Column | str) -> DataFrame:
    """Customers with a purchase before `ref`, and their metrics there."""
    at = At.of(ref)
    return facts.filter(at.known).select(*at.columns(), *extra)


def customer_metrics(orders: DataFrame, ref: date | datetime) -> DataFrame:
    """Metrics of every customer with a purchase before `ref`; later orders are not seen."""
    return metrics_at(customer_facts(orders, FactSpec.of(refs=[ref])), ref)
