"""Run parameters. They become literals in the plans, so Spark can fold them."""

from __future__ import annotations

import calendar
from dataclasses import dataclass, field, replace
from datetime import date, datetime, time

LONDON = "Europe/London"


def as_datetime(day: date | datetime) -> datetime:
    """Midnight (London wall clock) of a date; a datetime is taken as it is."""
    if isinstance(day, datetime):
        return day
    return datetime.combine(day, time.min)


def add_months(moment: date | datetime, months: int) -> datetime:
    """Calendar months on the wall clock; the day is held back to the month's last day."""
    moment = as_datetime(moment)
    total = moment.year * 12 + moment.month - 1 + months
    year, month = divmod(total, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return moment.replace(year=year, month=month + 1, day=min(moment.day, last))


@dataclass(frozen=True)
class Batches:
    """Two overlapping source batches; from the newer one's first day the older is a copy."""

    older: str = "Year 2009-2010"
    newer: str = "Year 2010-2011"


@dataclass(frozen=True)
class Formats:
    """What well-formed text looks like (Java regular expressions, matched whole)."""

    # Fixed values of the source data's formats.
    invoice: str = r"[CA]?[0-9]{6}"
    quantity: str = r"-?[0-9]+"
    unit_price: str = r"-?[0-9]+(\.[0-9]+)?"
    invoice_date: str = r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}"
    customer_id: str = r"[0-9]{5}"
    product_code: str = r"[0-9]{5}[A-Za-z]{0,2}"
    product_code_prefixes: tuple[str, ...] = ("DCGS",)
    product_code_exceptions: tuple[str, ...] = ("PADS", "SP1002", "47503J")
    customer_id_range: tuple[int, int] | None = (10000, 99999)


@dataclass(frozen=True)
class Parameters:
    # Fixed default values of the analysis.
    end: date = date(2011, 12, 10)
    cutoff: date = date(2011, 6, 10)
    robustness_cutoff: date = date(2010, 12, 10)
    wholesale_units: int = 400
    churn_days: int = 90
    inactive_days: int = 365
    churn_window_months: int = 6
    churn_thresholds: tuple[int, ...] = (30, 60, 90, 120, 150, 180, 240, 365)
    clv_horizon_months: int = 6
    clv_validation_months: int = 6
    clv_prior_months: int = 3
    known_anomalies: tuple[str, ...] = ("C496350",)
    batches: Batches = field(default_factory=Batches)
    formats: Formats = field(default_factory=Formats)

    @property
    def churn_cutoffs(self) -> tuple[date, date]:
        return (self.cutoff, self.robustness_cutoff)

    def with_(self, **changes) -> Parameters:
        return replace(self, **changes)

    def rows(self) -> list[tuple[str, str, str]]:
        """The parameter table: name, value, description."""
        return [
            ("end", self.end.isoformat(), "final reference date, the day after the last invoice"),
            ("cutoff", self.cutoff.isoformat(), "cut-off that validates churn and customer value"),
            ("robustness_cutoff", self.robustness_cutoff.isoformat(), "second churn cut-off"),
            ("wholesale_units", str(self.wholesale_units), "mean units per purchase of a wholesaler"),
            ("churn_days", str(self.churn_days), "more days than this without a purchase is churn"),
            ("churn_window_months", str(self.churn_window_months), "months in which a return counts"),
            ("clv_horizon_months", str(self.clv_horizon_months), "months predicted at the end"),
            ("clv_validation_months", str(self.clv_validation_months), "months predicted at the cut-off"),
            ("clv_prior_months", str(self.clv_prior_months), "weight of the base rate, in months"),
        ]
