"""Recency, frequency and money scores 1..5, and the segment they map to."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money
from tillroll.operators import rank
from tillroll.operators.metrics import At, metrics_at
from tillroll.params import as_datetime
from tillroll.reference_data import segment_map


def _scored(at: At) -> dict[str, Column]:
    """The three whole numbers to rank, larger is better."""
    return {
        "r": -at.recency_days.cast("bigint"),
        "f": at.frequency.cast("bigint"),
        "m": money.thousandths(at.net_revenue),
    }


def _key(ref: datetime, score: str) -> str:
    return f"{ref.isoformat()} {score}"


Limits = dict[str, tuple[int | None, ...]]


def score_limits(facts: DataFrame, refs: Iterable[date | datetime]) -> Limits:
    """Score limits of all wanted dates, ranked in one pass: four numbers per date and score."""
    entries = []
    for ref in sorted(as_datetime(r) for r in refs):
        at = At.of(ref)
        for score, value in _scored(at).items():
            known = F.when(at.known, value)
            entries.append(F.struct(F.lit(_key(ref, score)).alias("key"), known.alias("v")))
    values = facts.select(F.inline(F.array(*entries))).filter(F.col("v").isNotNull())
    return rank.score_limits(values)


def rfm_at(
    facts: DataFrame,
    ref: date | datetime,
    wholesale_units: int,
    *extra: Column | str,
    limits: Limits | None = None,
) -> DataFrame:
    """Metrics at `ref` with scores, segment, wholesale flag and not-positive flag.

    `facts` is read twice (limits, rows), so pass a stored table. Give `limits` to share one
    ranking pass between several dates.
    """
    at = At.of(ref)
    if limits is None:
        limits = score_limits(facts, [ref])
    scores = {
        name: rank.score_of(value, limits.get(_key(at.ref, name), ()))
        for name, value in _scored(at).items()
    }
    not_positive = F.col("net_revenue") <= 0
    scored = metrics_at(
        facts, ref, *extra, scores["r"].alias("r"), scores["f"].alias("f"), scores["m"].alias("m")
    ).withColumns(
        {
            "m": F.when(not_positive, F.lit(1)).otherwise(F.col("m")),
            "is_wholesale": F.col("units_per_order") >= wholesale_units,
            "net_not_positive": not_positive,
        }
    )
    cells = segment_map(facts.sparkSession)
    return scored.join(F.broadcast(cells), ["r", "f"])
