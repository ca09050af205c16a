"""Approximate percentiles at scale: quantile sketches that are stored once and merged over any window.

A KLL sketch holds about 3 k values however many rows it stands for, and two of them merge into one
of both, so sketches of days or months answer for every window of them without another look at the
rows. Up to k rows a percentile is exact; beyond, its rank is off by `rank_error(k)` of the rows at
most, with 99 % confidence. Exact percentiles are in rank.py.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The accuracy of sketches unless said otherwise: ranks within 0.13 %.
K = 4096


def rank_error(k: int = K) -> float:
    """The share of rows by which a percentile's rank may be off (one side, 99 % confidence)."""
    return 2.296 / k**0.9021


def sketched(values: DataFrame, keys: Sequence[str], value: str = "v", k: int = K) -> DataFrame:
    """A sketch of a bigint column for each key: keys, rows, sketch. Null values are left out; a key
    without others has no row. Merged on the map side: a key with a third of all rows is one sketch
    for each task."""
    known = values.filter(F.col(value).isNotNull())
    return known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_bigint(value, F.lit(k)).alias("sketch")
    )


def merged(sketches: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """Sketches of finer keys merged to coarser ones: keys, rows, sketch."""
    return sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch")
    )


def percentiles(sketches: DataFrame, percents: Sequence[int]) -> DataFrame:
    """The sketches' other columns, and p50, ...: the value of rank ceil(rows * percent / 100)."""
    others = [name for name in sketches.columns if name != "sketch"]
    return sketches.select(*others, *[_quantile(percent).alias(f"p{percent}") for percent in percents])


def _quantile(percent: int) -> Column:
    return F.kll_sketch_get_quantile_bigint("sketch", F.lit(percent / 100))
