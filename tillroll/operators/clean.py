"""Raw text lines to typed, classified lines, and the customer dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import clock, money
from tillroll.functions.predicates import line_kind
from tillroll.params import Batches
from tillroll.schemas import LINE_KEY
from tillroll.workspace import Workspace


def typed(raw: DataFrame) -> DataFrame:
    """Strict types. A cell that does not parse fails the job (ANSI casts)."""
    return raw.select(
        *LINE_KEY,
        "invoice",
        F.trim("stock_code").alias("stock_code"),
        "description",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("invoice_date").cast("timestamp_ntz").alias("ts_local"),
        F.col("unit_price").cast(money.PRICE).alias("unit_price"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "country",
    )


def overlap_start(raw: DataFrame, batches: Batches) -> Column:
    """First day of the newer batch, or a far date when that batch is absent.

    A scalar subquery that reads two columns; its value reaches the plan as a literal.
    """
    first = (
        raw.filter(F.col("sheet") == batches.newer)
        .select(F.col("invoice_date").cast("timestamp_ntz").alias("ts"))
        .agg(clock.start_of_day(F.min("ts")).alias("day"))
    )
    return F.coalesce(first.scalar(), clock.moment(clock.FAR_FUTURE))


def is_overlap(batches: Batches, ts_local: Column, start: Column) -> Column:
    """A line without a date is no copy: it stays, and the row rules find it."""
    copied = (F.col("sheet") == batches.older) & (ts_local >= start)
    return F.coalesce(copied, F.lit(False))


def overlap_start_value(raw: DataFrame, batches: Batches) -> Column:
    """The same as a literal, for plans that use it several times: one scan, one value."""
    day = raw.sparkSession.range(1).select(
        overlap_start(raw, batches).cast("string").alias("day")
    )
    return F.lit(day.first().day).cast("timestamp_ntz")


def kept_raw(raw: DataFrame, batches: Batches, start: Column | None = None) -> DataFrame:
    """Raw lines without the older batch's copy of the overlap. Repeats inside a batch stay."""
    start = overlap_start(raw, batches) if start is None else start
    ts_local = F.col("invoice_date").cast("timestamp_ntz")
    return raw.filter(~is_overlap(batches, ts_local, start))


def _listed(codes: DataFrame, code: str, mark: str) -> DataFrame:
    listed = codes.select(F.col("code").alias(code), F.lit(True).alias(mark)).distinct()
    return Workspace(codes.sparkSession).store_small(listed, "listed_codes")


def clean(
    raw: DataFrame, codes: DataFrame, batches: Batches, start: Column | None = None
) -> DataFrame:
    """Typed lines without the overlap, with kind, value and the product flag.

    `start` is the overlap's first day when it is known already. `codes` lists the codes that are
    not goods; the list is stored and counted when this is called, and sent to the lines while it is
    short. Its size on disk alone would have all lines shuffled by code.
    """
    start = overlap_start(raw, batches) if start is None else start
    lines = typed(raw).filter(~is_overlap(batches, F.col("ts_local"), start))
    listed = _listed(codes, "stock_code", "listed")
    value = (F.col("quantity") * F.col("unit_price")).cast(money.LINE_VALUE)
    return lines.join(listed, "stock_code", "left").select(
        *LINE_KEY,
        "invoice",
        line_kind(F.col("invoice"), F.col("quantity"), F.col("unit_price")).alias("kind"),
        "stock_code",
        "description",
        "quantity",
        "ts_local",
        clock.to_utc(F.col("ts_local")).alias("ts_utc"),
        "unit_price",
        value.alias("value"),
        "customer_id",
        "country",
        F.col("listed").isNull().alias("is_product"),
    )


def customer_dim(lines: DataFrame) -> DataFrame:
    """Each customer's most frequent country (ties: first in alphabet) and number of countries.

    Counted per customer and country first, so a customer with very many lines is merged on
    the map side and the second step sees at most one row per country.
    """
    per_country = (
        lines.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "country")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("country")))
    return per_country.groupBy("customer_id").agg(
        best.getField("country").alias("country"),
        F.count("country").cast("int").alias("n_countries"),
    )


def lineage(
    raw: DataFrame, codes: DataFrame, batches: Batches, start: Column | None = None
) -> DataFrame:
    """Raw text beside what its clean line became, worked out in one pass over the text."""
    quantity, price = F.col("quantity").cast("int"), F.col("unit_price").cast(money.PRICE)
    listed = _listed(codes, "__code", "__listed")
    kept = kept_raw(raw, batches, start)
    return kept.join(listed, F.trim("stock_code") == F.col("__code"), "left").select(
        *raw.columns,
        line_kind(F.col("invoice"), quantity, price).alias("kind"),
        (quantity * price).cast(money.LINE_VALUE).alias("value"),
        F.col("__listed").isNull().alias("is_product"),
    )
