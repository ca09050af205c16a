"""Invoice lines derived from order/line tables (lineitem, orders, part, supplier, nation).

Those tables have no cancellations, text cells or overlapping batches; the rules below make
them from the columns there are. One source of raw lines among others, see `ingest`.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import clock, money
from tillroll.params import Batches, Formats, Parameters
from tillroll.workspace import row_parts

OLDER, NEWER = "batch 1995-1998", "batch 1998-2001"

# The newer batch's first day and the end of the older one.
NEWER_FROM = datetime(1998, 12, 1)
OLDER_UNTIL = datetime(1998, 12, 10)

PARAMETERS = Parameters(
    end=date(2001, 8, 2),
    cutoff=date(2001, 2, 2),
    robustness_cutoff=date(2000, 8, 2),
    wholesale_units=120,
    batches=Batches(OLDER, NEWER),
    # Keys outgrow the fixed widths of the default formats as the tables grow.
    formats=Formats(
        invoice=r"[CA]?[0-9]{6,}",
        customer_id=r"[0-9]{5,}",
        product_code=r"[0-9]{5,}",
        # Fixed value: the rules add 10000 to a key from 0 on.
        customer_id_range=(10_000, 10**12),
    ),
)


# The columns used. Given here, so that opening a table starts no job to look at its files.
_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_discount double, l_tax double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _padded(number: Column, width: int) -> Column:
    """Zero-padded to `width`, longer numbers in full."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes that are not goods: parts of size 1."""
    parts = _table(spark, folder, "part").filter(F.col("p_size") == 1)
    return parts.select(
        _padded(F.col("p_partkey"), 5).alias("code"),
        F.lit("freight").alias("kind"),
        F.lit("part of size 1").alias("reason"),
    )


def _hundredths(rate: Column) -> Column:
    """A rate with two decimals, held as a double, in whole hundredths."""
    return (rate * 100 + F.lit(0.5)).cast("int")


def _cancels() -> Column:
    return (F.col("l_returnflag") == "R") & (_hundredths(F.col("l_discount")) >= 8)


def _keeps_sign() -> Column:
    return (F.col("l_linenumber") == 7) & (_hundredths(F.col("l_tax")) >= 8)


def known_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Invoices that the rules make anomalous on purpose: cancellations with a positive line."""
    lines = _table(spark, folder, "lineitem").filter(_cancels() & _keeps_sign())
    return lines.select(F.concat(F.lit("C"), _padded(F.col("l_orderkey"), 6)).alias("invoice"))


def _order_time() -> Column:
    hours = (F.lit(6) + F.col("o_orderkey") % 15).cast("int")
    return F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours)


def overlap_days(spark: SparkSession, folder: str) -> tuple[Column, Column]:
    """First day of the overlap and the older batch's last moment in it, from orders alone.

    Every line between the two is in both batches, so orders without lines change nothing.
    """
    at = _order_time()
    newer = at >= clock.moment(NEWER_FROM)
    shared = newer & (at < clock.moment(OLDER_UNTIL))
    ends = _table(spark, folder, "orders").agg(
        clock.start_of_day(F.min(F.when(newer, at))).alias("start"),
        F.max(F.when(shared, at)).alias("until"),
    )
    start = F.coalesce(ends.select("start").scalar(), clock.moment(clock.FAR_FUTURE))
    return start, ends.select("until").scalar()


def raw_lines(spark: SparkSession, folder: str, days: tuple[Column, Column] | None = None) -> DataFrame:
    """All lines as text, with batch, file and row; with `days`, those between two moments.

    What depends on the order alone (date, customer, batches) is worked out per order, before
    the join with its lines. Suppliers are grouped by their key, so that Spark knows that the
    join adds no rows and leaves it out of plans that do not use the country.
    """
    discount, tax = _hundredths(F.col("l_discount")), _hundredths(F.col("l_tax"))
    flag = F.col("l_returnflag")
    cancels = _cancels()
    adjusts = (flag == "A") & (discount >= 10) & (tax >= 8)
    keeps_sign = _keeps_sign()
    free = (flag == "N") & (tax == 0) & (discount == 0)
    prefix = F.when(cancels, F.lit("C")).when(adjusts, F.lit("A")).otherwise(F.lit(""))
    quantity = F.col("l_quantity").cast("int")

    table = _table(spark, folder, "lineitem")
    # Text is made after the joins, so that they move numbers. The count is in the files' footers;
    # lines are dealt out by the key of the join that follows, which needs it in any case.
    lines = table.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.row_index").alias("source_row"),
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        prefix.alias("prefix"),
        (F.col("l_linenumber") == 1).alias("first"),
        F.when(cancels & ~keeps_sign, -quantity).otherwise(quantity).alias("quantity"),
        free.alias("free"),
    ).repartition(row_parts(spark, table.count()), "l_orderkey")
    orders = _table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey") + 10000)
        .cast("string")
        .alias("customer_id"),
        _order_time().alias("at"),
    )
    if days:
        orders = orders.filter(F.col("at").between(*days))
    in_older = F.col("at") < clock.moment(OLDER_UNTIL)
    in_newer = F.col("at") >= clock.moment(NEWER_FROM)
    sheets = (
        F.when(in_older & in_newer, F.array(F.lit(OLDER), F.lit(NEWER)))
        .when(in_older, F.array(F.lit(OLDER)))
        .otherwise(F.array(F.lit(NEWER)))
    )
    orders = orders.select(
        "l_orderkey",
        "customer_id",
        F.col("at").cast("string").alias("invoice_date"),
        F.explode(sheets).alias("sheet"),
    )
    parts = _table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("description"),
        F.col("p_retailprice").cast(money.PRICE).cast("string").alias("price"),
    )
    # Hashed, as neither side is sorted: a partition has few orders, whatever the tables' size.
    joined = lines.join(orders.hint("shuffle_hash"), "l_orderkey").join(parts, "l_partkey", "left")
    # 25 nations; suppliers grow with the data and get no hint.
    nations = _table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("country")
    )
    nations = nations.groupBy("s_nationkey").agg(F.min("country").alias("country"))
    homes = _table(spark, folder, "supplier").groupBy(F.col("s_suppkey").alias("l_suppkey"))
    homes = homes.agg(F.min("s_nationkey").alias("s_nationkey"))
    joined = joined.join(homes, "l_suppkey", "left").join(
        F.broadcast(nations), "s_nationkey", "left"
    )
    return joined.select(
        "sheet",
        "source_file",
        "source_row",
        F.concat("prefix", _padded(F.col("l_orderkey"), 6)).alias("invoice"),
        F.concat(
            _padded(F.col("l_partkey"), 5),
            F.when(F.col("first"), F.lit(" ")).otherwise(F.lit("")),
        ).alias("stock_code"),
        "description",
        F.col("quantity").cast("string").alias("quantity"),
        "invoice_date",
        F.when(F.col("free"), F.lit("0.000")).otherwise(F.col("price")).alias("unit_price"),
        "customer_id",
        "country",
    )
