"""Repeated lines: copies between batches, and repeats inside a batch (which are kept)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions import money
from tillroll.functions.predicates import SALE, line_kind
from tillroll.operators.clean import is_overlap, overlap_start
from tillroll.params import Batches
from tillroll.schemas import RAW_COLUMNS
from tillroll.workspace import Workspace

# Rows per stretch when neighbouring rows are compared.
_STRETCH = 1_000_000

_LINE = ("sheet", *RAW_COLUMNS)


def repeated_rows(frame: DataFrame, columns: tuple[str, ...] = _LINE) -> DataFrame:
    """Rows that may repeat another one's columns: those that share a 96-bit hash of them.

    Only hashes are shuffled to find them; the few rows left are compared in full by callers. The
    shared hashes are stored and counted when this is called: few go to the rows, which then stay
    where they are; rows meet many of them in a shuffle.
    """
    hashes = {"__hash": F.xxhash64(*columns), "__check": F.hash(*columns)}
    hashed = frame.withColumns(hashes)
    shared = hashed.groupBy(*hashes).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = Workspace(frame.sparkSession).store_small(shared.drop("n"), "shared_hashes")
    return hashed.join(shared, list(hashes), "left_semi").drop(*hashes)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """EXCEPT in both directions: the distinct rows of one side that the other lacks, with `side`
    (left or right). Nulls equal nulls; the columns are those of left, by name.

    One grouping of 128-bit hashes, merged on the map side, finds the hashes that one side lacks;
    the rows of those alone are then compared in full. Rows that both sides have, which is nearly
    all of them where tables should agree, are shuffled as hashes only.
    """
    columns = left.columns
    sides = left.select("*", F.lit(1).alias("__side")).unionByName(right.select(*columns, F.lit(2).alias("__side")))
    hashes = {"__hash": F.xxhash64(*columns), "__check": F.xxhash64(F.lit(1), *columns)}
    hashed = sides.withColumns(hashes)
    single = hashed.groupBy(*hashes).agg(F.bit_or("__side").alias("__sides")).filter("__sides < 3")
    alone = hashed.join(single.drop("__sides"), list(hashes), "left_semi")
    rows = alone.groupBy(*columns).agg(F.bit_or("__side").alias("__sides"))
    return rows.select(*columns, F.when(F.col("__sides") == 1, "left").otherwise("right").alias("side"))


def overlap_difference(
    raw: DataFrame, batches: Batches, start: Column | None = None, until: Column | None = None
) -> DataFrame:
    """Lines of the overlap found in one batch only, as a count (0 = identical, copies counted).

    EXCEPT ALL in both directions as one grouped count: older lines add 1, newer ones take 1
    away, and what does not cancel out is different. Copies merge on the map side.
    """
    ts = F.col("invoice_date").cast("timestamp_ntz")
    start = overlap_start(raw, batches) if start is None else start
    older = is_overlap(batches, ts, start)
    if until is None:
        until = raw.filter(older).agg(F.max(ts).alias("until")).scalar()
    newer = (F.col("sheet") == batches.newer) & (ts <= until)
    side = F.when(older, F.lit(1)).when(newer, F.lit(-1))
    balance = (
        raw.select(*RAW_COLUMNS, side.alias("side"))
        .filter(F.col("side").isNotNull())
        .groupBy(*RAW_COLUMNS)
        .agg(F.sum("side").alias("balance"))
    )
    return balance.agg(F.coalesce(F.sum(F.abs("balance")), F.lit(0)).alias("different_lines"))


def cleaning_report(
    raw: DataFrame, batches: Batches, start: Column | None = None, repeated: DataFrame | None = None
) -> DataFrame:
    """Raw lines, overlap removed, repeats kept and the sales value of those repeats. `repeated`:
    the repeated_rows of the kept lines, where the caller has them already."""
    ts = F.col("invoice_date").cast("timestamp_ntz")
    start = overlap_start(raw, batches) if start is None else start
    older = is_overlap(batches, ts, start)
    quantity, price = F.col("quantity").cast("int"), F.col("unit_price").cast(money.PRICE)
    totals = raw.agg(F.count(F.lit(1)).alias("lines"), F.count_if(older).alias("copied"))
    totals = totals.select(F.struct("lines", "copied")).scalar()
    # The repeats of a line are its count minus one. Numbering them would put all copies of a
    # line into one task; counting merges them on the map side.
    repeated = repeated_rows(raw.filter(~older)) if repeated is None else repeated
    groups = repeated.groupBy(*_LINE).agg(F.count(F.lit(1)).alias("n"))
    groups = groups.select(
        (F.col("n") - 1).alias("repeats"),
        line_kind(F.col("invoice"), quantity, price).alias("kind"),
        (quantity * price).cast(money.LINE_VALUE).alias("value"),
    )
    sold = F.when(F.col("kind") == SALE, F.col("value") * F.col("repeats"))
    return groups.agg(
        F.coalesce(F.sum("repeats"), F.lit(0)).alias("repeats_kept"),
        money.total_or_zero(F.sum(sold)).alias("value_of_repeats"),
    ).select(
        totals.getField("lines").alias("raw_lines"),
        totals.getField("copied").alias("overlap_lines"),
        "repeats_kept",
        "value_of_repeats",
    )


def adjacent_repeats(kept: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Repeats that directly follow their copy in the source, as a count. `repeated`: the
    repeated_rows of these lines, where the caller has them already.

    Only lines that have an equal one are looked at. Neighbours are compared inside stretches of
    a million rows; a stretch's last row is also the first of the next one, so no pair is missed
    and no task holds a whole file.
    """
    kept = repeated_rows(kept) if repeated is None else repeated
    row = F.col("source_row")
    stretch = F.call_function("div", row, F.lit(_STRETCH))
    is_last = row % _STRETCH == _STRETCH - 1
    stretches = F.when(is_last, F.array(stretch, stretch + 1)).otherwise(F.array(stretch))
    line = F.struct(*RAW_COLUMNS)
    spread = kept.select(
        "sheet", "source_file", "source_row", line.alias("line"), F.explode(stretches).alias("part")
    )
    following = Window.partitionBy("sheet", "source_file", "part").orderBy("source_row")
    same = (F.col("before_row") == row - 1) & F.col("line").eqNullSafe(F.col("before_line"))
    return (
        spread.withColumns(
            {
                "before_row": F.lag("source_row").over(following),
                "before_line": F.lag("line").over(following),
            }
        )
        .agg(F.count_if(same).alias("adjacent_repeats"))
    )


def repeated_pairs(lines: DataFrame) -> DataFrame:
    """Invoice and product pairs found on more than one line, and those whose quantities differ."""
    pairs = lines.groupBy("invoice", "stock_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("quantity").alias("least"),
        F.max("quantity").alias("most"),
    )
    return pairs.agg(
        F.count_if(F.col("n") > 1).alias("repeated_pairs"),
        F.count_if((F.col("n") > 1) & (F.col("least") != F.col("most"))).alias(
            "pairs_with_other_quantity"
        ),
    )
