"""CSV with line breaks inside quoted cells, read by many tasks a file.

Where a record ends cannot be seen inside one split: a line break ends it only after an even number
of quotes since the file's beginning. So quotes are counted by split, summed over the splits before
(one row a split), and every line then knows whether it starts inside a cell. Lines that are whole
records go on as they are; the others are put together, by record, and all records are parsed by
Spark's own CSV parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.workspace import Workspace

QUOTE = '"'


class QuoteError(RuntimeError):
    """A file whose quotes do not balance."""


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split, id (rising within a split), line, quotes: the physical lines of all files."""
    line = F.col("value")
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("id"),
            line.alias("line"),
            (F.length(line) - F.length(F.replace(line, F.lit(QUOTE), F.lit("")))).alias("quotes"),
        )
    )


def _earlier(value: Column) -> Column:
    """The sum over a file's earlier splits."""
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0))


def _blank(line: Column) -> Column:
    return line.isin("", "\r")


def records(spark: SparkSession, path: str, workspace: Workspace) -> DataFrame:
    """file, number (from 1), record: the whole records of all files, blank lines left out.

    Quotes stand in quoted cells only, doubled inside them; a file where they do not balance is
    refused. A record is one row, however many splits it spans. Writes what it finds of splits, and
    the lines of those with a break inside a cell, to the workspace when called.
    """
    lines = _lines(spark, path)
    splits = lines.groupBy("file", "split").agg(
        F.sum("quotes").alias("quotes"),
        F.count_if(F.col("quotes") % 2 == 1).alias("odd"),
        F.count_if(_blank(F.col("line"))).alias("blank"),
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("first"),
    )
    splits = workspace.store(splits.withColumn("inside", (_earlier(F.col("quotes")) % 2).cast("int")), "splits")
    open_ = splits.groupBy("file").agg((F.sum("quotes") % 2).alias("left")).filter("left = 1").first()
    if open_:
        raise QuoteError(f"the quotes of {open_.file} do not balance")
    # Where no cell holds a line break, lines are records and are numbered by their place.
    plain = F.col("odd") + F.col("inside") + F.col("blank") == 0
    others = F.broadcast(splits.filter(~plain).select("file", "split", "inside"))
    so_far = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("quotes").over(so_far) - F.col("quotes")
    marked = lines.join(others, ["file", "split"]).withColumn("starts", (F.col("inside") + before) % 2 == 0)
    # Outside of cells a blank line is no record.
    marked = marked.filter(~(F.col("starts") & _blank(F.col("line"))))
    marked = marked.withColumn("place", F.sum(F.col("starts").cast("long")).over(so_far)).drop("inside")
    marked = workspace.store(marked, "marked")
    counts = marked.groupBy("file", "split").agg(F.count_if("starts").alias("n"), F.lit(None).cast("long").alias("first"))
    counts = counts.unionByName(splits.filter(plain).select("file", "split", "n", "first"))
    offsets = counts.select("file", "split", "first", _earlier(F.col("n")).alias("offset"))
    offsets = F.broadcast(workspace.store(offsets, "offsets"))
    numbered = marked.join(offsets.drop("first"), ["file", "split"])
    numbered = numbered.withColumn("number", F.col("offset") + F.col("place"))
    whole = F.col("starts") & (F.col("quotes") % 2 == 0)
    single = numbered.filter(whole).select("file", "number", F.col("line").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("split", "id", "line")))
    several = numbered.filter(~whole).groupBy("file", "number").agg(parts.alias("parts"))
    several = several.select("file", "number", F.array_join("parts.line", "\n").alias("record"))
    rest = lines.join(offsets.filter("first IS NOT NULL"), ["file", "split"])
    rest = rest.select("file", (F.col("offset") + F.col("id") - F.col("first") + 1).alias("number"), F.col("line").alias("record"))
    return single.unionByName(several).unionByName(rest)


def read_records(
    spark: SparkSession, path: str, titles: list[str], options: dict[str, str], workspace: Workspace | None = None
) -> DataFrame:
    """file, number and a text column for each title; the first record of a file, its titles, is
    left out, so the numbers begin at 2."""
    workspace = workspace or Workspace(spark)
    columns = ", ".join(f"`{title.replace('`', '``')}` string" for title in titles)
    record = F.regexp_replace("record", "\r$", "")
    found = records(spark, path, workspace).filter("number > 1")
    return found.select("file", "number", F.from_csv(record, columns, options).alias("cells")).select(
        "file", "number", "cells.*"
    )
