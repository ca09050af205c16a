"""Loading raw batches: text in, nothing inferred, refused when something is missing."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.commits import CommitLog
from tillroll.params import Batches
from tillroll.schemas import RAW_COLUMNS, SOURCE_TITLES
from tillroll.sources.digests import file_digests
from tillroll.sources.records import read_records

# Title of the column that carries a line's row in its source (row 1 holds the titles).
ROW_TITLE = "Row"
# Title of the column that carries a line's file, where its reader had to note it.
FILE_TITLE = "File path"


class LoadError(RuntimeError):
    """The source does not have the expected form."""


# How cells are written: quotes doubled inside quotes, blanks kept.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """CSV as text: quotes doubled inside quotes, line breaks kept, empty cells NULL, and the
    words NULL or \\N taken literally. Lines are numbered where the file does not do so.

    With line_breaks a break may be inside a cell: files of one split are one task each, larger
    ones are read by a task for each split (see records). Without, splits are read as they are.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).options(**CSV_OPTIONS)
    frame = reader.option("multiLine", line_breaks).csv(path)
    if line_breaks and _largest(spark, path) > _split_bytes(spark):
        return read_csv_in_splits(spark, path, frame.columns)
    return frame if ROW_TITLE in frame.columns else numbered(frame)


def read_csv_in_splits(spark: SparkSession, path: str, titles: list[str]) -> DataFrame:
    """The same rows with many tasks a file. `titles` are those of the files."""
    frame = read_records(spark, path, titles, CSV_OPTIONS)
    row = [] if ROW_TITLE in titles else [F.col("number").alias(ROW_TITLE)]
    return frame.select(*[F.col(f"`{title}`") for title in titles], *row, F.col("file").alias(FILE_TITLE))


def _largest(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file, from the listing alone."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def _split_bytes(spark: SparkSession) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )


def numbered(frame: DataFrame) -> DataFrame:
    """A file's lines numbered as in its source, the titles being line 1.

    Rows are numbered inside each split of a file as they are read; the rows of the splits before
    it, a table of one row for each split, are added.
    """
    file, split = "_metadata.file_path", "_metadata.file_block_start"
    own = frame.select("*", F.col(file).alias("__file"), F.col(split).alias("__split"))
    own = own.withColumn("__id", F.monotonically_increasing_id())
    splits = own.groupBy("__file", "__split").agg(
        F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    earlier = Window.partitionBy("__file").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
    splits = splits.withColumn("__before", before).drop("__rows")
    row = F.col("__id") - F.col("__first") + F.col("__before") + 2
    return own.join(splits, ["__file", "__split"]).select(
        *frame.columns, row.alias(ROW_TITLE), F.col("__file").alias(FILE_TITLE)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with the source's titles; the row is the file's own row number when absent."""
    frame = spark.read.parquet(path)
    if ROW_TITLE in frame.columns:
        return frame
    return frame.withColumn(ROW_TITLE, F.col("_metadata.row_index") + 2)


def as_batch(frame: DataFrame, sheet: str) -> DataFrame:
    """Source titles to column names, every cell text, empty cells NULL."""
    missing = [t for t in (ROW_TITLE, *SOURCE_TITLES.values()) if t not in frame.columns]
    if missing:
        raise LoadError(f"batch {sheet!r} lacks the columns {missing}")

    def cell(name: str):
        return F.nullif(F.col(f"`{SOURCE_TITLES[name]}`").cast("string"), F.lit("")).alias(name)

    return frame.select(
        F.lit(sheet).alias("sheet"),
        F.col(FILE_TITLE if FILE_TITLE in frame.columns else "_metadata.file_path").alias("source_file"),
        F.col(ROW_TITLE).cast("bigint").alias("source_row"),
        *[cell(name) for name in RAW_COLUMNS],
    )


def read_batches(
    spark: SparkSession, paths: Mapping[str, str], batches: Batches, reader=read_csv
) -> DataFrame:
    """All batches as one table. `paths` gives each batch's files; none may be absent."""
    wanted = (batches.older, batches.newer)
    missing = [sheet for sheet in wanted if sheet not in paths]
    if missing:
        raise LoadError(f"batches absent from the source: {missing}")
    frames = [as_batch(reader(spark, paths[sheet]), sheet) for sheet in wanted]
    return reduce(DataFrame.unionByName, frames)


def lines_per_sheet(raw: DataFrame) -> DataFrame:
    return raw.groupBy("sheet").agg(F.count(F.lit(1)).alias("lines"))


def check_digests(spark: SparkSession, expected: Mapping[str, str], root: str) -> None:
    """Refuse the load when a file's digest is not the expected one (path to digest). The files
    that failed are all listed in a table, whose place the error names."""
    wanted = spark.createDataFrame(
        [(_identity(path), digest) for path, digest in expected.items()], "known string, wanted string"
    )
    # A path given without scheme and host means the default ones.
    path = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    bare = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/+", "/")
    found = file_digests(spark, list(expected)).withColumn("known", F.explode(F.array_distinct(F.array(path, bare))))
    matched = found.join(wanted, "known", "left")
    by_file = matched.groupBy("file", "sha256").agg(F.max("wanted").alias("wanted"))
    wrong = by_file.filter(~F.col("sha256").eqNullSafe(F.col("wanted")))
    place = f"{root}/refused/{uuid.uuid4().hex}"
    wrong.write.parquet(place)
    n = spark.read.schema(wrong.schema).parquet(place).count()
    if n:
        raise LoadError(f"checksum mismatch in {n} files, listed in {place}")


def _identity(path: str) -> str:
    """A path as the file system reports it: local ones with an empty host."""
    return re.sub(r"^file:/*", "file:///", path)


def load_entry(raw: DataFrame, digests: DataFrame, load_id: str) -> DataFrame:
    """Registry rows of one load: each file, its digest and the lines written from it."""
    counts = raw.groupBy(F.col("source_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return digests.join(counts, "file", "left").select(
        F.lit(load_id).alias("load_id"),
        "file",
        "name",
        "sha256",
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.current_timestamp().alias("loaded_at"),
    )


def load(
    spark: SparkSession,
    paths: Mapping[str, str],
    root: str,
    batches: Batches,
    reader=read_csv,
    expected: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read, check, write under a new load id, then register. Returns the stored raw lines.

    Readers find the newest load through the commit log, so a load that fails half-way leaves
    the previous one in place, and loading twice gives the same result.
    """
    if expected:
        check_digests(spark, expected, root)
    raw = read_batches(spark, paths, batches, reader)
    return register(raw, file_digests(spark, list(paths.values())), root)


def commits(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/loads")


def register(raw: DataFrame, digests: DataFrame, root: str) -> DataFrame:
    """Write raw lines under a new load id, enter their files, and commit the load; returns the
    stored lines. Loads at the same time are ordered by the numbers of their commits."""
    spark, load_id = raw.sparkSession, uuid.uuid4().hex
    target = f"{root}/raw/{load_id}"
    raw.write.parquet(target)
    stored = spark.read.schema(raw.schema).parquet(target)
    load_entry(raw, digests, load_id).coalesce(1).write.mode("append").parquet(f"{root}/load_log")
    commits(spark, root).commit(load_id)
    return stored


def load_log(spark: SparkSession, root: str) -> DataFrame:
    """Registry rows of the committed loads, with the number of each load's commit."""
    known = commits(spark, root).entries().select(F.col("id").alias("load_id"), "number")
    return spark.read.parquet(f"{root}/load_log").join(known, "load_id")


def current_raw(spark: SparkSession, root: str) -> DataFrame:
    """Raw lines of the newest load."""
    newest = commits(spark, root).newest()
    if newest is None:
        raise LookupError(f"nothing is loaded below {root}")
    return spark.read.parquet(f"{root}/raw/{newest.id}")


def remove_unloaded(spark: SparkSession, root: str, older_than_hours: float = 7 * 24) -> list[str]:
    """Removes the raw lines of loads that broke off and wrote nothing for so long."""
    return commits(spark, root).remove_uncommitted(f"{root}/raw", older_than_hours)
