"""Line dedup: lines spread over many sites are boilerplate; all but their first place go.

A HyperLogLog sketch of the sites is built per line hash and merged by aggregation, so a line that
a third of all documents hold is one small row per task. Lines whose estimate is far from the
threshold are decided by it; lines near it get an exact count of distinct sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bloom import bit_filter, probed
from tillroll.llm.common import own_names, quoted, text_key, text_or_empty, without_positions
from tillroll.workspace import Workspace

#: Distinct sites from which on a line is boilerplate.
MIN_SITES = 10
#: Base-2 logarithm of a sketch's registers: a relative standard error of 3 %.
REGISTERS_LOG2 = 10
#: Estimates within this share of the threshold are counted exactly (over seven standard errors).
MARGIN = 0.25

BREAK = "\n"
BLANK = " \t\u000b\f\r"

_LINE = ["hash", "check"]


def occurrences(docs: DataFrame) -> DataFrame:
    """A row per line that is not blank: two hashes of the trimmed line, its place, its site."""
    lines = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("key"),
        F.col("source").cast("string").alias("site"),
        F.posexplode(F.split(text_or_empty(), BREAK)).alias("pos", "raw"),
    ).withColumn("line", F.btrim("raw", F.lit(BLANK)))
    return lines.filter(F.length("line") > 0).select(
        F.xxhash64("line").alias("hash"), F.hash("line").alias("check"), "doc_id", "key", "pos", "site"
    )


def boilerplate(occurrences_: DataFrame, workspace: Workspace, min_sites: int = MIN_SITES) -> DataFrame:
    """The hashes of lines on min_sites distinct sites or more, with the line's first place."""
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key", "pos")
    sketched = occurrences_.groupBy(*_LINE).agg(
        F.hll_sketch_agg("site", F.lit(REGISTERS_LOG2)).alias("sites"), F.min(place).alias("first")
    )
    estimated = sketched.withColumn("estimate", F.hll_sketch_estimate("sites")).drop("sites")
    spread = workspace.store(
        estimated.filter(F.col("estimate") >= min_sites * (1 - MARGIN)), "spread_lines"
    )
    sure = F.col("estimate") >= min_sites * (1 + MARGIN)
    counted = (
        occurrences_.select(*_LINE, "site")
        .join(spread.filter(~sure).select(*_LINE), _LINE, "left_semi")
        .filter(F.col("site").isNotNull())
        .distinct()
        .groupBy(*_LINE)
        .agg(F.count(F.lit(1)).alias("sites"))
        .filter(F.col("sites") >= min_sites)
    )
    near = spread.filter(~sure).join(counted.select(*_LINE), _LINE, "left_semi")
    return workspace.store(spread.filter(sure).unionByName(near), "boilerplate")


def dedup_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, workspace: Workspace | None = None
) -> DataFrame:
    """docs with text rid of boilerplate, n_chars to match if present, and the columns
    dedup_lines (lines before) and dedup_removed (lines gone).

    Lines end at a line feed and compare trimmed; blank lines are never boilerplate. Of a
    boilerplate line the first place stays: the smallest doc_id (null last), then the first line.
    A null site counts as no site. A null text stays null and has one empty line. A document keeps
    its row even if no line stays. Rows that repeat doc_id and text are treated alike. Columns
    named as the two new ones are replaced; all others pass through. Writes small tables to the shared folder when called.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    doc, of, gone, near_, key = own_names("doc", "of", "gone", "near", "key")
    found = occurrences(docs)
    common = boilerplate(found, workspace, min_sites)
    own = (
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
        & (F.col("key") == F.col("first.key"))
        & (F.col("pos") == F.col("first.pos"))
    )
    removed = (
        found.drop("site")
        .join(common.select(*_LINE, "first"), _LINE)
        .filter(~own)
        .groupBy(F.col("doc_id").alias(doc), F.col("key").alias(of))
        .agg(F.sort_array(F.collect_set("pos")).alias(gone))
    )
    docs = docs.drop("dedup_lines", "dedup_removed")
    removed = workspace.store(removed, "removed_lines")
    changed_docs = removed.select(F.xxhash64(doc, of).alias("hash"))
    marks = bit_filter(changed_docs, workspace, "removed_lines_filter")
    hash_ = F.xxhash64(F.col("doc_id").cast("long"), text_key())
    marked = probed(docs, hash_, marks, near_)
    near = marked.filter(F.col(near_)).withColumn(key, text_key())
    joined = near.hint("merge").join(
        removed,
        F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(of)),
        "left",
    )
    whole = marked.filter(~F.col(near_)).withColumn(gone, F.lit(None).cast("array<int>"))
    names = quoted([*docs.columns, gone])
    joined = whole.select(*names).unionByName(joined.select(*names))
    pieces = F.split("text", BREAK)
    shorter = F.array_join(without_positions(pieces, F.col(gone)), BREAK)
    changed = F.col(gone).isNotNull()
    out = {
        "text": F.when(changed, shorter).otherwise(F.col("text")),
        "dedup_lines": F.size(F.split(text_or_empty(), BREAK)).cast("long"),
        "dedup_removed": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
    }
    result = joined.withColumns(out)
    if "n_chars" in docs.columns:
        result = result.withColumn(
            "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return result.select(*quoted(docs.columns), "dedup_lines", "dedup_removed")
