"""Exact dedup: a two-pass Bloom filter finds possibly repeated texts; only those are shuffled.

Pass one maps each text's hash to one slot of each of two bit tables, counts the rows of every
slot and keeps, as 64-bit words, the bits of slots that two or more rows hit. Pass two probes the
words: a row with both bits set may have an equal elsewhere and goes on to an exact grouping by
SHA-256; every other row is certainly alone and passes straight through.

The words are broadcast. The tables are sized from the counted rows up to a bound (see bloom); over
far more rows than slots the filter only lets more rows through to the exact step, and the result
stays the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bloom import bit_filter, probed
from tillroll.llm.common import text_or_empty
from tillroll.workspace import Workspace

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, " ")


def digests(docs: DataFrame) -> DataFrame:
    """Row number, doc_id and the digest of the normalised text."""
    digest = F.unhex(F.sha2(normalised(text_or_empty()).cast("binary"), 256))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        digest.alias("digest"),
    ).withColumn("hash", F.xxhash64("digest"))


def exact_groups(docs: DataFrame, slots: int | None = None, workspace: Workspace | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when they agree after each run of white space became one space; null is the
    empty text. The row with the smallest doc_id stays (a null doc_id comes last; among rows that
    share it, the first in reading order). Other columns of docs are not read, whatever their
    names. No rows in, no rows out. A text of any length is one digest. `slots` fixes the size of the
    bit tables instead. Writes the digests to the shared folder when called.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    hashed = workspace.store(digests(docs), "digests")
    repeated = bit_filter(hashed.select("hash"), workspace, "filter", least_rows=2, slots=slots)
    marked = probed(hashed, F.col("hash"), repeated, "suspect").drop("hash")
    alone = marked.filter(~F.col("suspect")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "digest",
    )
    suspects = marked.filter("suspect").drop("suspect")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    groups = suspects.groupBy("digest").agg(
        F.min(order).alias("stays"), F.count(F.lit(1)).alias("group_size")
    )
    # Stored, so that both sides of the join are dealt out for it alone and Spark can split the
    # rows of a group that a third of them belong to.
    groups = workspace.store(groups, "groups")
    grouped = suspects.join(groups, "digest").select(
        "doc_id",
        F.col("stays.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"),
        "digest",
    )
    return alone.unionByName(grouped)
