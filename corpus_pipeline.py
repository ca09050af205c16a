"""Documents to token ids: language, boilerplate lines, near duplicates, test leaks, encoding.

Each stage takes the rows its predecessor kept, with the columns of `documents`; the last one
returns the encoded corpus. Between stages the rows are written as Parquet and read again, so that
a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, decontaminate, language, lines, ngram_join
from tillroll.llm.common import read
from tillroll.workspace import Workspace


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language the model, trained on docs, rejects: null texts, texts
    without a letter, and those with a calibrated score below the model's least."""
    found = language.predict(docs, language.train(docs), "__language")
    return found.filter("__language.accepted").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts boilerplate lines out of text and sets n_chars anew; keeps every document."""
    return lines.dedup_lines(docs).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    found = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"), "__contamination")
    return found.filter(F.size("__contamination.hits") == 0).select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, and the digest of what they decode to."""
    texts = docs.select("doc_id", "lang", "source", "text")
    decoded = bpe.decode(bpe.encode(texts).drop("text"))
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL has no trained model, no banded join and no byte-pair merges; the tests compare the result
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = workspace.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
