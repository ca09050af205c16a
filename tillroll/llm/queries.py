"""The operators as queries over a folder of tables, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    align, bpe, decontaminate, exact, language, licenses, lines, ngram_join, oracles, quality, secrets, sentences,
    suffix, trie,
)
from tillroll.llm.common import read, text_or_empty

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return register


def sha256(column) -> F.Column:
    return F.sha2(column.cast("binary"), 256)


@query(oracles.SUFFIX_DEDUP)
def op1_suffix_dedup(spark, folder):
    found = suffix.dedup_substrings(read(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(oracles.DECONTAMINATE)
def op2_decontaminate(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, read(spark, folder, "benchmark"))
    result = F.col("contamination")
    return found.select(
        "doc_id",
        result["n_words"].alias("n_words"),
        decontaminate.hit_words(result).alias("n_hit"),
        F.size(result["items"]).cast("long").alias("n_items"),
        sha256(F.array_join(result["items"], ",")).alias("items_sha256"),
        (F.size(result["hits"]) > 0).alias("contaminated"),
    )


@query(f"""
WITH trimmed AS (
    SELECT doc_id, source, pos, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line, raw
    FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
          FROM documents)
), wide AS (
    SELECT line, min(struct_pack(doc_id := doc_id, pos := pos)) AS first_place
    FROM trimmed WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {lines.MIN_SITES}
), marked AS (
    SELECT t.*, w.line IS NOT NULL AND w.first_place <> struct_pack(doc_id := t.doc_id, pos := t.pos) AS gone
    FROM trimmed t LEFT JOIN wide w USING (line)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op3_line_dedup(spark, folder):
    kept = lines.dedup_lines(read(spark, folder, "documents"))
    return kept.select(
        "doc_id",
        F.col("dedup_lines").alias("n_lines"),
        F.col("dedup_removed").alias("n_removed"),
        sha256(text_or_empty()).alias("kept_sha256"),
    )


@query("""
WITH normal AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), groups AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM normal JOIN groups USING (text_sha256)
""")
def op4_exact_dedup(spark, folder):
    groups = exact.exact_groups(read(spark, folder, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query()
def op5_sentence_spans(spark, folder):
    found = sentences.dedup_spans(read(spark, folder, "documents"))
    ranges = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return found.select(
        "doc_id",
        "n_sentences",
        "n_removed",
        F.array_join(ranges, ",").alias("spans"),
        sha256(F.col("kept")).alias("kept_sha256"),
    )


@query()
def op6_license_scan(spark, folder):
    found = licenses.licenses(read(spark, folder, "documents").select("doc_id", "text"))
    own = F.col("licenses")
    best = F.reduce(
        own,
        F.lit(0.0),
        lambda most, x: F.greatest(most, x["coverage"]),
    )
    names = F.array_sort(F.array_distinct(F.transform(own, lambda x: x["license"])))
    spans = F.transform(
        own, lambda x: F.concat_ws(":", x["license"], x["first"], x["stop"])
    )
    return found.select(
        "doc_id",
        F.size(own).cast("long").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        best.alias("best_coverage"),
        F.array_join(spans, ",").alias("spans"),
    )


@query()
def op7_secret_scan(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = secrets.secrets(docs, novelty_out="novelties")
    spans = F.col("secrets")
    return found.select(
        "doc_id",
        *[F.size(secrets.of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        sha256(secrets.as_text(secrets.of_kind(spans, "assign", "access", "hex"))).alias("base_sha256"),
        secrets.as_text(spans).alias("spans"),
        F.size(secrets.of_kind(spans, "novel")).cast("long").alias("n_novel"),
        F.size(F.filter("novelties", lambda x: x >= secrets.LEAST_NOVELTY)).cast("long").alias("n_incompressible"),
    )


@query()
def op8_language_id(spark, folder):
    docs = read(spark, folder, "documents")
    model = language.train(docs)
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", language.in_fold(F.col("doc_id")).alias("held_out"), "language.*"
    )


@query(oracles.NGRAM_JOIN)
def op9_ngram_join(spark, folder):
    found = ngram_join.jaccard_classes(read(spark, folder, "documents"))
    return found.drop("key")


@query()
def op10_byte_bpe(spark, folder):
    encoded = bpe.encode(read(spark, folder, "documents").select("doc_id", "text"))
    decoded = bpe.decode(encoded.drop("text"))
    ids = F.col("token_ids")
    return decoded.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        sha256(F.array_join(ids.cast("array<string>"), " ")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op11_token_alignment(spark, folder):
    docs = read(spark, folder, "documents")
    return align.align_documents(
        docs, keep=lambda groups: F.when(groups == "", "").otherwise(sha256(groups))
    ).withColumnRenamed("groups", "groups_sha256")


@query(oracles.PREFIX_TRIE)
def op12_prefix_trie(spark, folder):
    return trie.conversation_trie(read(spark, folder, "conversations"))


@query()
def op13_quality(spark, folder):
    docs = read(spark, folder, "documents")
    trees = quality.train(docs, read(spark, folder, "labels"))
    found = quality.predict(docs.select("doc_id", "text"), trees)
    return found.select("doc_id", language.in_fold(F.col("doc_id")).alias("held_out"), "quality.*")
