"""The stages against brute force; the last test runs the registered queries on a small folder."""

from pathlib import Path

import duckdb
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import prose, table
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_language import say
from tests.llm.test_lines import brute as without_lines
from tests.llm.test_ngram_join import brute as near_groups
from tests.llm.test_ngram_join import near_copies
from tillroll.llm import bpe, decontaminate, lines, queries

FOLDER = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("corpus"))
    items = [(k, prose(3000 + k, 25)) for k in range(4)]
    texts, langs = [], []
    for k in range(240):
        lang = ("aa", "bb", "cc")[k % 3]
        own = [say(lang, k, 50)]
        if k % 2:
            own.append("Share this page")
        if k % 40 == 7:
            own.append(say(lang, 7, 8) + " " + items[k % 4][1])
        texts.append("\n".join(own))
        langs.append(lang)
    texts += near_copies(5, 120, 6, 4) + [texts[3]] * 4 + [None, "", "123 ---"]
    langs += ["aa"] * (len(texts) - len(langs))
    docs = table(spark, texts, langs=langs, sources=[f"s{k % 17}" for k in range(len(texts))])
    docs.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def test_stages_as_by_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_duplicates", "decontamination", "byte_bpe"]

    kept = stages["language_id"](spark, docs, folder)
    assert kept.columns == columns
    before = {r.doc_id: r for r in docs.collect()}
    after = {r.doc_id: r for r in kept.collect()}
    gone = [before[i].text for i in set(before) - set(after)]
    assert {None, "", "123 ---"} <= set(gone) and len(gone) <= 12

    rows = [(r.doc_id, r.text, r.source) for r in after.values()]
    shorter = stages["line_dedup"](spark, kept, folder)
    assert shorter.columns == columns
    texts = {r.doc_id: r.text for r in shorter.collect()}
    assert texts == without_lines(rows, lines.MIN_SITES)
    assert any(texts[i] != t for i, t, _ in rows)

    groups = near_groups(list(texts.items()))
    single = stages["near_duplicates"](spark, shorter, folder)
    assert single.columns == columns
    ids = {r.doc_id for r in single.collect()}
    assert ids == {i for i, (_, _, _, head) in groups.items() if head == i}

    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = stages["decontamination"](spark, single, folder)
    assert clean.columns == columns
    left = {r.doc_id for r in clean.collect()}
    assert left == {i for i in ids if not leaks(texts[i], items, decontaminate.WINDOW)[1]}
    assert left < ids

    public = tiktoken.Encoding(
        "own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.load_ranks(), special_tokens={}
    )
    final = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: r.token_ids for r in final} == {i: public.encode_ordinary(texts[i]) for i in left}


def test_no_documents(spark, folder, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, columns in (
        ("labels", "doc_id long, quality int, toxic int"),
        ("conversations", "conv_id long, turn long, role string, text string"),
    ):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).collect() == [], name


@pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")
def test_queries_return_a_row_for_each_document(spark):
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for name, query in queries.QUERIES.items():
        if name == "op12_prefix_trie":  # a row for each node
            continue
        found = query(spark, str(FOLDER))
        assert found.count() == n, name
        assert found.filter(F.col("doc_id").isNull()).isEmpty()


@pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_duckdb(spark, name):
    duck = duckdb.connect()
    for table_ in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table_} AS SELECT * FROM '{FOLDER}/{table_}.parquet'")
    found = queries.QUERIES[name](spark, str(FOLDER))
    wanted = duck.sql(queries.ORACLE[name])
    columns = sorted(found.columns)
    assert sorted(wanted.columns) == columns
    rows = [repr(tuple(row[c] for c in columns)) for row in found.collect()]
    assert sorted(rows) == sorted(map(repr, wanted.select(", ".join(columns)).fetchall()))
