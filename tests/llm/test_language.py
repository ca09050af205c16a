import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import clashing, table
from tillroll.llm import language

SOUNDS = {
    "aa": "ta ka ra no mi su shi to".split(),
    "bb": "sch ung ein ver ich ach keit ö".split(),
    "cc": "eau ou ez tion é ç ment que".split(),
}


def say(lang, seed, n=60):
    own = random.Random(f"{lang}{seed}")
    return " ".join("".join(own.choices(SOUNDS[lang], k=own.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    langs = [list(SOUNDS)[k % 3] for k in range(600)]
    return table(spark, [say(x, k) for k, x in enumerate(langs)], langs=langs)


@pytest.fixture(scope="module")
def model(docs):
    return language.train(docs)


def test_held_out_documents_are_told_apart(docs, model):
    found = language.predict(clashing(docs), model).filter(language.in_fold(F.col("doc_id")))
    rows = found.select("lang", "language.*").collect()
    assert 80 < len(rows) < 160
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_the_fold_is_crc32_modulo_5(spark):
    rows = spark.range(200).select("id", language.in_fold(F.col("id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_training_looks_at_no_held_out_row(spark, docs, model):
    """Held-out rows with false labels change nothing."""
    lied = docs.withColumn("lang", F.when(language.in_fold(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert (language.train(lied).scores == model.scores).all()


def test_prediction_looks_at_the_text_only(spark, docs, model):
    other = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("x"), "doc_id": -F.col("doc_id")})
    own = [r.language for r in language.predict(docs, model).orderBy("doc_id").collect()]
    assert own == [r.language for r in language.predict(other, model).orderBy(-F.col("doc_id")).collect()]


def test_odd_texts(spark, odd_texts, model):
    rows = language.predict(table(spark, odd_texts), model).orderBy("doc_id").collect()
    for row, text in zip(rows, odd_texts, strict=True):
        letters = any(c.isalpha() for c in text or "")
        assert (row.language.lang_pred == language.UNKNOWN) == (not letters)
        if not letters:
            assert row.language.score == 0 and not row.language.accepted
    assert language.predict(table(spark, []), model).collect() == []


def test_a_foreign_text_is_rejected(model):
    names, score = model.predict(["日本語のテキストです。これは学習にありません。" * 5, say("aa", 1)])
    assert score[0] < 0.8 < score[1] and names[1] == "aa"


def test_chunks_change_nothing(model, monkeypatch):
    texts = [say("bb", 1, 900), say("cc", 2, 30), None, "", say("aa", 3, 500).upper()]
    names, score = model.predict(texts)
    monkeypatch.setattr(language, "CHUNK_BYTES", 100)
    again, other = model.predict(texts)
    assert names == again and abs(score - other).max() < 1e-6


def test_no_labelled_rows(spark):
    none = table(spark, ["some text", "more"], langs=[None, None])
    found = language.predict(none, language.train(none)).collect()
    assert [r.language.accepted for r in found] == [False, False]
