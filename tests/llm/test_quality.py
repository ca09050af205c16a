"""Quality scores: the trees against a plain walk and a plain split search, accuracy on rows that
are held out, odd texts."""

import binascii
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import quality, queries


def junk(seed, n):
    words = prose(seed, n).split()
    own = random.Random(seed)
    form = seed % 3
    if form == 0:
        return " ".join(w + own.choice(("###", "&&&", "$$$")) for w in words)
    if form == 1:
        return " ".join(w.upper() + "!!" for w in words)
    return " ".join([words[0]] * n)


def held_out(doc_id):
    return binascii.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labelled(spark):
    own = random.Random(4)
    good = [own.random() < 0.8 for _ in range(600)]
    texts = [prose(k, 40 + k % 90) if x else junk(k, 40 + k % 90) for k, x in enumerate(good)]
    labels = [(k, int(x), 0) for k, x in enumerate(good) if k % 2 == 0]
    return table(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), good


def test_held_out_accuracy(spark, labelled):
    docs, labels, good = labelled
    found = quality.predict(docs, quality.train(docs, labels)).select("doc_id", "quality.*").collect()
    assert len(found) == 600
    unseen = [r for r in found if held_out(r.doc_id) or r.doc_id % 2]
    right = sum(r.predicted == good[r.doc_id] for r in unseen)
    assert right / len(unseen) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)


def test_labels_of_held_out_rows_are_not_learned_from(spark, labelled):
    docs, labels, _ = labelled
    flipped = labels.withColumn(
        "quality",
        F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(
            F.col("quality")
        ),
    )
    one, other = quality.train(docs, labels), quality.train(docs, flipped)
    assert (one.value == other.value).all() and (one.threshold == other.threshold).all()


def test_only_the_text_decides_the_score(spark, labelled):
    docs, labels, _ = labelled
    trees = quality.train(docs, labels)
    moved = docs.withColumns({"lang": F.lit("zz"), "source": F.lit("q"), "doc_id": F.col("doc_id") + 5000})
    before = {r.doc_id: r.quality for r in quality.predict(docs, trees).collect()}
    after = {r.doc_id - 5000: r.quality for r in quality.predict(moved, trees).collect()}
    assert before == after


def test_the_flattened_trees_give_what_a_plain_walk_gives():
    random_ = np.random.default_rng(5)
    rows = random_.normal(size=(400, len(quality.FEATURES)))
    labels = ((rows[:, 3] > 0.2) ^ (rows[:, 7] > 0)).astype(float)
    trees = quality.fit(rows, labels)

    def walk(row):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                side = trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right
                node = side[node]
            total += trees.value[node]
        return total

    assert np.allclose(trees.margins(rows), [walk(row) for row in rows])
    assert ((trees.scores(rows) > 0.5) == labels).mean() > 0.97


def test_the_first_split_is_the_best_of_all_splits():
    random_ = np.random.default_rng(6)
    rows = random_.integers(0, 12, (300, len(quality.FEATURES))).astype(float)
    labels = ((rows[:, 5] > 6) | (random_.random(300) < 0.1)).astype(float)
    trees = quality.fit(rows, labels)
    share = np.full(300, (labels.sum() + 0.5) / 301)
    slope, curve = share - labels, share * (1 - share)

    def part(where):
        return slope[where].sum() ** 2 / (curve[where].sum() + quality.RIDGE)

    gains = {
        (k, cut): part(rows[:, k] <= cut) + part(rows[:, k] > cut)
        for k in range(rows.shape[1])
        for cut in range(11)
        if min(curve[rows[:, k] <= cut].sum(), curve[rows[:, k] > cut].sum()) >= quality.LEAST_WEIGHT
    }
    root = trees.roots[0]
    assert gains[trees.feature[root], int(trees.threshold[root])] == pytest.approx(max(gains.values()))


def test_statistics_of_pieces_are_those_of_the_whole(monkeypatch):
    text = prose(9, 3000)
    whole = quality.statistics(text)
    monkeypatch.setattr(quality, "PIECE", 50)
    assert quality.statistics(text) == whole


def test_odd_texts_and_labels(spark, odd_texts):
    docs = table(spark, odd_texts)
    labels = spark.createDataFrame(
        [(0, 0, 0), (5, 1, 0), (5, None, 1), (6, 1, 0), (6, 1, 0), (None, 1, 0), (7, 0, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    found = quality.predict(clashing(docs), quality.train(clashing(docs), labels))
    assert "name" in found.columns
    scores = [r.quality.score for r in found.orderBy("doc_id").collect()]
    assert len(scores) == len(odd_texts) and all(0 <= x <= 1 for x in scores)
    assert scores[0] == scores[1] == scores[4] and scores[5] == scores[6]


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = table(spark, ["some text", None])
    trees = quality.train(docs, none)
    assert [r.quality.score for r in quality.predict(docs, trees).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    trees = quality.train(table(spark, ["a", "b", "c", "d"]), one)
    assert len(trees.roots) == 0 and trees.base > 0


def test_a_repeated_doc_id_counts_once(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 9)], "doc_id long, quality int, toxic int")
    ids = [k for k in range(1, 9) for _ in range(5)]
    texts = [prose(k, 20) if k % 2 else junk(k, 20) for k in range(1, 9) for _ in range(5)]
    one = quality.train(table(spark, texts[::5], ids=ids[::5]), labels)
    many = quality.train(table(spark, texts, ids=ids), labels)
    assert one.base == many.base


def test_the_sample_is_bounded(spark, labelled):
    docs, labels, _ = labelled
    trees = quality.train(docs, labels, sample=60)
    found = quality.predict(docs, trees)
    assert found.count() == 600


def test_query_has_the_contract_columns(spark, tmp_path, labelled):
    docs, labels, _ = labelled
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.QUERIES["op13_quality"](spark, str(tmp_path))
    assert dict(found.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    assert all(r.held_out == held_out(r.doc_id) for r in found.collect())
