import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import exact
from tillroll.llm.bloom import bit_filter, probed, slots_for
from tillroll.workspace import Workspace


def wanted(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    return sorted(
        (i, min(ids), len(ids), i == min(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for i in ids
    )


def found(docs, **options):
    rows = exact.exact_groups(docs, **options).withColumn("digest", F.lower(F.hex("digest")))
    return sorted(tuple(row) for row in rows.collect())


@pytest.mark.parametrize("slots", [64, 1 << 20])
def test_groups_as_by_hand(spark, odd_texts, slots):
    texts = [*odd_texts, "a  b", "a\n b", "a b ", *["hot"] * 50, *[prose(k, 9) for k in range(60)]]
    assert found(clashing(table(spark, texts)), slots=slots) == wanted(list(enumerate(texts)))


def test_no_rows(spark):
    assert found(table(spark, [])) == []


def test_repeated_and_null_ids(spark):
    docs = table(spark, ["same"] * 4 + ["other"], ids=[None, 7, 7, 9, None])
    rows = [tuple(row)[:4] for row in exact.exact_groups(docs).collect()]
    expected = [
        (None, 7, 4, False), (None, None, 1, True), (7, 7, 4, False), (7, 7, 4, True), (9, 7, 4, False)
    ]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)


def test_unrepeated_texts_are_not_shuffled(spark):
    docs = table(spark, [prose(k, 8) for k in range(300)])
    own = exact.digests(docs)
    repeated = bit_filter(own.select("hash"), Workspace(spark), "filter", least_rows=2)
    marked = probed(own, F.col("hash"), repeated, "suspect")
    assert marked.filter("suspect").count() == 0


def test_filter_misses_no_repeated_hash(spark):
    own = spark.range(2000).select((F.col("id") % 700 * 7919).alias("value"))
    own = own.select(F.xxhash64("value").alias("hash"))
    for slots in (64, 1 << 10, None):
        repeated = bit_filter(own, Workspace(spark), "filter", least_rows=2, slots=slots)
        assert probed(own, F.col("hash"), repeated, "suspect").filter("suspect").count() == 2000


def test_a_filter_holds_its_own_hashes_and_few_others(spark):
    own = spark.range(20_000).select(F.xxhash64("id").alias("hash"))
    others = spark.range(20_000, 60_000).select(F.xxhash64("id").alias("hash"))
    held = bit_filter(own, Workspace(spark), "filter")
    assert held.slots == slots_for(20_000) == 1 << 18 and held.words == 1 << 10
    assert probed(own, F.col("hash"), held, "near").filter("near").count() == 20_000
    share = probed(others, F.col("hash"), held, "near").filter("near").count() / 40_000
    assert share < 0.015
    assert held.chunks.count() == 2 * (held.slots >> 16)


def test_slots_follow_the_rows_up_to_a_bound():
    assert [slots_for(n) for n in (0, 1, 10**4, 10**8, 10**12)] == [1 << 16, 1 << 16, 1 << 17, 1 << 30, 1 << 30]


def test_nothing_to_find(spark):
    none = spark.range(0).select(F.xxhash64("id").alias("hash"))
    held = bit_filter(none, Workspace(spark), "filter")
    assert probed(spark.range(9), F.xxhash64("id"), held, "near").filter("near").isEmpty()
