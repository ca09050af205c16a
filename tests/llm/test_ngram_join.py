import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import ngram_join
from tillroll.workspace import Workspace


def gram_set(text, n=5):
    own = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    n = min(n, len(own))
    return frozenset(tuple(own[i : i + n]) for i in range(len(own) - n + 1)) if n else frozenset()


def brute(rows, threshold=0.8):
    """doc_id to (class_id, class_size, n_links, group_id), by comparing all pairs."""
    classes = defaultdict(list)
    for doc_id, text in rows:
        classes[gram_set(text)].append(doc_id)
    links = defaultdict(set)
    for a, b in combinations([c for c in classes if c], 2):
        if len(a & b) >= threshold * len(a | b):
            links[a].add(b)
            links[b].add(a)
    out = {}
    for own, ids in classes.items():
        seen, todo = {own}, [own]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        head = min(min(classes[c]) for c in seen)
        for doc_id in ids:
            out[doc_id] = (min(ids), len(ids), len(links[own]), head if own else doc_id)
    return out


def found(docs, **options):
    rows = ngram_join.jaccard_classes(docs, **options).collect()
    for row in rows:
        if row.class_size and row.group_id is not None:
            assert row.stays == (row.doc_id == row.group_id)
    return {r.doc_id: (r.class_id, r.class_size, r.n_links, r.group_id) for r in rows}


def near_copies(seed, n_words, copies, edits):
    own, base = random.Random(seed), prose(seed, n_words).split()
    out = [" ".join(base)]
    for _ in range(copies):
        words = list(base)
        for _ in range(own.randint(1, edits)):
            words[own.randrange(len(words))] = f"w{own.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus(odd_texts):
    texts = [*odd_texts[:9], *odd_texts[11:], "four words are few", "Four, words ARE few!"]
    for k in range(12):
        texts += near_copies(100 + k, 60 + 20 * k, 5, 5)
    texts += [near_copies(100, 60, 0, 1)[0]] * 7 + [prose(500 + k, 50) for k in range(20)]
    random.Random(3).shuffle(texts)
    return texts


def test_links_as_by_brute_force(spark, odd_texts):
    texts = corpus(odd_texts)
    assert found(clashing(table(spark, texts))) == brute(list(enumerate(texts)))


def test_parts_of_many_blocks(spark, monkeypatch):
    """One group of near copies, cut into blocks; no task holds more than two of them."""
    texts = near_copies(9, 200, 60, 12)
    expected = brute(list(enumerate(texts)))
    assert len({links for _, _, links, _ in expected.values()}) > 5
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 13)
    assert found(table(spark, texts)) == expected


def chain(seed, texts, n_words, step):
    """Texts that each share most of their words with the next ones, and none with those far off."""
    words = [w.strip(".").lower() for w in prose(seed, n_words + step * texts).split()]
    words = [f"{w}{k}" for k, w in enumerate(words)]
    return [" ".join(words[k * step : k * step + n_words]) for k in range(texts)]


def test_a_long_chain_is_verified_by_its_bands(spark, monkeypatch):
    """One connected part, few links each: the groups are buckets, and their work is linear."""
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 20)
    work = {}
    for n in (100, 200):
        texts = chain(11, n, 100, 9)
        expected = brute(list(enumerate(texts)))
        assert {group for *_, group in expected.values()} == {0}
        workspace = Workspace(spark)
        assert found(table(spark, texts), workspace=workspace) == expected
        assert spark.read.parquet(workspace.path("parts_by_band")).count() == 1
        buckets = spark.read.parquet(workspace.path("shared_bands"))
        work[n] = buckets.selectExpr("sum(size * size)").first()[0]
        assert buckets.selectExpr("max(size)").first()[0] < 40
    assert work[200] < 2.5 * work[100] and work[200] < 200**2


def test_near_copies_of_one_text_are_compared_as_a_part(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 13)
    workspace = Workspace(spark)
    texts = near_copies(9, 200, 40, 4)
    assert found(table(spark, texts), workspace=workspace) == brute(list(enumerate(texts)))
    assert spark.read.parquet(workspace.path("parts_by_band")).isEmpty()


def test_hot_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    texts = chain(12, 60, 120, 6) + near_copies(10, 150, 20, 5)
    assert found(table(spark, texts)) == brute(list(enumerate(texts)))


def test_recall_of_the_bands_on_pairs_at_the_threshold(spark, monkeypatch):
    """A part of many blocks, verified by bands alone: the links found, against all of them."""
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 10)
    texts = chain(13, 100, 150, 4)
    expected = brute(list(enumerate(texts)))
    got = found(table(spark, texts))
    all_links = sum(x[2] for x in expected.values())
    assert all_links > 500
    assert sum(x[2] for x in got.values()) / all_links >= 0.99


def test_one_of_each_group_stays(spark, odd_texts):
    texts = corpus(odd_texts)
    docs = clashing(table(spark, texts))
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = brute(list(enumerate(texts)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, x in expected.items() if x[3] == i)


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = prose(4, 30)
    docs = table(spark, [text, text, None, None, text + " more"], ids=[1, 1, None, 5, None])
    kept = ngram_join.one_of_each(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(
        [(1, text), (None, None), (5, None)], key=repr
    )
    assert ngram_join.one_of_each(table(spark, [])).collect() == []


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.99999), (0.5, 0.99), (0.95, 0.999)):
        bands, rows = ngram_join.bands_and_rows(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall
    assert ngram_join.bands_and_rows() == (29, 5)


def test_intersections_by_blocks_of_columns(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    own = np.random.default_rng(2)
    sets = [np.unique(own.integers(0, 60, 30, dtype=np.uint64)) for _ in range(9)]
    other = [np.unique(own.integers(0, 60, 20, dtype=np.uint64)) for _ in range(5)]
    both = ngram_join._intersections(sets, other)
    assert both.tolist() == [[len(np.intersect1d(a, b)) for b in other] for a in sets]
