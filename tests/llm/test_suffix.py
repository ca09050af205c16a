import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import suffix


def brute(texts, length):
    own = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in own for p in range(len(b) - length + 1))
    out = []
    for b in own:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, kept))
    return out


def found(docs, length=suffix.LENGTH, **options):
    rows = suffix.dedup_substrings(docs, length, **options).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows]


def texts_with_passages():
    own, passages = random.Random(8), [prose(900 + k, 40 + 9 * k) for k in range(8)]
    texts = []
    for k in range(40):
        a, b = own.choice(passages), own.choice(passages)
        cut = own.randint(0, 60)
        texts.append(f"{prose(k, 20)}{a[cut:]}{prose(k + 50, 10)}{b[: len(b) - cut]}")
    texts += texts[:3] + ["ab" * 700, "x" * 401, "x" * 400, "abc" * 133 + "d", "abc" * 134]
    return texts


@pytest.mark.parametrize("length", [400, 120])
def test_bytes_as_by_brute_force(spark, odd_texts, length):
    texts = [*odd_texts[:9], *odd_texts[11:], *texts_with_passages()]
    assert found(clashing(table(spark, texts)), length) == brute(texts, length)


def test_names_beyond_a_bucket(spark):
    texts = texts_with_passages()
    assert found(table(spark, texts), 120, bucket=2) == brute(texts, 120)


def test_buckets_by_rows_and_by_columns():
    own = random.Random(9)
    middle = prose(77, 90).encode()
    before, around = [], []
    for k in range(40):
        a, b = own.randint(0, 300), own.randint(0, 300)
        left = prose(k % 9, 40).encode()[-a:] if a else b""
        text = left + middle[: suffix.GRAM] + (middle if k % 3 else prose(k, 90).encode())[:b]
        before.append(len(left))
        around.append(text)
    starts = np.array([168 - n for n in before])
    keep = starts >= 0
    rows = np.zeros((keep.sum(), 368), np.uint8)
    ends = []
    for i, (s, text) in enumerate((s, t) for s, t, k in zip(starts, around, keep, strict=True) if k):
        own_bytes = text[: 368 - s]
        rows[i, s : s + len(own_bytes)] = np.frombuffer(own_bytes, np.uint8)
        ends.append(s + len(own_bytes))
    given = rows, starts[keep], np.array(ends), 200
    one, other = suffix._by_rows(*given), suffix._by_columns(*given)
    assert (one[0] == other[0]).all() and (one[1] == other[1]).all() and (one[0] >= 0).any()


@pytest.mark.parametrize("passage", [250, 700])
def test_a_passage_that_most_texts_share(spark, passage):
    """One name with very many ranks, in buckets of ten: shorter and longer than a string."""
    shared = prose(5, 400)[:passage]
    texts = [f"{prose(k, 30)}{shared}{prose(k + 200, 30)}" for k in range(60)]
    expected = brute(texts, 400)
    assert found(table(spark, texts), bucket=10) == found(table(spark, texts)) == expected
    assert (sum(row[1] for row in expected) > 0) == (passage >= 400)


def test_random_texts_of_two_letters(spark):
    own = random.Random(5)
    texts = ["".join(own.choices("ab", k=own.randint(0, 300))) for _ in range(30)]
    texts += [t[own.randint(0, 50) :] + own.choice(texts) for t in texts[:20]]
    assert found(table(spark, texts), 64) == brute(texts, 64)


def test_texts_in_chunks(spark, monkeypatch):
    texts = [prose(1, 400), prose(1, 390) + prose(2, 100), prose(3, 900)]
    monkeypatch.setattr(suffix, "CHUNK_BYTES", 500)
    own = [t.encode() for t in texts]
    pieces = [(p.tolist(), n.tolist()) for p, n in suffix.samples(own)]
    monkeypatch.setattr(suffix, "CHUNK_BYTES", 1 << 20)
    assert pieces == [(p.tolist(), n.tolist()) for p, n in suffix.samples(own)]


def test_every_string_holds_a_chosen_place():
    text = (prose(6, 300) + "z" * 900 + "pq" * 500).encode()
    (places, _), = suffix.samples([text])
    own = set(places.tolist())
    for start in range(len(text) - suffix.LENGTH + 1):
        assert any(start <= p <= start + suffix.LENGTH - suffix.GRAM for p in own)
        start += 97


def test_very_long_text_and_no_rows(spark, odd_texts):
    rows = found(table(spark, odd_texts))
    assert rows[9][1] == rows[9][0] and rows[10][1] == rows[9][0]
    assert found(table(spark, [])) == []


def test_repeated_ids(spark):
    text = prose(4, 120)
    docs = table(spark, [text, text, None], ids=[1, 1, None])
    assert sorted(r[:3] for r in found(docs)) == [(0, 0, 0), (len(text), len(text), 1), (len(text), len(text), 1)]
