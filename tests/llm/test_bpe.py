import gc

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import bpe, common

RANKS = bpe.load_ranks()
PUBLIC = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(RANKS)


def test_ids_are_those_of_the_public_encoder(spark, odd_texts):
    texts = [*odd_texts, prose(5, 500), "aaaaaaaa" * 400, "<|endoftext|> it's  a\n\n test"]
    encoded = bpe.encode(clashing(table(spark, texts)))
    rows = bpe.decode(encoded).orderBy("doc_id").collect()
    assert [r.token_ids for r in rows] == [PUBLIC.encode_ordinary(x or "") for x in texts]
    assert [bytes(r.decoded) for r in rows] == [(x or "").encode() for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=300))
def test_round_trip(text):
    (ids,) = ENCODER.encode([text])
    assert ids.tolist() == PUBLIC.encode_ordinary(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=255) | st.sampled_from(" \n'\x1c\x1f\x85\xa0st"), max_size=30))
def test_latin_texts_are_cut_alike(text):
    assert [bpe.as_utf8(word).decode() for word in bpe.cut(text)] == bpe._CUT.findall(text)
    assert ENCODER.encode([text])[0].tolist() == PUBLIC.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abct the", min_size=100, max_size=300))
def test_long_words_merge_alike(text):
    word = text.encode()
    parts = bpe._merged_long(word, RANKS)
    assert parts == PUBLIC._encode_single_piece(word) if word not in RANKS else True


def test_no_rows_and_null_ids(spark):
    assert bpe.encode(table(spark, [])).collect() == []
    frame = spark.createDataFrame([(None,), ([],), ([0, 1],)], "token_ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(frame).collect()] == [b"", b"", b'!"']


def test_ids_in_chunks_and_unknown_ids(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_IDS", 3)
    pieces, ids = bpe.Pieces(RANKS), PUBLIC.encode_ordinary(prose(4, 60))
    stops = np.array([0, 0, 1, 3, 3, 4, len(ids), len(ids)])
    data, ends = pieces.joined(np.array(ids, np.int32), stops)
    assert data == PUBLIC.decode_bytes(ids)
    assert ends.tolist() == [len(PUBLIC.decode_bytes(ids[:n])) for n in stops]
    for bad in (-1, len(RANKS), 10**6):
        with pytest.raises(ValueError, match="vocabulary"):
            pieces.joined(np.array([0, bad]), np.array([2]))


def test_few_words_are_remembered(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder, text = bpe.Encoder(RANKS), prose(3, 80)
    for part in (text[:99], text[99:], text):
        assert encoder.encode([part])[0].tolist() == PUBLIC.encode_ordinary(part)
    assert len(encoder.known) <= len(set(bpe._CUT.findall(text)))


def test_a_batch_is_encoded_once_for_encode_and_decode(spark):
    """One batch a row: the worker's count of encoded batches goes up by one with each."""

    @F.arrow_udf("long")
    def count(ids: pa.Array) -> pa.Array:
        return pa.array([bpe._LATEST.made] * len(ids))

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        texts = [prose(k, 9) for k in range(5)]
        encoded = bpe.encode(table(spark, texts).coalesce(1))
        rows = encoded.withColumn("made", count("token_ids")).orderBy("doc_id").collect()
    finally:
        spark.conf.set(key, before)
    assert [r.token_ids for r in rows] == [PUBLIC.encode_ordinary(t) for t in texts]
    assert [r.made - rows[0].made for r in rows] == [0, 1, 2, 3, 4]


def test_the_latest_result_is_neither_held_nor_mistaken():
    latest, given = bpe.Latest(), pa.array(["a"])
    first = latest.of(RANKS, given, lambda: pa.array([1]))
    assert latest.of(RANKS, given, lambda: pa.array([2])) is first
    assert latest.of({}, given, lambda: pa.array([3])).to_pylist() == [3]
    first = latest.of(RANKS, given, lambda: pa.array([4]))
    assert latest.of(RANKS, pa.array(["a"]), lambda: pa.array([5])).to_pylist() == [5]
    texts = pa.array(["a", "b", "c"])
    whole = latest.of(RANKS, texts, lambda: pa.array([6]))
    assert latest.of(RANKS, texts.slice(0), lambda: pa.array([7])) is whole
    part = latest.of(RANKS, texts.slice(1), lambda: pa.array([8]))
    assert part.to_pylist() == [8] and first.to_pylist() == [4]
    del whole, part
    gc.collect()
    assert latest.given is None and latest.result is None


def test_a_worker_keeps_what_one_operator_built(monkeypatch):
    monkeypatch.setattr(common, "_BUILT", {})
    value, other = [1], [2]
    one = common.built("bpe", value, list, "encoder")
    two = common.built("bpe", value, list, "pieces")
    assert common.built("bpe", value, list, "encoder") is one
    assert common.built("bpe", other, list, "encoder") is not one
    assert common.built("bpe", value, list, "pieces") is two
    common.built("language", value, list)
    assert list(common._BUILT) == [("language", "")]
