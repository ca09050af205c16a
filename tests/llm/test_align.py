"""Token alignment against the public libraries over whole texts and a plain cut at common ends."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import align, queries

TEXTS = [
    "one two  three\n\nfour\tfive ",
    " leading space", "  two leading spaces and more", "\nnewline first", " ", "   ", "\n",
    "naïve café 日本語のテキスト 🙂🙂 end", "don't I'll we've IT'S", "x" * 3000, "= " * 50 + "=" * 999,
    "word no-break em  line\u0085next \x1cfile", "a\x00b \x1f c", "<|endoftext|> <s> </s> <unk> <0x41>",
    "ключ 한국어 العربية हिन्दी", "12345 3.14 1,000 $%^&*()", "tab\t\ttabs \r\n crlf\r\n",
    "a ▁ piece mark", "▁", "é é ﻿bom", "a b c d e f g h", "\U0001f468‍\U0001f469‍\U0001f467 family",
]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(align.FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=align.SECOND)


def plain(text, first, second):
    """a ids, b ids of each group; None without tokens."""
    if not text:
        return []
    whole = " " + text
    chars = align._byte_of_character()
    a = first.encode(whole, add_special_tokens=False).ids
    a_bytes = [bytes(chars[c] for c in first.id_to_token(i)) for i in a]
    b = second.encode(text)
    names = [second.id_to_piece(i) for i in b]
    b_bytes = [
        bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names)
    ]
    if b"".join(a_bytes) != whole.encode() or b"".join(b_bytes) != whole.encode():
        return []
    groups, i, j, at_a, at_b = [], 0, 0, 0, 0
    own = ([], [])
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            at_a += len(a_bytes[i])
            own[0].append(a[i])
            i += 1
        else:
            at_b += len(b_bytes[j])
            own[1].append(b[j])
            j += 1
        if at_a == at_b:
            groups.append(own)
            own = ([], [])
    return groups


def rendered(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def brute(texts, libraries):
    """The contract's columns for each text."""
    groups = [plain(t, *libraries) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    docs = Counter(pair for own in links for pair in own)
    most = Counter()
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for g, own in zip(groups, links):
        out.append(
            (
                sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), own.total(),
                sum(n for (a, b), n in own.items() if docs[a, b] == most[a]),
                sum(n * docs[pair] for pair, n in own.items()),
                rendered(g),
            )
        )
    return out


def found(spark, texts, **parameters):
    rows = align.align_documents(table(spark, texts), **parameters).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    return [tuple(r)[1:] for r in rows]


@pytest.mark.parametrize("broadcast_pairs", [1 << 19, 20, 0])
def test_as_by_brute_force(spark, libraries, odd_texts, broadcast_pairs):
    texts = TEXTS + odd_texts[:9] + [prose(k, 60) for k in range(8)] * 2 + [odd_texts[-1], odd_texts[-2]]
    assert found(spark, texts, broadcast_pairs=broadcast_pairs) == brute(texts, libraries)


def test_random_characters(libraries):
    own = random.Random(1)
    kinds = ["  \n\tab", "ab c日本é", "  ▁x", "🙂‍ a'sSt", "　\xa0 a.b", "кот 12"]
    texts = ["".join(own.choices(own.choice(kinds), k=own.randint(1, 40))) for _ in range(1500)]
    got = align.aligned(texts, align.Aligner(_files())).to_pylist()
    for text, row in zip(texts, got, strict=True):
        groups = plain(text, *libraries)
        assert row["groups"] == rendered(groups), repr(text)
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        n = libraries[1].get_piece_size()
        assert {(p // n, p % n): t for p, t in zip(row["pairs"], row["times"], strict=True)} == links


def _files():
    return tuple(open(path, "rb").read() for path in (align.FIRST, align.SECOND))


def test_pieces_of_a_long_text_and_a_full_memory_change_nothing(monkeypatch, odd_texts):
    texts = TEXTS + odd_texts
    want = align.aligned(texts, align.Aligner(_files())).to_pylist()
    monkeypatch.setattr(align, "CHUNK", 300)
    monkeypatch.setattr(align, "REMEMBERED", 50)
    aligner = align.Aligner(_files())
    assert align.aligned(texts, aligner).to_pylist() == want
    assert align.aligned(texts[::-1], aligner).to_pylist() == want[::-1]
    assert len(aligner.known) < 2000


def test_a_tokenizer_that_crosses_spaces_gets_whole_texts(monkeypatch, odd_texts):
    aligner = align.Aligner(_files())
    texts = TEXTS + odd_texts[:9]
    want = align.aligned(texts, aligner).to_pylist()
    aligner.tokenizers.cuts_at_spaces = False
    aligner.forget()
    assert align.aligned(texts, aligner).to_pylist() == want


def test_pointers_reach_the_terminal_of_a_long_chain():
    n = 1000  # tokens of two bytes against the same, moved by one: nothing ends together until the end
    first = np.append(np.arange(2, 2 * n + 1, 2), 2 * n + 1)
    second = np.arange(1, 2 * n + 2, 2)
    assert set(align.terminals(first, second)) == {n}
    ends = np.cumsum(np.ones(50, np.int64))
    assert (align.terminals(ends, ends) == np.tile(np.arange(50), 2)).all()


def test_pairs_by_their_ids(spark, libraries):
    texts = ["some words here", "other words there"]
    rows = align.align(table(spark, texts)).select(F.explode("alignment.pairs").alias("pair"))
    a, b = align.pair_ids(F.col("pair"))
    got = {tuple(r) for r in rows.select(a, b).collect()}
    assert got == {(x, y) for t in texts for g, h in plain(t, *libraries) for x in g for y in h}


def test_clashing_names_repeats_and_empty_tables(spark):
    docs = clashing(table(spark, ["a word", "a word", None], ids=[4, 4, None])).withColumn("pairs", F.lit("own"))
    kept = align.align(docs)
    assert kept.columns == [*docs.columns, "alignment"]
    rows = align.align_documents(docs).collect()
    assert sorted((r.n_a, r.count_sum) for r in rows) == [(0, 0), (2, 4), (2, 4)]
    assert align.align_documents(table(spark, [])).collect() == []


def test_query_has_the_contract_columns(spark, tmp_path, libraries):
    texts = TEXTS + [None, ""]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_token_alignment"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert all(kind == "bigint" for name, kind in got.dtypes if name != "groups_sha256")
    want = [(*x[:6], hashlib.sha256(x[6].encode()).hexdigest() if x[6] else "") for x in brute(texts, libraries)]
    assert [tuple(r)[1:] for r in got.orderBy("doc_id").collect()] == want
