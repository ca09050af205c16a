"""Small tables for the text operators; they share the session of the other tests."""

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

#: Names that operators use for columns of their own, as extra columns of a caller.
CLASHING = (
    "key", "hash", "check", "row", "digest", "near", "name", "rank", "place", "runs", "wanted",
    "class", "bands", "n", "id", "first", "stop", "gone", "line", "site", "pos", "count",
    "word", "bits", "slot", "chunk", "stays", "of", "doc", "spans", "size", "removed", "alignment0",
)

SYLLABLES = "ra ten mo li sku ver ost ai bel dor na pi que zan fu rol mi sha ket ung".split()


def prose(seed: int, n_words: int) -> str:
    """Made-up sentences, the same for the same seed."""
    own = random.Random(seed)
    out = []
    while n_words > 0:
        size = min(n_words, own.randint(3, 12))
        n_words -= size
        sentence = ["".join(own.choices(SYLLABLES, k=own.randint(1, 4))) for _ in range(size)]
        out.append(" ".join(sentence).capitalize() + ".")
    return " ".join(out)


def table(spark, texts, langs=None, sources=None, ids=None):
    rows = [
        (
            i if ids is None else ids[i],
            text,
            langs[i] if langs else "xx",
            sources[i] if sources else f"s{i % 3}",
            None if text is None else len(text),
        )
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs):
    """docs with columns named like internals of the operators, plain, marked as private, with a
    number, and quoted."""
    from pyspark.sql import functions as F

    names = [f"{a}{name}{b}" for name in CLASHING for a, b in (("", ""), ("__", ""), ("_", "0"))]
    return docs.withColumns({name: F.lit("own") for name in [*names, "a.b", "a`b"]})


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, symbols, copies, a very long text and a very long word."""
    long_text = prose(1, 30_000)
    return [
        None,
        "",
        " \n\t ",
        "*** 123 ---",
        None,
        prose(2, 40),
        prose(2, 40),
        "x" * 5000,
        "ab" * 3000,
        long_text,
        long_text + " end",
        "日本語のテキスト。" * 3,
        "Ünïcödé 🙂 naïve\r\nline\x00two",
    ]
