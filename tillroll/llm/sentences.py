"""Substring dedup by sliding spans of sentences.

A span starts at any sentence and runs over the next ones until it has SENTENCES sentences and
WORDS words at least; a second one from the same place ends at FEWER sentences, a third at the
first sentence alone if that holds LONG_WORDS words. A text shorter than every span is one span.
Spans are hashed by their words and counted over all documents; of a span that occurs again, every
occurrence but the first loses its sentences.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bloom import bit_filter, probed
from tillroll.llm.common import text_key, text_or_empty, words
from tillroll.workspace import Workspace

SENTENCES = 3
#: Passages of this many sentences are hashed beside those of SENTENCES, not in their place: the
#: shorter spans alone would leave the last sentence of some passages.
FEWER = 2
WORDS = 20
#: From this many words on a span may end earlier, at one sentence too.
LONG_WORDS = 50

#: A sentence ends after closing marks (and quotes or other signs after them) before white space,
#: or at a line feed; the white space that follows belongs to it.
_END = re.compile(rb"(?:[.!?]+[^0-9A-Za-z\x80-\xff\s]*(?=\s)|\n)\s*")


def sentence_ends(text: bytes) -> list[int]:
    """Where the sentences of a UTF-8 text end, the last one included."""
    ends = [match.end() for match in _END.finditer(text)]
    if len(text) and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


def spans(
    text: bytes,
    sentences: int | tuple[int, ...] = (FEWER, SENTENCES),
    least_words: int = WORDS,
    long_words: int = LONG_WORDS,
) -> list[tuple[int, int, bytes]]:
    """First sentence, sentence after the last, and the words of each span.

    Sentences without a word belong to no span's start or count.
    """
    first_word, owners, own, at = [], [], [], 0
    for number, end in enumerate(sentence_ends(text)):
        found = words(text[at:end])
        at = end
        if found:
            first_word.append(len(own))
            owners.append(number)
            own += found
    if not own:
        return []
    joined = b" ".join(own)
    starts, place = [], 0
    for word in own:
        starts.append(place)
        place += len(word) + 1
    starts.append(place)
    last = len(first_word)
    first_word.append(len(own))
    sizes = (sentences,) if isinstance(sentences, int) else sentences
    # Sentences and words that a span has at least, the shortest kind last.
    kinds = [*((size, least_words) for size in sorted(sizes, reverse=True)), (1, long_words)]
    stops, out = [0] * len(kinds), []
    for i in range(last):
        for kind, (size, least) in enumerate(kinds):
            stop = max(stops[kind], i + size)
            while stop <= last and first_word[stop] - first_word[i] < least:
                stop += 1
            stops[kind] = stop
        ends = {stop for stop in stops[:-1] if stop <= last}
        if stops[-1] <= last and stops[-1] < min(stops[:-1]):
            ends.add(stops[-1])
        if not ends:
            break
        for stop in sorted(ends):
            span = joined[starts[first_word[i]] : starts[first_word[stop]] - 1]
            out.append((owners[i], owners[stop - 1] + 1, span))
    return out or [(owners[0], owners[-1] + 1, joined)]


def occurrences(
    docs: DataFrame, sentences: int | tuple[int, ...], least_words: int, long_words: int
) -> DataFrame:
    """doc_id, key, and for each span its 128-bit hash in two parts, first and stop."""

    def hashed(texts: pa.Array) -> pa.Array:
        offsets, first, stop, high, low = [0], [], [], [], []
        for text in texts:
            for a, b, span in spans(text.as_py() or b"", sentences, least_words, long_words):
                value = xxhash.xxh3_128_intdigest(span)
                first.append(a)
                stop.append(b)
                high.append((value >> 64) - (1 << 63))
                low.append((value & 0xFFFFFFFF) - (1 << 31))
            offsets.append(len(first))
        each = pa.StructArray.from_arrays(
            [
                pa.array(high, pa.int64()),
                pa.array(low, pa.int32()),
                pa.array(first, pa.int32()),
                pa.array(stop, pa.int32()),
            ],
            ["hash", "check", "first", "stop"],
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), each)

    kind = "array<struct<hash:long,check:int,first:int,stop:int>>"
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("key"),
        F.explode(F.arrow_udf(hashed, kind)(text_or_empty().cast("binary"))).alias("span"),
    ).select("doc_id", "key", "span.*")


def covered(
    docs: DataFrame,
    sentences: int | tuple[int, ...],
    least_words: int,
    long_words: int,
    workspace: Workspace,
) -> DataFrame:
    """doc_id, key, gone: the ranges of sentences that non-first repeated spans cover."""
    found = occurrences(docs, sentences, least_words, long_words)
    twice = found.groupBy("hash", "check").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = workspace.store(twice.select("hash", "check"), "repeated")
    words_ = bit_filter(twice.select("hash"), workspace, "repeated_filter")
    near = probed(found, F.col("hash"), words_, "near").filter("near").drop("near")
    again = workspace.store(near.join(twice, ["hash", "check"]), "again")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key", "first")
    firsts = workspace.store(
        again.groupBy("hash", "check").agg(F.min(place).alias("at")), "firsts"
    )
    is_first = (
        F.col("doc_id").eqNullSafe(F.col("at.doc_id"))
        & (F.col("key") == F.col("at.key"))
        & (F.col("first") == F.col("at.first"))
    )
    return (
        again.join(firsts, ["hash", "check"])
        .filter(~is_first)
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.struct("first", "stop")).alias("gone"))
    )


REMOVED = "struct<n_sentences:long,n_removed:long,spans:array<struct<start:int,end:int>>,kept:string>"
_REMOVED = pa.struct(
    [
        ("n_sentences", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("kept", pa.string()),
    ]
)


def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for text, ranges in zip(texts, gone.to_pylist(), strict=True):
        whole = text.as_py() or b""
        ends = [0, *sentence_ends(whole)]
        pieces, spans_, at, removed, characters = [], [], 0, 0, 0
        for a, b in sorted((r["first"], r["stop"]) for r in ranges or ()):
            a = max(a, at)
            if b <= a:
                continue
            piece = whole[ends[at] : ends[a]].decode()
            cut = len(whole[ends[a] : ends[b]].decode())
            characters += len(piece)
            pieces.append(piece)
            if spans_ and not piece:
                spans_[-1]["end"] += cut
            else:
                spans_.append({"start": characters, "end": characters + cut})
            characters += cut
            removed += b - a
            at = b
        pieces.append(whole[ends[at] :].decode())
        out.append(
            {
                "n_sentences": len(ends) - 1,
                "n_removed": removed,
                "spans": spans_,
                "kept": "".join(pieces),
            }
        )
    return pa.array(out, _REMOVED)


def dedup_spans(
    docs: DataFrame,
    sentences: int | tuple[int, ...] = (FEWER, SENTENCES),
    least_words: int = WORDS,
    workspace: Workspace | None = None,
    long_words: int = LONG_WORDS,
) -> DataFrame:
    """One row per row of docs: doc_id, n_sentences, n_removed, spans (removed runs in code
    points, end exclusive) and kept (the remaining text).

    The first occurrence has the smallest doc_id (null last), then the first sentence. Spans
    compare by lower-cased words. A text with fewer sentences or words than any span is one span; a
    text without words has none. Null counts as empty. A text of any length is cut whole, in memory of
    its task. Rows that repeat doc_id and text are treated alike. Other columns are not read. Runs jobs and writes to the shared folder when called.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    gone = workspace.store(covered(docs, sentences, least_words, long_words, workspace), "gone")
    marks = bit_filter(gone.select(F.xxhash64("doc_id", "key").alias("hash")), workspace, "gone_filter")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("key"),
        text_or_empty().cast("binary").alias("text"),
    )
    marked = probed(texts, F.xxhash64("doc_id", "key"), marks, "near")
    cut = F.arrow_udf(_without, REMOVED)
    none = F.lit(None).cast("array<struct<first:int,stop:int>>")
    whole = marked.filter(~F.col("near")).select("doc_id", cut("text", none).alias("cut"))
    near = marked.filter("near")
    same = near["doc_id"].eqNullSafe(gone["doc_id"]) & (near["key"] == gone["key"])
    some = near.hint("merge").join(gone, same, "left").select(near["doc_id"], cut("text", "gone").alias("cut"))
    return whole.unionByName(some).select("doc_id", "cut.*")
