"""Benchmark decontamination: Wu-Manber search for windows of test items in document words.

The search runs over words. A pattern is a window of WINDOW consecutive words of an item, or all
words of a shorter item. Patterns of one length share a table: for every block of two words, by its
hash, the shift says how far the next possible end of a match is, so most positions are never
looked at. A shift of nought leads to the bucket of patterns that end in such a block; these are
compared directly, word for word.

The test set is a stated query set: it is searched in blocks of bounded size. A block's items are
broadcast, and each worker builds the block's tables once: arrays of about eight bytes for each
byte of items, at most 20. A word that is in several items lies in each of them.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import built, text_or_empty, words

WINDOW = 10
#: Bytes of item texts that are searched for (and broadcast) at once.
BLOCK_BYTES = 8 << 20

RESULT = "struct<n_words:long,hits:array<struct<start:int,end:int>>,items:array<string>>"
_RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)

class Table:
    """Patterns of one length, as places in the words of all items.

    `shifts` has a byte for each hash of a block: how far the next possible end of a match is at
    least, over all blocks of that hash. A hash's patterns, by the block that they end in, are the
    places order[starts[hash] : starts[hash + 1]].
    """

    def __init__(self, length: int, items: list[tuple[str, list[bytes]]]):
        self.length = length
        self.block = min(2, length)
        self.furthest = length - self.block + 1
        n_words = sum(len(own) for _, own in items)
        # Few blocks share a hash for shifts, which would shorten them; buckets need no such room.
        self.shift_mask = (1 << max(8, (8 * n_words).bit_length())) - 1
        self.mask = (1 << max(8, n_words.bit_length())) - 1
        if self.furthest > 255:
            raise ValueError("a window of more than 256 words")
        self.shifts = bytearray([self.furthest]) * (self.shift_mask + 1)
        self.names = [name for name, _ in items]
        first, ends, places, at = [], array("q"), array("i"), 0
        for _, own in items:
            first.append(at)
            for last in range(self.block - 1, len(own)):
                key = hash(tuple(own[last - self.block + 1 : last + 1])) & self.shift_mask
                # A block before the first possible end is as far from it as words are missing.
                self.shifts[key] = min(self.shifts[key], max(0, length - 1 - last))
                if last >= length - 1:
                    ends.append(key & self.mask)
                    places.append(at + last - length + 1)
            at += len(own)
        self.first = np.array(first, np.int32)  # of each item, its first word's place
        keys = np.frombuffer(ends, np.int64) if len(ends) else np.empty(0, np.int64)
        self.order = np.frombuffer(places, np.int32)[np.argsort(keys, kind="stable")] if len(keys) else keys
        self.starts = np.zeros(self.mask + 2, np.int32)
        np.cumsum(np.bincount(keys, minlength=self.mask + 1), out=self.starts[1:])
        # The words of all items, one space between two, and where each begins.
        self.text = b" ".join(word for _, own in items for word in own)
        sizes = np.fromiter((len(word) + 1 for _, own in items for word in own), np.int64, at)
        self.offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32 if len(self.text) < 1 << 31 else np.int64)

    def memory(self) -> int:
        """Bytes of the arrays."""
        arrays = (self.first, self.order, self.starts, self.offsets)
        return len(self.shifts) + len(self.text) + sum(own.nbytes for own in arrays)

    def search(self, text: list[bytes], hits: list[tuple[int, int]], items: set[str]) -> None:
        """Adds the places (end exclusive) and the items of all matches."""
        shifts, mask, length, block = self.shifts, self.shift_mask, self.length, self.block
        last, n = length - 1, len(text)
        while last < n:
            key = hash(tuple(text[last - block + 1 : last + 1])) & mask
            step = shifts[key]
            if step:
                last += step
                continue
            key &= self.mask
            a, b = self.starts[key], self.starts[key + 1]
            if a < b:
                start = last - length + 1
                wanted = b" ".join(text[start : last + 1])
                for place in self.order[a:b].tolist():
                    if self.text[self.offsets[place] : self.offsets[place + length] - 1] == wanted:
                        hits.append((start, last + 1))
                        items.add(self.names[int(np.searchsorted(self.first, place, "right")) - 1])
            last += 1


def tables(items: list[tuple[str, bytes]], window: int = WINDOW) -> list[Table]:
    by_length: dict[int, list[tuple[str, list[bytes]]]] = {}
    for item, text in items:
        own = words(text)
        if own:
            by_length.setdefault(min(window, len(own)), []).append((item, own))
    return [Table(length, own) for length, own in sorted(by_length.items())]


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _searched(items: Broadcast, window: int, block: int):
    @F.arrow_udf(RESULT)
    def search(texts: pa.Array) -> pa.Array:
        own, out = built("decontaminate", items.value, lambda x: tables(x, window), f"block {block}"), []
        for text in texts:
            text_words, hits, found = words(text.as_py() or b""), [], set()
            for table in own:
                table.search(text_words, hits, found)
            hits_ = [{"start": a, "end": b} for a, b in union(hits)]
            out.append({"n_words": len(text_words), "hits": hits_, "items": sorted(found)})
        return pa.array(out, _RESULT)

    return search


def _together(a: pa.Array, b: pa.Array) -> pa.Array:
    """Results of the same documents for two blocks of items."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
        spans = union([(h["start"], h["end"]) for h in x["hits"] + y["hits"]])
        x["hits"] = [{"start": start, "end": end} for start, end in spans]
        x["items"] = sorted({*x["items"], *y["items"]})
        out.append(x)
    return pa.array(out, _RESULT)


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The test set in blocks of about block_bytes of text, each small enough to broadcast; the
    driver holds one at a time."""
    texts = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        text_or_empty().cast("binary").alias("words"),
    )
    size = texts.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    block = F.pmod(F.xxhash64("item", "words"), F.lit(n))
    for i in range(n):
        yield [(row.item, bytes(row.words)) for row in texts.filter(block == i).collect()]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    out: str = "contamination",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """docs with a struct of n_words, hits (disjoint spans of hit words, end exclusive) and items
    (ids of the items with an occurring window, sorted as strings).

    Null and wordless texts have no words and no hits; so have null or wordless items. Items that
    share an id count as one, and null ids as the id "". A text of any length is searched whole, as
    one list of words; of windows that overlap or are in several items each one counts. Rows are
    independent of each other, so repeated ones are treated alike. A column named as `out` is
    replaced; all others pass through. Reads the benchmark when called.
    """
    text = F.col("text").cast("binary")
    sc = docs.sparkSession.sparkContext
    found = None
    together = F.arrow_udf(_together, RESULT)
    for block, items in enumerate(item_blocks(benchmark, block_bytes)):
        own = _searched(sc.broadcast(items), window, block)(text)
        found = own if found is None else together(found, own)
    return docs.withColumn(out, found)


def hit_words(contamination: F.Column) -> F.Column:
    """How many words the hits of a result cover."""
    return F.aggregate(
        contamination["hits"], F.lit(0).cast("long"), lambda n, hit: n + hit["end"] - hit["start"]
    )
