"""Cross-tokenizer alignment: the smallest groups of tokens of two tokenizers that cover the same
bytes, by pointer jumping, and how often two ids are linked across the corpus.

Every token points to its farthest-right overlapping token of the other tokenizer, or to itself
(the first tokenizer's) where both end at one byte. Doubling all successors at once, in numpy,
takes every token to the terminal token of its group; the terminal labels the group.

A text is cut into units at single spaces between two other characters. Neither tokenizer has a
token across such a place, so units are encoded and aligned once each, many at a time, and a
worker remembers them. Links are counted as DataFrames: a document has each linked pair once, with
its number of occurrences; pairs are summed over the corpus, and the sums go back to documents by
a broadcast of the most frequent pairs, whose number is bounded, and a shuffle of the rest.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.bpe import Pieces
from tillroll.llm.common import built, in_chunks
from tillroll.workspace import Workspace

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")

#: Units that a worker remembers, about, and the characters of those: whichever comes first.
REMEMBERED, REMEMBERED_CHARS = 200_000, 4 << 20
#: Bytes (of one long text: characters) that are aligned at once.
CHUNK = 1 << 20
#: Pairs of ids that are broadcast at most.
BROADCAST_PAIRS = 1 << 19

_SPACE = "▁"
#: A unit starts with a space and ends before the next one that stands between two characters
#: that are no white space.
_UNIT = re.compile(r" \s*\S*(?:(?! \S)\s+\S*)*")
_SEAM = re.compile(r"(?<=\S) (?=\S)")


def _byte_of_character() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: a visible Latin-1
    character for itself, the characters from U+0100 on for the remaining bytes in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_level_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """The bytes and ids of a byte-level BPE file, without its special tokens. Merging the pair
    whose result has the lowest id must be what the file's list of merges says."""
    whole = json.loads(vocabulary)
    model, bytes_ = whole["model"], _byte_of_character()
    cut = whole["pre_tokenizer"]
    if cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or whole["normalizer"]:
        raise ValueError("not a plain byte-level vocabulary")
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][left + right] for left, right in merges]
    if made != sorted(made):
        raise ValueError("merges are not in the order of ids")
    special = {token["content"] for token in whole["added_tokens"]}
    return {bytes(map(bytes_.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}


class Tokenizers:
    """Both tokenizers, made of the contents of their files, and the bytes of every token."""

    def __init__(self, files: tuple[bytes, bytes]):
        ranks = byte_level_ranks(files[0])
        self.first = tiktoken.Encoding(
            "first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.second = sentencepiece.SentencePieceProcessor(model_proto=files[1])
        n = self.second.get_piece_size()
        names = self.second.id_to_piece(list(range(n)))
        pieces = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(names)
        ]
        self.n_second = n
        self.first_sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.first_sizes[list(ranks.values())] = [len(piece) for piece in ranks]
        self.second_sizes = np.array([len(piece) for piece in pieces], np.int64)
        self.second_pieces = pieces
        #: Whether no token of the second one goes on after a space that follows something else.
        self.cuts_at_spaces = not any(_SPACE in p.lstrip(_SPACE) for p in names)
        # The digits of an id with each of the marks that may follow it.
        self.marked = Pieces(
            {
                f"{i}{mark}".encode(): 3 * i + k
                for i in range(max(n, len(self.first_sizes)))
                for k, mark in enumerate(",|;")
            }
        )

    def units(self, text: str) -> list[str]:
        return _UNIT.findall(text) if self.cuts_at_spaces else [text]

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, one after the other, by each tokenizer.

        For the first one, units that can stand side by side go through as one text.
        """
        texts, together = [], False
        for unit in units:
            if together and self.cuts_at_spaces and not unit[1:2].isspace():
                texts[-1].append(unit)
            else:
                texts.append([unit])
            together = not unit[-1].isspace()
        first = [self.first.encode_ordinary("".join(text)) for text in texts]
        # The second tokenizer adds the space that each unit starts with by itself.
        second = self.second.encode([unit[1:] for unit in units], num_threads=1)
        return tuple(np.fromiter(chain.from_iterable(x), np.int64) for x in (first, second))

    def gives_back(self, ids: np.ndarray, text: bytes) -> bool:
        """Whether the second tokenizer's ids stand for these bytes."""
        return b"".join(map(self.second_pieces.__getitem__, ids.tolist())) == text


def terminals(first_ends: np.ndarray, second_ends: np.ndarray) -> np.ndarray:
    """For each token of the first and then of the second tokenizer, its group's terminal token.

    Both lists of ends rise and close at the same byte; a terminal is a token of the first.
    """
    n = len(first_ends)
    over = np.searchsorted(second_ends, first_ends)  # the token that holds the last byte
    successor = np.concatenate(
        [
            np.where(second_ends[over] == first_ends, np.arange(n), n + over),
            np.searchsorted(first_ends, second_ends),
        ]
    )
    while True:
        further = successor[successor]
        if (further == successor).all():
            return successor
        successor = further


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of many slices, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + sizes, sizes) + np.arange(total)


def _counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often (or with what sum of times) each occurs."""
    if times is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
    opens = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    if times is None:
        return keys[opens], np.diff(np.append(opens, len(keys)))
    return keys[opens], np.add.reduceat(times, opens) if len(opens) else times


class Aligner:
    """Aligns units and remembers them: counts, the text of their groups, and their linked pairs.

    A unit whose bytes either tokenizer does not give back is remembered as broken.
    """

    def __init__(self, files: tuple[bytes, bytes]):
        self.tokenizers = Tokenizers(files)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.groups: list[bytes] = []
        self.counts = np.empty((0, 4), np.int64)  # first, second, groups, links
        self.broken = np.empty(0, bool)
        self.pair_ends = np.zeros(1, np.int64)
        self.pairs = np.empty(0, np.int64)
        self.times = np.empty(0, np.int64)

    def learn(self, units: set[str]) -> None:
        new = [unit for unit in units if unit not in self.known]
        if self.known and (
            len(self.known) + len(new) > REMEMBERED or self.chars + sum(map(len, new)) > REMEMBERED_CHARS
        ):
            self.forget()
            new = list(units)
        if not new:
            return
        groups, counts, broken, sizes, pairs, times = self._align(new)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.chars += sum(map(len, new))
        self.groups += groups
        self.counts = np.concatenate([self.counts, counts])
        self.broken = np.concatenate([self.broken, broken])
        self.pair_ends = np.concatenate([self.pair_ends, self.pair_ends[-1] + np.cumsum(sizes)])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.times = np.concatenate([self.times, times])

    def _align(self, units: list[str]):
        """Of each unit: the text of its groups, counts, whether it is broken; the number of its
        distinct pairs, and all of these with their occurrences."""
        own = self.tokenizers
        texts = [unit.encode() for unit in units]
        ids, n = own.encode(units), len(units)
        broken = np.zeros(n, bool)
        if not own.gives_back(ids[1], b"".join(texts)):
            broken[:] = [not own.gives_back(own.encode([u])[1], t) for u, t in zip(units, texts, strict=True)]
            ids = own.encode([u for u, bad in zip(units, broken, strict=True) if not bad])
        counts = np.zeros((n, 4), np.int64)
        if not len(ids[0]):
            nothing = np.empty(0, np.int64)
            return [b""] * n, counts, broken, np.zeros(n, np.int64), nothing, nothing
        ends = np.cumsum(own.first_sizes[ids[0]]), np.cumsum(own.second_sizes[ids[1]])
        good = np.flatnonzero(~broken)
        unit_ends = np.cumsum([len(texts[i]) for i in good])
        number = [good[np.searchsorted(unit_ends, x)] for x in ends]
        to = terminals(*ends)
        last = np.flatnonzero(to[: len(ids[0])] == np.arange(len(ids[0])))
        group = [np.searchsorted(last, x) for x in (to[: len(ids[0])], to[len(ids[0]) :])]
        sizes = [np.bincount(x, minlength=len(last)) for x in group]
        unit = number[0][last]  # of each group
        counts[:, 0] = np.bincount(number[0], minlength=n)
        counts[:, 1] = np.bincount(number[1], minlength=n)
        counts[:, 2] = np.bincount(unit, minlength=n)
        np.add.at(counts[:, 3], unit, sizes[0] * sizes[1])
        return [self._text(ids, group, sizes, counts), counts, broken, *self._links(ids, group, unit, n)]

    def _text(self, ids, group, sizes, counts) -> list[bytes]:
        """a1,a2|b1 for each group, joined by semicolons, for each unit."""
        marks = []
        for k in range(2):
            mark = np.zeros(len(ids[k]), np.int64)
            mark[np.cumsum(sizes[k]) - 1] = k + 1
            marks.append(mark)
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        marked = np.concatenate([3 * i + m for i, m in zip(ids, marks, strict=True)])[order]
        data, ends = self.tokenizers.marked.joined(marked, np.cumsum(counts[:, 0] + counts[:, 1]))
        data, ends = bytes(data), ends.tolist()
        return [data[a : b - 1] if b > a else b"" for a, b in zip([0, *ends], ends, strict=False)]

    def _links(self, ids, group, unit, n):
        """The distinct linked pairs of each unit and how often each occurs: the distinct ids of a
        group on both sides, every one with every other."""
        distinct = []
        for k in range(2):
            base = int(ids[k].max()) + 1
            key, times = _counted(group[k] * base + ids[k])
            distinct.append((key // base, key % base, times))
        (group_a, id_a, times_a), (group_b, id_b, times_b) = distinct
        many = np.bincount(group_b)
        start = np.cumsum(many) - many
        width = many[group_a]
        b = _ragged(start[group_a], width)
        pair = np.repeat(id_a, width) * self.tokenizers.n_second + id_b[b]
        times = np.repeat(times_a, width) * times_b[b]
        owner = np.repeat(unit[group_a], width)
        # By unit and pair: a stable sort by pair, then by unit.
        order = np.lexsort((pair, owner))
        pair, times, owner = pair[order], times[order], owner[order]
        opens = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1]))))
        return np.bincount(owner[opens], minlength=n), pair[opens], np.add.reduceat(times, opens)


def _pieces(texts: list[str | None], whole: bool) -> Iterator[tuple[int, str]]:
    """Each text with the space before it, in pieces of about CHUNK characters cut between units."""
    for i, text in enumerate(texts):
        rest = f" {text}" if text else ""
        while len(rest) > CHUNK and not whole and (seam := _SEAM.search(rest, CHUNK - 1)):
            yield i, rest[: seam.start()]
            rest = rest[seam.start() :]
        if rest:
            yield i, rest


def _chunks(pieces: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    group, size = [], 0
    for piece in pieces:
        group.append(piece)
        size += len(piece[1])
        if size >= CHUNK:
            yield group
            group, size = [], 0
    if group:
        yield group


ALIGNMENT = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    + [T.StructField("groups", T.StringType())]
    + [T.StructField(name, T.ArrayType(T.LongType())) for name in ("pairs", "times")]
)


def aligned(texts: list[str | None], aligner: Aligner) -> pa.Array:
    """The alignment of whole texts; see align."""
    n = len(texts)
    counts, broken = np.zeros((n, 4), np.int64), np.zeros(n, bool)
    groups: list[list[bytes]] = [[] for _ in texts]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for chunk in _chunks(_pieces(texts, not aligner.tokenizers.cuts_at_spaces)):
        cut = [aligner.tokenizers.units(piece) for _, piece in chunk]
        aligner.learn(set().union(*cut))
        index = [list(map(aligner.known.__getitem__, units)) for units in cut]
        for (i, _), own in zip(chunk, index, strict=True):
            groups[i].append(b";".join(map(aligner.groups.__getitem__, own)))
        doc = np.repeat([i for i, _ in chunk], [len(x) for x in index])
        unit = np.fromiter(chain.from_iterable(index), np.int64, len(doc))
        # Each unit of a document once, with its number of occurrences.
        key, times = _counted((doc << 32) | unit)
        doc, unit = key >> 32, key & 0xFFFFFFFF
        opens = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        counts[doc[opens]] += np.add.reduceat(aligner.counts[unit] * times[:, None], opens)
        broken[doc[aligner.broken[unit]]] = True
        sizes = np.diff(aligner.pair_ends)[unit]
        at = _ragged(aligner.pair_ends[unit], sizes)
        found.append((np.repeat(doc, sizes), aligner.pairs[at], aligner.times[at] * np.repeat(times, sizes)))
    doc, pair, times = (
        np.concatenate(x) if found else np.empty(0, np.int64) for x in (zip(*found, strict=True) if found else [()] * 3)
    )
    good = ~broken[doc]
    doc, pair, times = doc[good], pair[good], times[good]
    base = int(pair.max()) + 1 if len(pair) else 1
    key, times = _counted(doc * base + pair, times)  # a pair of a document once
    counts[broken] = 0
    ends = np.concatenate(([0], np.cumsum(np.bincount(key // base, minlength=n)))).astype(np.int32)
    texts_ = [b"" if bad else b";".join(own) for own, bad in zip(groups, broken, strict=True)]
    columns = [pa.array(counts[:, k]) for k in range(4)]
    columns.append(pa.array(texts_, pa.binary()).cast(pa.string()))
    columns += [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (key % base, times)]
    return pa.StructArray.from_arrays(columns, ALIGNMENT.names)


def align(docs: DataFrame, text: str = "text", out: str = "alignment", first: str = FIRST, second: str = SECOND) -> DataFrame:
    """docs with a struct: n_a, n_b (tokens), n_groups, n_links, groups (`a1,a2|b1;a3|b2,b3`), and
    the distinct linked pairs with their number of occurrences (see pair_ids).

    Both tokenizers encode the whole text after a space, special tokens as plain text. A null or
    empty text, or one whose bytes either tokenizer does not give back, has no tokens. A text
    without a single space, however long, is one unit; a document's pairs are one array, at most
    all ids of one side of a group with all of the other. Rows do not depend on each other, so
    repeated ones are aligned alike. A column named as `out` is replaced; all others pass through, before it.
    """
    with open(first, "rb") as a, open(second, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    others = [field for field in docs.schema if field.name != out]
    places, at = [docs.columns.index(field.name) for field in others], docs.columns.index(text)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = built("aligner", files.value, Aligner)
        for batch in batches:
            start = 0
            for texts in in_chunks(batch.column(at), CHUNK):
                rows = batch.slice(start, len(texts))
                start += len(texts)
                columns = [rows.column(place) for place in places] + [aligned(texts, aligner)]
                yield pa.RecordBatch.from_arrays(columns, [*[field.name for field in others], out])
        aligner.forget()

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names of any form
    return plain.mapInArrow(own, T.StructType([*others, T.StructField(out, ALIGNMENT)]))


def pair_ids(pair: Column, second: str = SECOND) -> tuple[Column, Column]:
    """The two ids of a pair: it is the first id times the second vocabulary's size plus the
    second id."""
    n = sentencepiece.SentencePieceProcessor(model_file=second).get_piece_size()
    return ((pair - pair % n) / n).cast("long"), pair % n


def link_counts(pairs: DataFrame, n_second: int) -> DataFrame:
    """pair, docs (rows of `pairs`, a column of distinct pairs of a document, that hold it) and best:
    whether no other pair of the same first id has more."""
    counted = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    same_first = Window.partitionBy(F.expr(f"pair div {n_second}"))  # at most n_second rows
    return counted.withColumn("best", F.col("docs") == F.max("docs").over(same_first))


def align_documents(
    docs: DataFrame,
    workspace: Workspace | None = None,
    keep: Callable[[Column], Column] = lambda groups: groups,
    first: str = FIRST,
    second: str = SECOND,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    A pair's count is the number of rows of docs that hold it linked; n_best are the links whose
    pair has the highest count of its first id, ties included; count_sum adds the counts over all
    links. `keep` says what is stored of the groups' text. Rows that repeat a doc_id are documents
    of their own. Columns beside doc_id and text are not read. Runs jobs and writes to the shared
    folder when called.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    n_second = sentencepiece.SentencePieceProcessor(model_file=second).get_piece_size()
    found = align(docs.select("doc_id", "text"), first=first, second=second)
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    own = workspace.store(
        found.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            *[f"alignment.{c}" for c in counts],
            keep(F.col("alignment.groups")).alias("groups"),
            "alignment.pairs",
            "alignment.times",
        ),
        "aligned",
    )
    links = workspace.store(link_counts(own.select(F.explode("pairs").alias("pair")), n_second), "links")
    # The most frequent pairs, by powers of two of their counts, as far as they may be broadcast.
    power = F.length(F.bin("docs")) - 1
    sizes = {r.power: r["count"] for r in links.groupBy(power.alias("power")).count().collect()}
    least, total = 63, 0
    while least and (total := total + sizes.get(least - 1, 0)) <= broadcast_pairs:
        least -= 1
    frequent = F.broadcast(links.filter(F.col("docs") >= F.lit(2.0) ** least))
    rows = own.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("own"))
    rows = rows.select("row", F.col("own.pairs").alias("pair"), F.col("own.times").alias("times"))
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
    ]
    known = rows.join(frequent, "pair").groupBy("row").agg(*sums)
    if any(p < least for p in sizes):
        rare = links.filter(F.col("docs") < F.lit(2.0) ** least)
        others = rows.join(frequent.select("pair"), "pair", "left_anti").join(rare, "pair")
        known = known.unionByName(others.groupBy("row").agg(*sums))
        known = known.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    return own.join(known, "row", "left").select(
        "doc_id", *counts, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups"
    )
