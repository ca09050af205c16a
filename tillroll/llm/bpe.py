"""Byte-level BPE encoding and decoding with a public vocabulary of ranks.

A text is cut by the pattern of the vocabulary; every cut is a word. The distinct
words of a batch are encoded once, all together: their byte arrays are folded by ranked merges, the
lowest rank first and the leftmost of equals first, until no adjacent pair is in the rank map. Decoding concatenates the binary pieces.

The rank map has a fixed size (the vocabulary's) and is broadcast. The README says why the merges
run in Arrow batches and not in higher-order functions.
"""

from __future__ import annotations

import base64
import heapq
import re
import weakref
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import built, in_chunks, release

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

#: Distinct words, and bytes of words and ids, that a Python worker remembers beyond those at hand.
REMEMBERED, REMEMBERED_BYTES = 200_000, 8 << 20
#: From this many bytes on, a word's merges are taken from a heap.
LONG_WORD = 100
#: Bytes of text that are encoded at once.
CHUNK = 1 << 20
#: Ids that are decoded at once.
CHUNK_IDS = 1 << 18
#: Above every rank.
NONE = 1 << 30

_CUT = regex.compile(PATTERN)


def _latin(kind: str) -> str:
    """The Latin-1 characters of a class, as the inside of a bracket of a pattern of bytes."""
    return "".join(rf"\x{c:02x}" for c in range(256) if regex.fullmatch(kind, chr(c)))


def _latin_cut() -> re.Pattern:
    """The same pattern over Latin-1 bytes, for the texts that are no more than that."""
    letter, digit, space = map(_latin, (r"\p{L}", r"\p{N}", r"\s"))
    pattern = PATTERN
    for kind, own in ((r"\p{L}", letter), (r"\p{N}", digit)):
        pattern = pattern.replace(f"?{kind}", f"?[{own}]").replace(kind, own)
    pattern = pattern.replace(r"[^\s", f"[^{space}").replace(r"\S", f"[^{space}]")
    return re.compile(pattern.replace(r"\s", f"[{space}]").encode())


_LATIN_CUT = _latin_cut()


def cut(text: str) -> list[bytes] | list[str]:
    """The words of a text: Latin-1 bytes where its characters allow, else strings."""
    try:
        return _LATIN_CUT.findall(text.encode("latin-1"))
    except UnicodeEncodeError:
        return _CUT.findall(text)


def as_utf8(word: bytes | str) -> bytes:
    if isinstance(word, str):
        return word.encode()
    return word if word.isascii() else word.decode("latin-1").encode()


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


class Merges:
    """The rank map as arrays: for a pair of ids, the id of their concatenation.

    A piece can be the concatenation of several pairs of pieces; all are listed.
    """

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {
            (ranks[piece[:cut]] << 32) | ranks[piece[cut:]]: rank
            for piece, rank in ranks.items()
            for cut in range(1, len(piece))
            if piece[:cut] in ranks and piece[cut:] in ranks
        }
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        # The last key is above all others, so that every search ends inside.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], NONE)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE if it has none."""
        wanted = (left << 32) | right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)


def fold(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The ids of many words, one after the other, and where each word's begin and end.

    In each round every word merges one pair, the lowest rank first and the leftmost of equals
    first; words without one are done.
    """
    sizes = np.array([len(word) for word in words], np.int64)
    counts = np.zeros(len(words), np.int64)
    number = np.flatnonzero(sizes)
    sizes = sizes[number]
    ids = merges.single[np.frombuffer(b"".join(words), np.uint8)]
    starts = np.cumsum(sizes) - sizes
    rank = np.full(len(ids), NONE)
    rank[:-1] = merges.of(ids[:-1], ids[1:])
    rank[starts + sizes - 1] = NONE
    finished = []
    while len(number):
        best = np.minimum.reduceat((rank << 32) | np.arange(len(ids)), starts)
        open_ = (best >> 32) != NONE
        keep = np.repeat(open_, sizes)
        counts[number[~open_]] = sizes[~open_]
        finished.append((number[~open_], ids[~keep]))
        at = (np.cumsum(keep) - 1)[(best & 0xFFFFFFFF)[open_]]
        ids, rank, number, sizes = ids[keep], rank[keep], number[open_], sizes[open_]
        if not len(number):
            break
        ids[at] = rank[at]
        stays = np.ones(len(ids), bool)
        stays[at + 1] = False
        at = at - np.arange(len(at))
        ids, rank = ids[stays], rank[stays]
        sizes = sizes - 1
        starts = np.cumsum(sizes) - sizes
        rank[at] = NONE
        inner = at[at < starts + sizes - 1]
        rank[inner] = merges.of(ids[inner], ids[inner + 1])
        after = at[at > starts]
        rank[after - 1] = merges.of(ids[after - 1], ids[after])
    ends = np.cumsum(counts)
    out = np.empty(ends[-1] if len(ends) else 0, np.int32)
    for own, values in finished:
        n = counts[own]
        first = np.cumsum(n) - n
        out[np.arange(len(values)) + np.repeat(ends[own] - n - first, n)] = values
    return out, np.concatenate(([0], ends))


def _merged_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in time n log n: a heap of pairs over a linked list of part ends."""
    n = len(word)
    end, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n

    def pair(at: int) -> tuple[int, int, int] | None:
        after = end[at]
        if after >= n:
            return None
        rank = ranks.get(word[at : end[after]])
        return None if rank is None else (rank, at, end[after])

    heap = [x for x in map(pair, range(n)) if x]
    heapq.heapify(heap)
    while heap:
        _, at, until = heapq.heappop(heap)
        if not alive[at] or end[at] >= n or end[end[at]] != until:
            continue
        alive[end[at]] = False
        end[at] = until
        if until < n:
            previous[until] = at
        for changed in (at, previous[at]):
            if changed >= 0 and (x := pair(changed)):
                heapq.heappush(heap, x)
    return [ranks[word[at : end[at]]] for at in range(n) if alive[at]]


class Encoder:
    """Words to ids; the ids of a word are kept as the bytes of an int32 array."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.merges = Merges(ranks)
        self.known: dict[bytes | str, bytes] = {}
        self.size = 0

    def learn(self, words: set[bytes | str]) -> None:
        """Encodes words that are not known yet, each once."""
        if len(self.known) + len(words) > REMEMBERED or self.size > REMEMBERED_BYTES:
            self.known = {word: self.known[word] for word in words if word in self.known}
            self.size = sum(map(len, self.known)) + sum(map(len, self.known.values()))
        folded, texts, own_ids = [], [], []
        for word in words - self.known.keys():
            own = as_utf8(word)
            if own in self.ranks:
                own_ids.append((word, np.int32(self.ranks[own]).tobytes()))
            elif len(own) >= LONG_WORD:
                own_ids.append((word, np.array(_merged_long(own, self.ranks), np.int32).tobytes()))
            else:
                folded.append(word)
                texts.append(own)
        ids, ends = fold(texts, self.merges)
        data, ends = ids.tobytes(), (ends * ids.itemsize).tolist()
        own_ids += [(word, data[a:b]) for word, a, b in zip(folded, ends, ends[1:], strict=False)]
        self.known.update(own_ids)
        self.size += sum(len(word) + len(found) for word, found in own_ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        words = [cut(text) for text in texts]
        self.learn(set().union(*words))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, own)), np.int32) for own in words]


class Pieces:
    """All pieces in one buffer, by id."""

    def __init__(self, ranks: dict[bytes, int]):
        sizes = np.full(max(ranks.values()) + 1, -1, np.int64)
        pieces = {rank: piece for piece, rank in ranks.items()}
        sizes[list(pieces)] = [len(piece) for piece in pieces.values()]
        self.sizes = sizes
        self.data = np.frombuffer(b"".join(pieces[k] for k in sorted(pieces)), np.uint8)
        self.starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)

    def joined(self, ids: np.ndarray, stops: np.ndarray) -> tuple[bytearray, np.ndarray]:
        """The bytes of all ids, one after the other, and where those of the first stops[k] ids
        end (stops do not fall)."""
        out, ends, done = bytearray(), np.zeros(len(stops), np.int64), 0
        for start in range(0, len(ids), CHUNK_IDS):
            part = ids[start : start + CHUNK_IDS]
            if part.min() < 0 or part.max() >= len(self.sizes) or self.sizes[part].min() < 0:
                raise ValueError("an id outside the vocabulary")
            sizes = self.sizes[part]
            stop = np.cumsum(sizes)
            at = np.repeat(self.starts[part] - stop + sizes, sizes) + np.arange(stop[-1])
            out += self.data[at].tobytes()
            own = slice(*np.searchsorted(stops, [start, start + len(part)], "right"))
            ends[own] = done + stop[stops[own] - start - 1]
            done += stop[-1]
        return out, ends


def _same_memory(a: pa.Array, b: pa.Array) -> bool:
    """Whether two arrays that are both held are views of one."""
    at = [(x.type, x.offset, len(x), [y and y.address for y in x.buffers()]) for x in (a, b)]
    return at[0] == at[1]


class Latest:
    """The last result of a worker, for as long as others hold it.

    Where encode and decode meet in one Python node, Spark calls the function of encode twice on
    each batch: once for the ids, and once more for decode to start from. What a result was made of
    is held with it, so that no other array can be in its place.
    """

    def __init__(self):
        self.made = 0
        self._forget()

    def _forget(self, gone: weakref.ref | None = None) -> None:
        if gone is None or gone is self.result:
            self.value = self.given = self.result = None

    def of(self, value: object, given: pa.Array, make: Callable[[], pa.Array]) -> pa.Array:
        if self.result and self.value is value and _same_memory(self.given, given):
            found = self.result()
            if found is not None:
                return found
        self._forget()
        made = make()
        self.made += 1
        self.value, self.given, self.result = value, given, weakref.ref(made, self._forget)
        return made


_LATEST = Latest()
_SHARED: dict[tuple[str, str], Broadcast] = {}


def _ranks(spark: SparkSession, path: str) -> Broadcast:
    """The rank map of a file, broadcast once for encoding, decoding and later calls."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _SHARED:
        _SHARED[key] = spark.sparkContext.broadcast(load_ranks(path))
    return _SHARED[key]


def _encoded(texts: pa.Array, ranks: dict[bytes, int]) -> pa.Array:
    release()
    encoder = built("bpe", ranks, Encoder, "encoder")
    values, ends = array("i"), [0]
    for group in in_chunks(texts, CHUNK):
        for found in encoder.encode(group):
            values.frombytes(found.view(np.uint8))
            ends.append(len(values))
    own = pa.Array.from_buffers(pa.int32(), len(values), [None, pa.py_buffer(values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), own)


def _encoded_once(texts: pa.Array, ranks: dict[bytes, int]) -> pa.Array:
    """Beside the function that Spark pickles, which would take a copy of _LATEST along."""
    return _LATEST.of(ranks, texts, lambda: _encoded(texts, ranks))


def encode(
    docs: DataFrame, text: str = "text", out: str = "token_ids", path: str = VOCABULARY
) -> DataFrame:
    """docs with the token ids of a text column, without special tokens.

    A null text counts as empty and has no ids. A column named as `out` is replaced; all others
    pass through. Rows are independent of each other.
    """
    ranks = _ranks(docs.sparkSession, path)

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return _encoded_once(texts, ranks.value)

    return docs.withColumn(out, ids(F.col(text)))


def decode(
    frame: DataFrame, ids: str = "token_ids", out: str = "decoded", path: str = VOCABULARY
) -> DataFrame:
    """frame with the bytes that a column of ids stands for (binary: any list of ids has some,
    UTF-8 or not). Null ids give no bytes; an id outside the vocabulary raises."""
    ranks = _ranks(frame.sparkSession, path)

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        release()
        pieces = built("bpe", ranks.value, Pieces, "pieces")
        sizes = [0 if n is None else n for n in pc.list_value_length(lists).to_pylist()]
        data, ends = pieces.joined(lists.flatten().to_numpy(), np.cumsum(sizes, dtype=np.int64))
        ends = np.concatenate(([0], ends)).astype(np.int32)
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.binary(), len(sizes), buffers)

    return frame.withColumn(out, joined(F.col(ids)))
