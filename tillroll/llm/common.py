"""What the operators of this subpackage share: reading, row keys, words, per-document removal."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of words: digits, a-z and everything past ASCII; A-Z fold to a-z; the rest separates.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_key() -> Column:
    """With doc_id, the key of a row across passes; rows that repeat both are the same document
    twice and are treated alike."""
    return F.xxhash64(text_or_empty())


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text; see FOLD."""
    return text.translate(FOLD).split()


def in_chunks(texts: pa.Array, most: int) -> Iterator[list[str]]:
    """The texts of a batch (null: empty) in groups of about `most` bytes, one text at least, so
    that only one group is Python strings at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield [text or "" for text in texts.slice(start, stop - start).to_pylist()]
        start = stop


def own_names(*names: str) -> list[str]:
    """Names for columns of one's own beside a caller's, whatever those are called."""
    mark = uuid.uuid4().hex
    return [f"{name}_{mark}" for name in names]


def quoted(names: list[str]) -> list[str]:
    return [f"`{name.replace('`', '``')}`" for name in names]


def release() -> None:
    """Gives back what Arrow's pool holds beyond its arrays: workers live as long as the session, and
    the tasks of an executor share its memory."""
    pa.default_memory_pool().release_unused()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the constants are those of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def without_positions(pieces: Column, removed: Column) -> Column:
    """An array without the elements at the given 0-based positions (sorted, distinct).

    The gaps between removed positions are copied as slices, so the work is linear in both arrays.
    """
    bounds = F.concat(F.array(F.lit(-1)), removed, F.array(F.size(pieces)))
    return F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size(bounds) - 1),
            lambda i: F.slice(
                pieces, F.get(bounds, i - 1) + 2, F.get(bounds, i) - F.get(bounds, i - 1) - 1
            ),
        )
    )


_BUILT: dict[tuple[str, str], tuple[object, object]] = {}


def built(operator: str, value: object, build, part: str = "") -> object:
    """What `build` makes of a broadcast value, made once for each worker process.

    One result of each part of an operator is kept, with the value it was made of; the one before
    it goes first, and so do those of other operators: workers live as long as the session, and
    would hold what every stage before them built. Parts are few, and what is kept under one has a
    bound that its module states.
    """
    key = (operator, part)
    if key not in _BUILT or _BUILT[key][0] is not value:
        for other in [x for x in _BUILT if x == key or x[0] != operator]:
            del _BUILT[other]
        _BUILT[key] = (value, build(value))
    return _BUILT[key][1]
