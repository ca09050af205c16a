"""Suffix-array dedup: strings of LENGTH bytes that start anywhere else are removed.

Only suffixes that share a cover sample are sorted, one bucket at a time.

* Cover. In every string of LENGTH bytes one place is chosen by content alone: the one whose next
  GRAM bytes hash lowest, the first of equals. Two equal strings therefore hold a chosen place at
  the same offset, which is what a difference cover gives; but about one position in LENGTH / 2
  is a sample, not one in 17, and samples that differ can be told apart by their names.
* Ranks. A sample's name is the hash of its GRAM bytes; its rank among those of one name is the
  hash of all bytes that strings holding it at that place can cover (its context). Samples of one
  rank tie over any length: all their strings are repeated, and nothing more is compared.
* Buckets. Names with two or more ranks are left. One context of each rank goes to the name's
  bucket. A bucket's suffixes (one for each context and offset) are sorted by the LENGTH bytes
  they start with, neighbours are compared, and the outermost repeated ones are noted; a task
  holds one bucket at a time. Names with more than BUCKET ranks (a line that most documents hold)
  are split first: by halves of the range of offsets, on the bytes that all strings of a half
  share, until a group is small or is one string.

The repeated strings that hold a sample cover one run of bytes around it, from the outermost left
to the outermost right. Texts that no such run touches are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bloom import bit_filter, probed
from tillroll.llm.common import text_key, text_or_empty
from tillroll.workspace import Workspace

LENGTH = 400
#: A power of two.
GRAM = 32
#: Bytes of text that are searched for samples at once.
CHUNK_BYTES = 1 << 20
#: Ranks that a task takes as one bucket (50 MB of text); names with more are split.
BUCKET = 1 << 16
#: Contexts of a bucket up to which all offsets are sorted at once.
MATRIX_ROWS = 512

_BYTES = np.random.default_rng(1).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """The hash of the GRAM bytes from each position on."""
    own, span = _BYTES[buffer], 1
    while span < GRAM:
        own = own[:-span] * np.uint64(0x9E3779B97F4A7C15) + (own[span:] ^ (own[span:] >> np.uint64(29)))
        span *= 2
    own ^= own >> np.uint64(32)
    return own * np.uint64(0xD6E8FEB86659FD93)


def _lowest(hashes: np.ndarray, width: int) -> np.ndarray:
    """The position of the lowest of each `width` hashes, the first of equals."""
    key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    rest = width - span
    key = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def samples(texts: list[bytes], length: int = LENGTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """The chosen places of each text, in order, and their names."""
    out = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(texts)
    group: list[tuple[int, int, bytes]] = []
    parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def search() -> None:
        joined = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
        hashes = gram_hashes(joined)
        lowest = _lowest(hashes, length - GRAM + 1)
        start = 0
        for i, offset, part in group:
            chosen = np.unique(lowest[start : start + len(part) - length + 1])
            found = (chosen - start + offset, hashes[chosen].view(np.int64))
            parts.setdefault(i, []).append(found)
            start += len(part)

    for i, text in enumerate(texts):
        for offset in range(0, len(text) - length + 1, CHUNK_BYTES):
            part = text[offset : offset + CHUNK_BYTES + length - 1]
            group.append((i, offset, part))
            size += len(part)
            if size >= CHUNK_BYTES:
                search()
                group, size = [], 0
    if group:
        search()
    for i, found in parts.items():
        places, first = np.unique(np.concatenate([x for x, _ in found]), return_index=True)
        out[i] = (places, np.concatenate([x for _, x in found])[first])
    return out


def context(text: bytes, place: int, length: int = LENGTH) -> tuple[int, bytes]:
    """The bytes that strings holding a sample's gram can cover, and how many precede it."""
    start = max(0, place + GRAM - length)
    return place - start, text[start : place + length]


def rank(text: bytes, place: int, length: int = LENGTH) -> int:
    before, own = context(text, place, length)
    value = xxhash.xxh3_64_intdigest(own, before)
    return value - (1 << 64) if value >> 63 else value


SAMPLES = "struct<place:array<int>,name:array<long>,rank:array<long>>"


def sampled(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, key, and the samples of each text."""

    def sample(texts: pa.Array) -> pa.Array:
        own = [x.as_py() or b"" for x in texts]
        found = samples(own, length)
        ranks = [[rank(t, p, length) for p in at.tolist()] for t, (at, _) in zip(own, found, strict=True)]
        return pa.StructArray.from_arrays(
            [
                pa.array([at.astype(np.int32) for at, _ in found], pa.list_(pa.int32())),
                pa.array([names for _, names in found], pa.list_(pa.int64())),
                pa.array(ranks, pa.list_(pa.int64())),
            ],
            ["place", "name", "rank"],
        )

    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("key"),
        F.arrow_udf(sample, SAMPLES)(text_or_empty().cast("binary")).alias("found"),
    )
    each = F.explode(F.arrays_zip("found.place", "found.name", "found.rank")).alias("own")
    return found.select("doc_id", "key", each).select("doc_id", "key", "own.*")


def _document(frame: DataFrame) -> F.Column:
    return F.xxhash64(frame["doc_id"].cast("long"), frame["key"])


def _texts(docs: DataFrame, wanted: DataFrame, workspace: Workspace, name: str) -> DataFrame:
    """wanted (with doc_id and key, unique) with the texts; only texts that a Bloom filter of
    the wanted documents lets through are shuffled."""
    words = bit_filter(wanted.select(_document(wanted).alias("hash")), workspace, name)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("key"),
        text_or_empty().cast("binary").alias("text"),
    )
    near = probed(texts, _document(texts), words, "near").filter("near").drop("near")
    same = near["doc_id"].eqNullSafe(wanted["doc_id"]) & (near["key"] == wanted["key"])
    return wanted.join(near.hint("merge"), same).drop(near["doc_id"], near["key"])


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """name, rank, many, before, around: a context for each of a document's wanted samples."""

    def cut(text: pa.Array, wanted: pa.Array) -> pa.Array:
        out = []
        for own, places in zip(text, wanted.to_pylist(), strict=True):
            whole = own.as_py()
            found = []
            for x in places:
                before, around = context(whole, x["place"], length)
                own_ = {key: x[key] for key in ("name", "rank", "many")}
                found.append(own_ | {"before": before, "around": around})
            out.append(found)
        return pa.array(out, pa.list_(_CONTEXT))

    cut_ = F.arrow_udf(cut, "array<struct<name:long,rank:long,many:boolean,before:int,around:binary>>")
    return texts.select(F.explode(cut_("text", "wanted")).alias("own")).select("own.*")


_CONTEXT = pa.struct(
    [
        ("name", pa.int64()),
        ("rank", pa.int64()),
        ("many", pa.bool_()),
        ("before", pa.int32()),
        ("around", pa.binary()),
    ]
)

OUTERMOST = "name long, rank long, least int, most int"
_OUTERMOST = pa.schema(
    [("name", pa.int64()), ("rank", pa.int64()), ("least", pa.int32()), ("most", pa.int32())]
)


def outermost(before: list[int], around: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each context of a bucket the least and the most offset of the sample in a string of
    another context too (-1: none).

    The suffixes of one offset are sorted by the hash of their first `length` bytes, and equal
    neighbours at the outermost offsets are compared byte by byte.
    """
    n, most_before = len(before), length - GRAM
    width = most_before + length
    rows = np.zeros((n, width), np.uint8)
    starts = most_before - np.array(before)
    ends = starts + np.array([len(own) for own in around])
    for i, own in enumerate(around):
        rows[i, starts[i] : ends[i]] = np.frombuffer(own, np.uint8)
    search = _by_rows if n <= MATRIX_ROWS else _by_columns
    first, last, first_twin, last_twin = search(rows, starts, ends, length)
    for column, twin in ((first, first_twin), (last, last_twin)):
        for i in np.flatnonzero(column >= 0):
            own = slice(column[i], column[i] + length)
            if (rows[i, own] != rows[twin[i], own]).any():
                raise ValueError("two different strings share a hash; change the seed of _BYTES")
    found = first >= 0
    return np.where(found, most_before - last, -1), np.where(found, most_before - first, -1)


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _by_rows(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> Found:
    """The first and the last column where a row's string is another one's too, and that row; all
    columns at once."""
    n, width = rows.shape
    columns = np.arange(width - length + 1)
    sums = np.zeros((n, width + 1), np.uint64)
    np.cumsum(_BYTES[rows] * _powers(width), axis=1, out=sums[:, 1:])
    hashes = sums[:, length:] - sums[:, : len(columns)]
    there = (columns >= starts[:, None]) & (columns + length <= ends[:, None])
    # Strings that a context does not hold are made to differ from all.
    absent = np.arange(n, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    hashes = np.where(there, hashes, absent ^ np.uint64(0x5555555555555555))
    order = np.argsort(hashes, axis=0, kind="stable")
    ranked = np.take_along_axis(hashes, order, axis=0)
    equal = ranked[1:] == ranked[:-1]
    twins = np.full(rows.shape[:1] + columns.shape, -1, np.int64)
    k, column = np.nonzero(equal)
    twins[order[k, column], column] = order[k + 1, column]
    twins[order[k + 1, column], column] = order[k, column]
    twins[~there] = -1
    same = twins >= 0
    some = same.any(axis=1)
    first = np.where(some, same.argmax(axis=1), -1)
    last = np.where(some, len(columns) - 1 - same[:, ::-1].argmax(axis=1), -1)
    each = np.arange(n)
    return first, last, twins[each, first], twins[each, last]


def _by_columns(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> Found:
    """The same, one column after the other, in memory of the rows' own size."""
    n, width = rows.shape
    powers = _powers(width)
    first, last, first_twin, last_twin = (np.full(n, -1, np.int64) for _ in range(4))
    hashes = np.zeros(n, np.uint64)
    for column in range(length):
        hashes += _BYTES[rows[:, column]] * powers[column]
    for column in range(width - length + 1):
        if column:
            out, into = column - 1, column + length - 1
            hashes += _BYTES[rows[:, into]] * powers[into] - _BYTES[rows[:, out]] * powers[out]
        there = np.flatnonzero((column >= starts) & (column + length <= ends))
        there = there[np.argsort(hashes[there], kind="stable")]
        equal = np.flatnonzero(hashes[there[1:]] == hashes[there[:-1]])
        for own, twin in ((there[equal], there[equal + 1]), (there[equal + 1], there[equal])):
            last[own], last_twin[own] = column, twin
            new = first[own] < 0
            first[own[new]], first_twin[own[new]] = column, twin[new]
    return first, last, first_twin, last_twin


_POWERS: dict[int, np.ndarray] = {}


def _powers(width: int) -> np.ndarray:
    if width not in _POWERS:
        steps = np.full(width, 0x2545F4914F6CDD1D, np.uint64)
        _POWERS[width] = np.cumprod(steps)
    return _POWERS[width]


def _buckets(length: int):
    """Batches sorted by bucket to the outermost offsets, one bucket in memory at a time."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, names, ranks, before, around = None, [], [], [], []
        out: list[tuple[int, int, int, int]] = []

        def close() -> None:
            if len(ranks) > 1:
                least, most = outermost(before, around, length)
                found = zip(names, ranks, least.tolist(), most.tolist(), strict=True)
                out.extend(row for row in found if row[2] >= 0)

        for batch in batches:
            own = batch.column("bucket").to_pylist()
            columns = [batch.column(name).to_pylist() for name in ("name", "rank", "before", "around")]
            for other, name, rank_, n, text in zip(own, *columns, strict=True):
                if other != bucket:
                    close()
                    bucket, names, ranks, before, around = other, [], [], [], []
                names.append(name)
                ranks.append(rank_)
                before.append(n)
                around.append(text)
            if out:
                yield _batch(out)
                out = []
        close()
        if out:
            yield _batch(out)

    return sort


def _batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _OUTERMOST.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_OUTERMOST)


def _halved(contexts: DataFrame, length: int) -> DataFrame:
    """Each context twice, for the lower and the upper half of its range of offsets, with hashes
    of the bytes that all strings of that half share (core) and of all bytes that any of them
    holds (hull; null where the context ends before). Halves without a string are left out."""
    low, high = F.col("low"), F.col("high")
    middle = F.shiftright(low + high, 1)
    half = F.explode(
        F.array(
            F.struct(low.alias("low"), middle.alias("high")),
            F.struct((middle + 1).alias("low"), high.alias("high")),
        )
    ).alias("half")
    cut = contexts.select("name", "rank", "before", "around", half)
    cut = cut.select("name", "rank", "before", "around", "half.*")
    after = F.octet_length("around") - F.col("before")
    some = F.greatest(low, F.lit(length) - after) <= F.least(high, F.col("before"))
    core = F.substr("around", F.col("before") - low + 1, F.lit(length) - high + low)
    hull = F.substr("around", F.col("before") - high + 1, F.lit(length) + high - low)
    whole = (F.col("before") >= high) & (after >= F.lit(length) - low)
    return cut.filter((low <= high) & some).withColumns(
        {
            "core": F.xxhash64("name", "low", core),
            "hull": F.when(whole, F.xxhash64("name", "low", F.lit("hull"), hull)),
        }
    )


def _split(
    contexts: DataFrame, length: int, bucket: int, workspace: Workspace
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Buckets and finished rows for names with more ranks than a bucket takes.

    A string of offset o holds the bytes that all strings of a range around o share. So the range
    of offsets is halved again and again, and a context stays with a half only if another one has
    the same shared bytes there; groups small enough become buckets. A half whose strings are all
    repeated, since another context has the same bytes over all of them, is done, and one of these
    equal contexts stays for others to be compared with; so the halves inside a repeated run do
    not multiply, however many contexts share it.
    """
    buckets, done = [], []
    todo = contexts.select("*", F.lit(0).alias("low"), F.lit(length - GRAM).alias("high"))
    for level in range((length - GRAM).bit_length() + 1):
        halves = _halved(todo, length)
        shared = _shared(halves, "core", workspace, level)
        hulls = _shared(shared.filter("hull IS NOT NULL"), "hull", workspace, level)
        done.append(hulls.select("name", "rank", F.col("low").alias("least"), F.col("high").alias("most")))
        others = hulls.filter("rank != head").select("name", "rank", "low")
        left = shared.drop("head").join(others, ["name", "rank", "low"], "left_anti")
        left = workspace.store(left.filter("low < high"), f"open_{level}")
        buckets.append(
            left.filter(F.col("size") <= bucket).select(
                F.col("core").alias("bucket"), "name", "rank", "before", "around"
            )
        )
        todo = left.filter(F.col("size") > bucket).drop("core", "hull", "size")
        if todo.isEmpty():
            break
    return buckets, done


def _shared(halves: DataFrame, key: str, workspace: Workspace, level: int) -> DataFrame:
    """The halves whose key another one has, with the size and the smallest rank of that group."""
    sizes = halves.groupBy(key).agg(F.count(F.lit(1)).alias("size"), F.min("rank").alias("head"))
    sizes = sizes.filter("size > 1")
    sizes = workspace.store(sizes, f"{key}_{level}")
    words = bit_filter(sizes.select(F.col(key).alias("hash")), workspace, f"{key}_{level}_filter")
    near = probed(halves.drop("size", "head"), F.col(key), words, "near").filter("near").drop("near")
    return workspace.store(near.join(sizes, key), f"{key}_{level}_shared")


def repeated_runs(docs: DataFrame, length: int, workspace: Workspace, bucket: int = BUCKET) -> DataFrame:
    """doc_id, key, runs: the runs of bytes (start, end; they may overlap) to remove."""
    own = workspace.store(sampled(docs, length), "samples")
    at = F.struct("doc_id", "key", "place")
    kinds = own.groupBy("name", "rank").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("at"))
    names = kinds.groupBy("name").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("ranks"))
    names = workspace.store(names.filter("total > 1").drop("total"), "names")
    tied = workspace.store(kinds.join(names, "name"), "tied")
    wanted = workspace.store(
        tied.filter("ranks > 1")
        .groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.key").alias("key"))
        .agg(
            F.collect_list(
                F.struct("name", "rank", F.col("at.place").alias("place"), (F.col("ranks") > bucket).alias("many"))
            ).alias("wanted")
        ),
        "wanted",
    )
    texts = _texts(docs, wanted, workspace, "wanted_filter").dropDuplicates(["doc_id", "key"])
    contexts, split, done = _contexts(texts, length), [], []
    if not tied.filter(F.col("ranks") > bucket).isEmpty():
        contexts = workspace.store(contexts, "contexts")
        split, done = _split(contexts.filter("many").drop("many"), length, bucket, workspace)
    few = contexts.filter("NOT many").select(F.col("name").alias("bucket"), "*").drop("many")
    buckets = [few, *split]
    sorted_ = (
        reduce(DataFrame.unionByName, buckets)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_buckets(length), OUTERMOST)
    )
    found = reduce(DataFrame.unionByName, [sorted_, *done])
    if done:
        found = found.groupBy("name", "rank").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    outer = workspace.store(found, "outermost")
    again = tied.filter("n > 1").select(
        "name", "rank", F.lit(None).cast("int").alias("least"), F.lit(None).cast("int").alias("most")
    )
    # A rank with several samples is repeated over its whole context, whatever its bucket says.
    ends = workspace.store(
        outer.join(again.select("name", "rank"), ["name", "rank"], "left_anti").unionByName(again), "ends"
    )
    start = F.when(F.col("most").isNull(), F.greatest(F.col("place") + GRAM - length, F.lit(0)))
    end = F.when(F.col("least").isNull(), F.col("place") + length)
    return (
        own.join(ends, ["name", "rank"])
        .select(
            "doc_id",
            "key",
            F.struct(
                start.otherwise(F.col("place") - F.col("most")).alias("start"),
                end.otherwise(F.col("place") - F.col("least") + length).alias("end"),
            ).alias("run"),
        )
        .groupBy("doc_id", "key")
        .agg(F.collect_set("run").alias("runs"))
    )


REMOVED = "struct<n_removed:long,n_spans:long,kept:binary>"


def _without(text: pa.Array, runs: pa.Array) -> pa.Array:
    removed, spans, kept = [], [], []
    for own, cuts in zip(text, runs.to_pylist(), strict=True):
        whole, pieces, at, n, count = own.as_py(), [], 0, 0, 0
        for cut in sorted(((c["start"], min(c["end"], len(whole))) for c in cuts or ())):
            start, end = cut
            if start > at or not count:
                pieces.append(whole[at:start])
                count += 1
                n += end - start
                at = end
            elif end > at:
                n += end - at
                at = end
        pieces.append(whole[at:])
        removed.append(n)
        spans.append(count)
        kept.append(b"".join(pieces))
    return pa.StructArray.from_arrays(
        [pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
        ["n_removed", "n_spans", "kept"],
    )


def dedup_substrings(
    docs: DataFrame, length: int = LENGTH, workspace: Workspace | None = None, bucket: int = BUCKET
) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    Every byte covered by a string of `length` bytes that also starts anywhere else, in the same
    document or another, is removed; all are judged on the input. Texts are UTF-8 bytes, so a cut
    may fall inside a character. Null counts as empty; texts shorter than `length` stay whole; of
    copies nothing stays. Rows that repeat a doc_id are documents of their own. Other columns are
    not read. Runs jobs and writes to the shared folder when called.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    runs = workspace.store(repeated_runs(docs, length, workspace, bucket), "runs")
    words = bit_filter(runs.select(_document(runs).alias("hash")), workspace, "runs_filter")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("key"),
        text_or_empty().cast("binary").alias("text"),
    )
    marked = probed(texts, _document(texts), words, "near")
    whole = marked.filter(~F.col("near")).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.col("text").alias("kept"),
    )
    near = marked.filter("near")
    same = near["doc_id"].eqNullSafe(runs["doc_id"]) & (near["key"] == runs["key"])
    cut = F.arrow_udf(_without, REMOVED)
    some = near.hint("merge").join(runs, same, "left").select(
        near["doc_id"], F.octet_length("text").cast("long").alias("n_bytes"), cut("text", "runs").alias("cut")
    )
    return whole.unionByName(some.select("doc_id", "n_bytes", "cut.*"))
