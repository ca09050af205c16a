"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

Texts with the same set of n-grams form a class; only one document of each class takes part. The
number of bands and rows follows from the recall asked for at the threshold. Classes that share
the hash of a band are tied together (each to the bucket's smallest); candidates lie in the
connected parts of these ties, and are compared on their full n-gram sets.

* A part of a block's size, which nearly all are, is one group; each text travels once.
* In a larger part, pairs that share a band are verified bucket by bucket, each pair in the first
  band that it shares, so the work follows the buckets and not the square of the part. Only where
  the buckets would be more work than all pairs, as in a group of near copies of one text, is the
  whole part compared.
* A bucket or part beyond a block's size is cut into blocks, and every pair of blocks is a group of
  its own, so no task holds more than two blocks.

What leaves a task is one row per class (its number of links and the smallest class it is tied to),
not its pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bloom import bit_filter, probed
from tillroll.llm.common import mixed, own_names, quoted, text_key, text_or_empty, words
from tillroll.llm.graph import components
from tillroll.workspace import Workspace

N = 5
THRESHOLD = 0.8
#: Share of the pairs at the threshold that banding must find (pairs above it: more).
RECALL = 0.99999
#: Hash functions at most; more rows in a band bring fewer false candidates.
MOST_HASHES = 150

#: A block of a part: at most about so many n-grams, and so many classes.
BLOCK_GRAMS = 1_000_000
BLOCK_CLASSES = 250
#: N-grams compared at once.
COLUMNS = 4096


def bands_and_rows(
    threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES
) -> tuple[int, int]:
    """The most rows in a band for which few enough hashes reach the recall, and the bands."""
    best = None
    for rows in range(1, most + 1):
        missed = 1 - threshold**rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(missed)))
        if best is None or bands * rows <= most:
            best = (bands, rows)
        if bands * rows > most:
            break
    return best


def grams(text: bytes, n: int = N) -> np.ndarray:
    """The distinct n-grams of a text's words, hashed and sorted. A text of fewer words, but not
    none, is one n-gram."""
    own = words(text)
    if not own:
        return np.empty(0, np.uint64)
    n = min(n, len(own))
    joined = b" ".join(own)
    ends = np.cumsum([len(word) + 1 for word in own])
    starts = np.concatenate(([0], ends[:-1]))
    hashed = xxhash.xxh3_64_intdigest
    spans = zip(starts[: len(own) - n + 1].tolist(), (ends[n - 1 :] - 1).tolist(), strict=True)
    return np.unique(np.fromiter((hashed(joined[a:b]) for a, b in spans), np.uint64))


def band_hashes(own: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash for each band of the least hashes of a set."""
    random = np.random.default_rng(20)
    times = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(own), 1024):
        each = own[None, start : start + 1024] * times[:, None] + plus[:, None]
        least = np.minimum(least, (each >> np.uint64(24)).min(axis=1))
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for row in range(rows):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + least[row::rows])
    return out.view(np.int64)


SKETCH = "struct<n:int,class:binary,bands:array<long>>"


def sketches(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key, and of each text's n-gram set: size, digest, band hashes."""

    def sketch(texts: pa.Array) -> pa.Array:
        sizes, digests, hashes = [], [], []
        for text in texts:
            own = grams(text.as_py() or b"", n)
            sizes.append(len(own))
            digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            hashes.append(band_hashes(own, bands, rows) if len(own) else [])
        return pa.StructArray.from_arrays(
            [
                pa.array(sizes, pa.int32()),
                pa.array(digests, pa.binary()),
                pa.array(hashes, pa.list_(pa.int64())),
            ],
            ["n", "class", "bands"],
        )

    sketched = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("key"),
        F.arrow_udf(sketch, SKETCH)(text_or_empty().cast("binary")).alias("sketch"),
    )
    return sketched.select("doc_id", "key", "sketch.*")


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of another."""
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    both = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(common), COLUMNS):
        part = common[start : start + COLUMNS]

        def rows(sets: list[np.ndarray], part: np.ndarray = part) -> np.ndarray:
            out = np.zeros((len(sets), len(part)), np.float32)
            for i, own in enumerate(sets):
                own = own[np.searchsorted(own, part[0]) : np.searchsorted(own, part[-1], "right")]
                at = np.searchsorted(part, own)
                out[i, at[part[np.minimum(at, len(part) - 1)] == own]] = 1
            return out

        a = rows(left)
        both += a @ (a if right is left else rows(right)).T
    return both


def _share_one(bands: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two classes share one of these bands: those pairs are another bucket's."""
    shared = np.zeros((len(a), len(b)), bool)
    for band in range(bands.shape[1]):
        shared |= bands[a, band][:, None] == bands[b, band]
    return shared


def _verified(group: pd.DataFrame, n: int, threshold: float) -> pd.DataFrame:
    """For each class of a group: its links, and the smallest class it is tied to in the group."""
    group = group.drop_duplicates("id").sort_values("id").reset_index(drop=True)
    low, high = int(group["low"][0]), int(group["high"][0])
    sets = [grams(bytes(text), n) for text in group["text"]]
    own = group["block"].to_numpy()
    a = np.flatnonzero(own == low)
    b = a if low == high else np.flatnonzero(own == high)
    links = np.zeros(len(group), np.int64)
    root = np.arange(len(group))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    band = int(group["band"][0])
    if len(a) and len(b):
        left = [sets[i] for i in a]
        right = left if low == high else [sets[i] for i in b]
        both = _intersections(left, right)
        either = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right]) - both
        linked = both >= threshold * either - 1e-6
        if band > 0:
            linked &= ~_share_one(np.stack(group["bands"])[:, :band], a, b)
        if low == high:
            np.fill_diagonal(linked, False)
            links[a] = linked.sum(axis=1)
        else:
            links[a], links[b] = linked.sum(axis=1), linked.sum(axis=0)
        for i, j in zip(*np.nonzero(linked), strict=True):
            x, y = top(a[i]), top(b[j])
            if x != y:
                root[max(x, y)] = min(x, y)
    ids = group["id"].to_numpy()
    tied = ids[[top(i) for i in range(len(group))]]
    return pd.DataFrame({"id": ids, "links": links, "tied": tied})


def jaccard_classes(
    docs: DataFrame,
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per row of docs: doc_id, key (see text_key), class_id, class_size, n_links,
    group_id, stays.

    Documents with the same set of word n-grams share a class; class_id is its smallest doc_id,
    class_size its rows. n_links counts the other classes with a Jaccard similarity of threshold
    or more. group_id is the smallest doc_id that links lead to, and `stays` marks the rows with
    that doc_id (and text): a row that is repeated whole stays as often as it comes. Texts
    without a word (null, empty) share a class without links, and all of them stay. A null doc_id
    comes last. A text of any length is one set of n-grams. Other columns are not read. Runs jobs and
    writes to the shared folder when called.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    bands, rows = bands_and_rows(threshold, recall)
    sketched = workspace.store(sketches(docs, n, bands, rows), "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key", "n", "bands")
    classes = workspace.store(
        sketched.groupBy("class")
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("size"))
        .select("class", "size", "first.*", F.monotonically_increasing_id().alias("id")),
        "classes",
    )
    tied = workspace.store(_ties(classes, workspace), "ties")
    parts = components(tied, workspace, "parts")
    members = workspace.store(
        classes.join(parts, classes["id"] == parts["vertex"]).select(
            "id", F.col("component").alias("part"), "doc_id", "key", "n"
        ),
        "members",
    )
    dealt = _dealt(members, classes.select("id", "bands"), workspace)
    verified = workspace.store(_compared(docs, dealt, members, n, threshold, workspace), "verified")
    links = verified.groupBy("id").agg(F.sum("links").alias("n_links"))
    edges = verified.filter("id != tied").select(F.col("id").alias("a"), F.col("tied").alias("b"))
    groups = components(edges, workspace, "groups")
    grouped = (
        classes.select("class", "size", "unknown", "doc_id", "key", "n", "id")
        .join(links, "id", "left")
        .join(groups.withColumnRenamed("vertex", "id"), "id", "left")
        .withColumn("group", F.coalesce("component", "id"))
    )
    grouped = workspace.store(grouped, "grouped")
    order = F.struct("unknown", "doc_id", "key")
    heads = workspace.store(grouped.groupBy("group").agg(F.min(order).alias("head")), "heads")
    known = workspace.store(
        grouped.join(heads, "group").select(
            "class",
            F.col("doc_id").alias("class_id"),
            F.col("size").alias("class_size"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "head",
            (F.col("n") == 0).alias("wordless"),
        ),
        "known",
    )
    stays = F.col("wordless") | (
        F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("key") == F.col("head.key"))
    )
    return (
        sketched.select("doc_id", "key", "class")
        .join(known, "class")
        .select(
            "doc_id",
            "key",
            "class_id",
            "class_size",
            "n_links",
            F.when(F.col("wordless"), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("group_id"),
            stays.alias("stays"),
        )
    )


def _ties(classes: DataFrame, workspace: Workspace) -> DataFrame:
    """Each class with the smallest class of every bucket that it shares."""
    banded = classes.select("id", F.posexplode("bands").alias("band", "value"))
    hubs = workspace.store(
        banded.groupBy("band", "value")
        .agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
        .drop("size"),
        "buckets",
    )
    shared = banded.join(hubs, ["band", "value"])
    return shared.filter("id != b").select(F.col("id").alias("a"), "b").distinct()


_GROUP = ("part", "band", "value")


def _blocks(size: str = "size", grams: str = "grams") -> F.Column:
    needed = F.greatest(F.ceil(F.col(size) / BLOCK_CLASSES), F.ceil(F.col(grams) / BLOCK_GRAMS), F.lit(1))
    return needed.cast("int")


def _dealt(members: DataFrame, bands: DataFrame, workspace: Workspace) -> DataFrame:
    """members for each group of _GROUP that they are compared in: the whole part (band -1), or in
    a large part the buckets that they share; with the group's blocks, their own, and for buckets
    the hashes of all bands."""
    parts = members.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("grams"))
    parts = workspace.store(parts.withColumn("blocks", _blocks()), "part_sizes")
    no_bands, whole = F.lit(None).cast("array<long>"), [F.lit(-1).alias("band"), F.lit(0).cast("long").alias("value")]
    columns = ["id", "part", "doc_id", "key", "n", "band", "value", "blocks", "bands"]
    by_part = parts.select("part", "blocks")
    several = parts.filter("blocks > 1").select("part", "size")
    own = None
    if not several.isEmpty():
        own = members.join(several.select("part"), "part").join(bands, "id")
        own = workspace.store(own.select("*", F.posexplode("bands").alias("band", "value")), "band_members")
        buckets = own.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("grams"))
        buckets = workspace.store(buckets.filter("size > 1").withColumn("blocks", _blocks()), "shared_bands")
        work = buckets.groupBy("part").agg(F.sum(F.col("size").cast("double") * F.col("size")).alias("work"))
        cheaper = work.join(several, "part").filter(F.col("work") < F.col("size").cast("double") * F.col("size"))
        cheaper = workspace.store(cheaper.select("part"), "parts_by_band")
        own = own.join(cheaper, "part", "left_semi").join(buckets.drop("size", "grams"), list(_GROUP)).select(columns)
        by_part = by_part.join(cheaper, "part", "left_anti")
    dealt = members.join(by_part, "part").select("*", *whole, no_bands.alias("bands")).select(columns)
    dealt = dealt if own is None else dealt.unionByName(own)
    return dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))


def _compared(
    docs: DataFrame, dealt: DataFrame, members: DataFrame, n: int, threshold: float, workspace: Workspace
) -> DataFrame:
    """id, links, tied: a row for each class and pair of blocks that it is in."""
    # Only texts that a Bloom filter of the members lets through are shuffled.
    wanted = bit_filter(members.select(F.xxhash64("doc_id", "key").alias("hash")), workspace, "members_filter")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("key"),
        text_or_empty().cast("binary").alias("text"),
    )
    texts = probed(texts, F.xxhash64("doc_id", "key"), wanted, "near").filter("near")
    same = texts["doc_id"].eqNullSafe(dealt["doc_id"]) & (texts["key"] == dealt["key"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = (
        dealt.join(texts.hint("merge"), same)
        .select("id", *_GROUP, "bands", "block", "text", other)
        .select(
            "id",
            *_GROUP,
            "bands",
            "block",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "text",
        )
    )
    return paired.groupBy(*_GROUP, "low", "high").applyInPandas(
        lambda group: _verified(group, n, threshold), "id long, links long, tied long"
    )


def one_of_each(
    docs: DataFrame,
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The rows of docs that stay, one of each group of jaccard_classes, all columns.

    Of rows that repeat doc_id and text one stays. Rows without a class mate or link are told by a
    Bloom filter and are not shuffled.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    stays, near_, key, doc, of = own_names("stays", "near", "key", "doc", "of")
    found = jaccard_classes(docs, n, threshold, recall, workspace)
    shared = found.filter((F.col("class_size") > 1) | (F.col("n_links") > 0))
    decided = shared.groupBy("doc_id", "key").agg(F.max("stays").alias(stays))
    decided = workspace.store(decided, "decided")
    words_ = bit_filter(decided.select(F.xxhash64("doc_id", "key").alias("hash")), workspace, "decided_filter")
    hash_ = F.xxhash64(F.col("doc_id").cast("long"), text_key())
    marked = probed(docs, hash_, words_, near_)
    near = marked.filter(F.col(near_)).withColumn(key, text_key())
    decided = decided.select(F.col("doc_id").alias(doc), F.col("key").alias(of), stays)
    same = near["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(of))
    kept = (
        near.hint("merge").join(decided, same, "left")
        .filter(F.coalesce(stays, F.lit(True)))
        .dropDuplicates(["doc_id", key])
    )
    alone = marked.filter(~F.col(near_))
    return alone.select(quoted(docs.columns)).unionByName(kept.select(quoted(docs.columns)))
