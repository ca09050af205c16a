"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Every text becomes one row of figures (FEATURES): what its bytes, words, lines and sentences look
like. Trees are grown level by level on binned figures: the gradients of a level are summed into
one histogram for each node, figure and bin, and the best split is read off running sums. All
trees are flattened into five arrays, and a batch of rows walks them together: one step of numpy
indexing for each level.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_key
from tillroll.llm.language import in_fold

#: Labelled documents that are learned from, about: chosen by a hash of doc_id among all of them.
SAMPLE = 20_000
TREES = 120
DEPTH = 4
RATE = 0.1
BINS = 64
#: Added to the sum of second derivatives of a leaf; the least such sum on either side of a split.
RIDGE, LEAST_WEIGHT = 1.0, 2.0
#: A document is predicted good from this score on.
THRESHOLD = 0.3
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20

FEATURES = (
    "bytes", "words", "lines",
    "letters", "upper", "digits", "space", "punctuation", "other_symbols", "beyond_ascii", "byte_entropy",
    "word_bytes", "longest_word", "distinct_words", "commonest_word", "once_words", "word_entropy",
    "symbol_ends", "comma_ends", "stop_ends", "upper_words", "title_words", "symbol_words", "digit_words",
    "distinct_lines", "line_words", "short_lines", "stop_lines", "words_a_stop",
)

#: Classes of bytes: 0 control, 1 space, 2 a-z, 3 A-Z, 4 digit, 5 sentence punctuation, 6 other
#: symbols, 7 past ASCII.
_CLASS = np.array(
    [
        7 if b >= 128
        else 1 if chr(b).isspace()
        else 2 if 97 <= b <= 122
        else 3 if 65 <= b <= 90
        else 4 if 48 <= b <= 57
        else 5 if chr(b) in ".,;:!?'\"-()"
        else 6 if 32 < b < 127
        else 0
        for b in range(256)
    ]
)
_STOP, _COMMA, _ALNUM = (frozenset(x) for x in (b".!?", b",;:", range(128, 256)))
_ALNUM |= frozenset(b for b in range(128) if chr(b).isalnum())


def _entropy(counts: np.ndarray) -> float:
    total = counts.sum()
    if not total:
        return 0.0
    share = counts[counts > 0] / total
    return float(-(share * np.log2(share)).sum())


def _pieces(text: bytes):
    """A text in pieces of about PIECE bytes that end between words."""
    start = 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        yield text[start:end]
        start = end


def statistics(text: str | None) -> list[float]:
    """The figures of a whole text, in the order of FEATURES; null counts as empty.

    Words are cut at ASCII white space. Only the distinct words and lines are held beside the text.
    """
    data = (text or "").encode()
    counted = np.zeros(256, np.int64)
    words: Counter[bytes] = Counter()
    for piece in _pieces(data):
        counted += np.bincount(np.frombuffer(piece, np.uint8), minlength=256)
        words.update(piece.split())
    kinds = np.bincount(_CLASS, counted, 8)
    n, total = max(len(data), 1), max(words.total(), 1)
    sizes = stops = commas = symbols = uppers = titles = all_symbols = digits = once = longest = 0
    for word, times in words.items():
        sizes += len(word) * times
        longest = max(longest, len(word))
        once += times == 1
        last = word[-1]
        if last in _STOP:
            stops += times
        elif last in _COMMA:
            commas += times
        elif last not in _ALNUM:
            symbols += times
        uppers += times * word.isupper()
        titles += times * word.istitle()
        all_symbols += times * (not any(b in _ALNUM for b in word))
        digits += times * word.isdigit()
    lines = [line for line in data.split(b"\n") if line.strip()]
    count = max(len(lines), 1)
    ended = sum(line.rstrip()[-1] in _STOP for line in lines)
    return [
        np.log1p(len(data)),
        np.log1p(words.total()),
        np.log1p(len(lines)),
        (kinds[2] + kinds[3]) / n,
        kinds[3] / max(kinds[2] + kinds[3], 1),
        kinds[4] / n,
        kinds[1] / n,
        kinds[5] / n,
        kinds[6] / n,
        kinds[7] / n,
        _entropy(counted),
        sizes / total,
        longest,
        len(words) / total,
        max(words.values(), default=0) / total,
        once / total,
        _entropy(np.fromiter(words.values(), np.int64, len(words))),
        symbols / total,
        commas / total,
        stops / total,
        uppers / total,
        titles / total,
        all_symbols / total,
        digits / total,
        len(set(lines)) / count,
        words.total() / count,
        sum(len(line) < 30 for line in lines) / count,
        ended / count,
        words.total() / (stops + 1),
    ]


@dataclass
class Trees:
    """All trees, one node after the other. A leaf points at itself on both sides."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """The sum of leaf values for each row of figures: all rows go down a tree together."""
        total = np.full(len(rows), self.base)
        each = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(DEPTH):
                low = rows[each, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(rows)))


def fit(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Trees for the logistic loss of labels 0 and 1. Without rows every score is 0.5, with one
    label only it is constant, near that label."""
    ones = labels.sum()
    base = float(np.log((ones + 0.5) / (len(labels) - ones + 0.5)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    if 0 < ones < len(labels):
        edges = [_edges(rows[:, k]) for k in range(rows.shape[1])]
        binned = np.stack([np.searchsorted(e, rows[:, k]) for k, e in enumerate(edges)], 1)
        margin = np.full(len(rows), base)
        for _ in range(TREES):
            share = 1 / (1 + np.exp(-margin))
            roots.append(len(nodes))
            margin += RATE * _grow(binned, edges, share - labels, share * (1 - share), nodes)
    feature, threshold, left, right, value = np.array(nodes).reshape(-1, 5).T
    whole = [x.astype(np.int64) for x in (feature, left, right)]
    return Trees(np.array(roots, np.int64), whole[0], threshold, whole[1], whole[2], RATE * value, base)


def _edges(values: np.ndarray) -> np.ndarray:
    """At most BINS - 1 distinct quantiles; a value's bin is the number of edges below it."""
    return np.unique(np.quantile(values, np.arange(1, BINS) / BINS, method="lower"))


def _grow(
    binned: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, nodes: list[list[float]]
) -> np.ndarray:
    """Adds one tree to nodes; the leaf value of each row.

    For each level there is one histogram of slopes and one of curvatures, by node, figure and bin.
    """
    n, k = binned.shape
    at = np.zeros(n, np.int64)  # the row's node among those of the level
    own = np.full(1, len(nodes))  # the place of each node of the level
    nodes.append([0.0, 0.0, own[0], own[0], 0.0])
    result = np.zeros(n)
    for level in range(DEPTH + 1):
        weight = np.bincount(at[at >= 0], curve[at >= 0], len(own))
        value = -np.bincount(at[at >= 0], slope[at >= 0], len(own)) / (weight + RIDGE)
        for place, x in zip(own, value, strict=True):
            nodes[place][4] = x
        inside = at >= 0
        result[inside] = value[at[inside]]
        if level == DEPTH:
            break
        cell = ((at[inside, None] * k + np.arange(k)) * BINS + binned[inside]).ravel()
        shape = (len(own), k, BINS)
        sums = [
            np.bincount(cell, np.repeat(x[inside], k), len(own) * k * BINS).reshape(shape).cumsum(axis=2)
            for x in (slope, curve)
        ]
        (low_g, low_h), (all_g, all_h) = sums, (x[:, :, -1:] for x in sums)
        high_g, high_h = all_g - low_g, all_h - low_h
        gain = low_g**2 / (low_h + RIDGE) + high_g**2 / (high_h + RIDGE) - all_g**2 / (all_h + RIDGE)
        gain = np.where((low_h >= LEAST_WEIGHT) & (high_h >= LEAST_WEIGHT), gain, 0.0).reshape(len(own), -1)
        best = gain.argmax(axis=1)
        splits = gain[np.arange(len(own)), best] > 1e-9
        feature, cut = best // BINS, best % BINS
        children = np.full((len(own), 2), -1)
        following: list[int] = []
        for i in np.flatnonzero(splits):
            left, right = len(nodes), len(nodes) + 1
            nodes += [[0.0, 0.0, left, left, 0.0], [0.0, 0.0, right, right, 0.0]]
            nodes[own[i]][:4] = [feature[i], edges[feature[i]][cut[i]], left, right]
            children[i] = len(following), len(following) + 1
            following += [left, right]
        if not following:
            break
        high = binned[np.arange(n), feature[at]] > cut[at]
        at = np.where(inside, children[at, high.astype(np.int64)], -1)
        own = np.array(following)
    return result


def _statistics(texts: pa.Array) -> pa.Array:
    rows = np.array([statistics(x.as_py()) for x in texts]).reshape(-1, len(FEATURES))
    return pa.FixedSizeListArray.from_arrays(rows.ravel(), len(FEATURES)).cast(pa.list_(pa.float64()))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees for labels.quality, from documents that are not held out.

    Each labelled doc_id counts once: as 1 if the mean of its labels (null ones left out) is 0.5 or
    more; of documents that share a doc_id, the one whose text hashes lowest is read. If more than
    `sample` are labelled, those whose doc_id hashes below the share that gives about that many
    are taken; they are what reaches the driver, as figures.
    """
    known = (
        labels.filter(F.col("quality").isNotNull() & ~in_fold(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    share = min(1.0, sample / max(known.count(), 1))
    spot = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("quality")), 11).cast("double")
    chosen = known.filter(spot / float(1 << 53) < share)
    figures = F.arrow_udf(_statistics, "array<double>")
    found = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min(F.struct(text_key().alias("key"), "text")).alias("own"))
        .select("doc_id", "label", figures("own.text").alias("figures"))
        .toArrow()
        .sort_by("doc_id")
    )
    rows = found["figures"].combine_chunks()
    rows = rows.values.to_numpy().reshape(-1, len(FEATURES)) if len(rows) else np.empty((0, len(FEATURES)))
    return fit(rows, found["label"].to_numpy().astype(np.float64))


def predict(docs: DataFrame, trees: Trees, out: str = "quality") -> DataFrame:
    """docs with a struct of score (0 to 1, higher: better) and predicted (1 from THRESHOLD on).

    Only the text is looked at, whole; null counts as empty and has a score like any other text.
    Equal texts have equal scores. A column named as `out` is replaced; all others pass through.
    """

    @F.arrow_udf("struct<score:double,predicted:int>")
    def scored(texts: pa.Array) -> pa.Array:
        rows = np.array([statistics(x.as_py()) for x in texts]).reshape(-1, len(FEATURES))
        score = trees.scores(rows)
        predicted = (score >= THRESHOLD).astype(np.int32)
        return pa.StructArray.from_arrays([pa.array(score), pa.array(predicted)], ["score", "predicted"])

    return docs.withColumn(out, scored(F.col("text")))
