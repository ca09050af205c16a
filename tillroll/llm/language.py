"""Language identification: averaged embeddings of hashed subwords and a linear softmax.

The subwords of a text are the byte 3- and 4-grams of its lower-cased words, a word's edges
included and nothing across two words. A model averages their embeddings and feeds the mean to a
linear softmax; it is fitted by stochastic gradient descent in numpy on a bounded sample of
labelled rows. Prediction uses that the mean of embeddings times the weights is the mean of
(embeddings times weights): one small table of scores per bucket is broadcast.

Scores are calibrated by a temperature fitted on a part of the sample that training does not see.
A prediction is rejected below a score under which hardly any right prediction of that part falls.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import built, in_chunks, release

UNKNOWN = "und"

#: The sample: about this many labelled rows of each language, chosen by a hash of doc_id.
SAMPLE_PER_LANGUAGE = 800
BUCKETS = 1 << 15
DIMENSIONS = 16
EPOCHS = 6
RATE = 1.0
#: Of the sample, one row in CALIBRATION is for calibration.
CALIBRATION = 5
#: A prediction is rejected below the score that this share of right ones stays under, and never
#: at MOST_REJECTED or above.
REJECTED_SHARE = 0.001
MOST_REJECTED = 0.5
#: Bytes that are hashed at once.
CHUNK_BYTES = 2 << 20

_LETTER = regex.compile(r"\p{L}")
#: Bytes that may be part of a word: letters and everything past ASCII; the rest separates.
_WORDS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def buckets(buffer: np.ndarray) -> np.ndarray:
    """The bucket of the 3-gram and of the 4-gram at each position; BUCKETS where there is none.

    The buffer ends with four spaces at least.
    """
    n = len(buffer) - 3
    gap = buffer == 32
    b = buffer.astype(np.uint32)
    three = b[:n] | (b[1 : n + 1] << np.uint32(8)) | (b[2 : n + 2] << np.uint32(16))
    four = three | (b[3 : n + 3] << np.uint32(24))
    out = np.empty((2, n), np.uint32)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    out[0] = ((three ^ np.uint32(0x7F000000)) * np.uint32(0x9E3779B1)) >> shift
    out[1] = ((four ^ (four >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> shift
    inner = gap[1 : n + 1]
    out[0][inner] = BUCKETS
    out[1][inner | gap[2 : n + 2]] = BUCKETS
    return out


def prepared(text: str) -> bytes:
    """Lower-cased words between single separators; empty without a letter."""
    if not _LETTER.search(text):
        return b""
    return b" ".join(text.lower().encode().translate(_WORDS).split())


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a whole text and how often each occurs."""
    total = np.zeros(BUCKETS + 1, np.int64)
    for piece in _chunks(prepared(text or "")):
        own = buckets(np.frombuffer(b" " + piece + b"    ", np.uint8))
        total += np.bincount(own.ravel(), minlength=BUCKETS + 1)
    used = np.flatnonzero(total[:BUCKETS])
    return used.astype(np.int32), total[used].astype(np.int32)


def _chunks(text: bytes) -> list[bytes]:
    """A text in pieces of about CHUNK_BYTES that end between words."""
    out, start = [], 0
    while start < len(text):
        end = len(text) if len(text) - start <= CHUNK_BYTES else text.find(b" ", start + CHUNK_BYTES)
        end = len(text) if end < 0 else end
        out.append(text[start:end])
        start = end + 1
    return out


@dataclass
class Model:
    """scores: for each bucket and language (the last row is nought); bias: for each language."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def logits(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (sums / np.maximum(n, 1)[:, None] + self.bias) / self.temperature

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and calibrated score; UNKNOWN and 0 for null or without a letter."""
        ready = [prepared(x) if x else b"" for x in texts]
        sums = np.zeros((len(texts), len(self.languages)))
        n = np.zeros(len(texts))
        group, size = [], 0
        for i, text in enumerate(ready):
            for piece in _chunks(text):
                group.append((i, piece))
                size += len(piece)
                if size >= CHUNK_BYTES:
                    self._add(group, sums, n)
                    group, size = [], 0
        if group:
            self._add(group, sums, n)
        logits = self.logits(sums, n)
        shares = np.exp(logits - logits.max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        best = shares.argmax(axis=1)
        known = [bool(x) for x in ready]
        score = np.where(known, shares[np.arange(len(best)), best], 0.0)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)], score

    def _add(self, group: list[tuple[int, bytes]], sums: np.ndarray, n: np.ndarray) -> None:
        lengths = np.array([len(piece) + 5 for _, piece in group])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        buffer = np.frombuffer(b"".join(b" " + piece + b"    " for _, piece in group), np.uint8)
        own = buckets(buffer)
        rows = np.array([i for i, _ in group])
        valid = (own < BUCKETS).sum(axis=0, dtype=np.int64)
        np.add.at(n, rows, np.add.reduceat(valid, starts))
        for k in range(len(self.languages)):
            column = self.scores[:, k]
            each = column[own[0]] + column[own[1]]
            np.add.at(sums[:, k], rows, np.add.reduceat(each, starts, dtype=np.float64))


def fit(
    rows: list[tuple[str, np.ndarray, np.ndarray]], held_for_calibration: list[bool], seed: int = 7
) -> Model:
    """A model of (language, buckets, counts) rows. Without any row it knows no language but
    UNKNOWN and rejects everything."""
    languages = sorted({language for language, _, _ in rows})
    if not languages:
        return Model([UNKNOWN], np.zeros((BUCKETS + 1, 1), np.float32), np.zeros(1), 1.0, 2.0)
    number = {language: k for k, language in enumerate(languages)}
    random = np.random.default_rng(seed)
    embeddings = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    train = [i for i, held in enumerate(held_for_calibration) if not held] or list(range(len(rows)))
    check = [i for i, held in enumerate(held_for_calibration) if held] or train
    steps, done = EPOCHS * len(train), 0
    for _ in range(EPOCHS):
        for i in random.permutation(train):
            language, used, times = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            share = (times / max(times.sum(), 1)).astype(np.float32)
            own = embeddings[used]
            mean = share @ own
            logits = mean @ weights + bias
            slope = np.exp(logits - logits.max())
            slope /= slope.sum()
            slope[number[language]] -= 1
            embeddings[used] = own - rate * np.outer(share, weights @ slope)
            weights -= rate * np.outer(mean, slope)
            bias -= 0.01 * rate * slope
    scores = np.vstack([embeddings @ weights, np.zeros((1, len(languages)), np.float32)])
    model = Model(languages, scores.astype(np.float32), bias.astype(np.float64), 1.0, 0.0)
    _calibrate(model, [rows[i] for i in check], number)
    return model


def _calibrate(model: Model, rows: list[tuple[str, np.ndarray, np.ndarray]], number: dict[str, int]) -> None:
    sums = np.array([times @ model.scores[used] for _, used, times in rows])
    n = np.array([times.sum() for _, _, times in rows])
    truth = np.array([number[language] for language, _, _ in rows])
    logits, each = model.logits(sums, n), np.arange(len(rows))

    def shares(temperature: float) -> np.ndarray:
        x = logits / temperature
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)

    def loss(temperature: float) -> float:
        return -np.log(np.maximum(shares(temperature)[each, truth], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    final = shares(model.temperature)
    right = final.argmax(axis=1) == truth
    low = np.quantile(final.max(axis=1)[right], REJECTED_SHARE) if right.any() else 1.0
    model.least = float(min(MOST_REJECTED, low))


def in_fold(doc_id: F.Column) -> F.Column:
    """Whether a row is held out: crc32 of doc_id as text, modulo 5, is 0. Null is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _counted(texts: pa.Array) -> pa.Array:
    pairs = [counts(x.as_py()) for x in texts]
    return pa.StructArray.from_arrays(
        [pa.array([list(p[k]) for p in pairs], pa.list_(pa.int32())) for k in range(2)], ["used", "times"]
    )


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model of the labelled rows of docs that are not held out.

    The number of rows of each language is counted; then rows whose doc_id hashes below the share
    that gives about per_language of them are read, whole texts each. The sample is at most a few
    times per_language times the number of languages, and is what reaches the driver.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & ~in_fold(F.col("doc_id")))
    sizes = {row.lang: row["count"] for row in labelled.groupBy("lang").count().collect()}
    spot = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    share = F.lit(0.0)
    for language, size in sorted(sizes.items()):
        share = F.when(F.col("lang") == language, F.lit(min(1.0, per_language / size))).otherwise(share)
    place = (F.shiftrightunsigned(spot, 11).cast("double")) / float(1 << 53)
    counted = F.arrow_udf(_counted, "struct<used:array<int>,times:array<int>>")
    sample = (
        labelled.select("doc_id", "lang", "text", place.alias("place"))
        .filter(F.col("place") < share)
        .select("doc_id", "lang", counted("text").alias("bag"))
        .orderBy("doc_id", "lang")
        .toArrow()
    )
    bags = sample["bag"].combine_chunks()
    used, times = bags.field("used"), bags.field("times")
    rows = [
        (language.as_py(), used[i].values.to_numpy(), times[i].values.to_numpy())
        for i, language in enumerate(sample["lang"])
    ]
    rows = [row for row in rows if len(row[1])]
    return fit(rows, [i % CALIBRATION == 0 for i in range(len(rows))])


def predict(docs: DataFrame, model: Model, out: str = "language") -> DataFrame:
    """docs with a struct of lang_pred, score (0 to 1) and accepted.

    Only the text is looked at, whole. Null and texts without a letter get UNKNOWN, score 0, and
    are not accepted. A column named as `out` is replaced; all others pass through.
    """
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    @F.arrow_udf("struct<lang_pred:string,score:double,accepted:boolean>")
    def predicted(texts: pa.Array) -> pa.Array:
        release()
        own: Model = built("language", shared.value, pickle.loads)
        found = [own.predict(group) for group in in_chunks(texts, CHUNK_BYTES)]
        names = [name for group, _ in found for name in group]
        score = np.concatenate([np.empty(0), *[scores for _, scores in found]])
        accepted = [x >= own.least and name != UNKNOWN for name, x in zip(names, score, strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
            ["lang_pred", "score", "accepted"],
        )

    return docs.withColumn(out, predicted(F.col("text")))
