"""Toxicity scores by FTRL-proximal logistic regression.

Features are hashed word unigrams, bigrams and skip-grams (two words with one
between) of the lower-cased text, present or absent.  The learner keeps one
learning rate per coordinate and an L1 penalty, so only few weights are not
zero; those are broadcast (at most ``2 ** BITS`` numbers).

The classifier is fitted on a bounded sample of the labelled rows that are not
held out: the ``MAX_SAMPLE`` ids with the smallest hash, texts of at most
``SAMPLE_TEXT_BYTES``, and of them, in hash order, as many as have
``SAMPLE_FEATURES`` features together.  Features of the sampled texts are
extracted in parallel; one task learns from them in hash order, several epochs,
so the weights are the same on every run.  Scoring covers all rows, whole
texts of any length, in one pass without a shuffle.

A sample with fewer than ``MIN_CLASS`` rows of either label teaches nothing:
without a usable model every score is practically 0 and no text is toxic.  With
one, a text none of whose features has a weight gives no evidence, and its score
is at most ``NO_EVIDENCE`` whatever share of the sample is toxic.

Defined results: a row with a NULL id is not held out and has no label; of
several labels of one id the larger counts, of several texts the smallest; NULL
and empty texts have no features; repeated rows each get their own score; an
empty, tiny or one-sided label table is no usable model; an empty table of
documents gives no rows; extra columns are ignored by ``score`` and carried
along by ``keep_clean``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_batches, texts_of

BITS = 20
MAX_SAMPLE = 12_000
SAMPLE_TEXT_BYTES = 1 << 18
SAMPLE_FEATURES = 100_000_000  # of 4 bytes each, held by the learning task
MIN_CLASS = 10                 # sampled rows of each label that a model needs
NO_EVIDENCE = 0.1
NO_MODEL = (-35.0, {})         # a bias that no score survives
# The settings below are chosen on an inner split of the rows that may be
# learnt from (ids of remainder 0 and 1 against 3), see the README.
MIN_ROWS = 5        # a feature of fewer sampled rows is not learnt
EPOCHS = 8
ALPHA, BETA, L1, L2 = 4.0, 1.0, 8.0, 1.0
THRESHOLD = 0.3
CACHE_ENTRIES = 100_000

_EDGES = re.compile(r"^\W+|\W+$")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= CACHE_ENTRIES:
            self.clear()
        h = xxhash.xxh64_intdigest(_EDGES.sub("", word).encode(), seed=0)
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = _Hashes()


def features(text: str) -> np.ndarray:
    """Sorted distinct feature numbers below ``2 ** BITS``."""
    words = text.lower().split()
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    shift = np.uint64(64 - BITS)
    grams = [h * _MIX >> shift]
    if len(h) > 1:
        grams.append((h[:-1] * np.uint64(3) + h[1:]) * _MIX >> shift)
    if len(h) > 2:
        grams.append((h[:-2] * np.uint64(5) + h[2:]) * _MIX >> shift)
    return np.unique(np.concatenate(grams)).astype(np.int32)


def fit(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[float, dict[int, float]]:
    """FTRL-proximal: the bias and the weights that are not zero.  ``rows`` is used up."""
    size = 1 << BITS
    held = np.zeros(size, np.int32)
    for x, _ in rows:
        held[x] += 1  # the features of a row are distinct
    found = held >= MIN_ROWS
    for k, (x, y) in enumerate(rows):
        rows[k] = x[found[x]], y  # in place: the sample is held once
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last coordinate is the bias, without penalty

    def weights(i: np.ndarray) -> np.ndarray:
        w = np.where(np.abs(z[i]) <= L1, 0.0, (np.sign(z[i]) * L1 - z[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))
        w[-1] = -z[size] / ((BETA + np.sqrt(n[size])) / ALPHA)
        return w

    for _ in range(epochs):
        for x, y in rows:
            i = np.append(x, size)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    used = np.append(np.flatnonzero(np.abs(z[:size]) > L1), size)
    w = weights(used)
    return float(w[-1]), dict(zip(used[:-1].tolist(), w[:-1].tolist()))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> tuple[float, dict[int, float]]:
    """Fit on at most ``max_sample`` labelled documents that are not held out."""
    small_batches(docs.sparkSession)
    known = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi").where(~held_out())
    sample = known.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(max_sample)
    # At most max_sample rows of three numbers are broadcast; an id that many
    # rows share gives one text, chosen before anything is brought together.
    short = F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_TEXT_BYTES
    found = (docs.select("doc_id", "text").where(short).join(F.broadcast(sample), "doc_id")
             .groupBy("order", "doc_id", "toxic").agg(F.min("text").alias("text")))

    @F.arrow_udf("binary")
    def extract(texts: pa.Array) -> pa.Array:
        return pa.array([features(t).tobytes() for t in texts_of(texts)], pa.binary())

    rows = found.select("order", "doc_id", "toxic", extract("text").alias("x"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, held = [], 0
        for b in batches:
            for x, y in zip(b.column(3).to_pylist(), b.column(2).to_pylist()):
                held += len(x) // 4
                if held <= SAMPLE_FEATURES:
                    sample.append((np.frombuffer(x, np.int32), int(y > 0)))
        toxic = sum(y for _, y in sample)
        if min(toxic, len(sample) - toxic) < MIN_CLASS:
            return
        bias, weights = fit(sample)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *weights], pa.int64()), pa.array([bias, *weights.values()], pa.float64())],
                                         names=["feature", "weight"])

    one = rows.repartition(1).sortWithinPartitions("order", "doc_id", "x")
    model = {r.feature: r.weight for r in map_batches(one, learn, "feature long, weight double").collect()}
    return (model.pop(-1), model) if model else NO_MODEL


def score_column(text: Column, bias: float, weights: dict[int, float], spark) -> Column:
    """Probability of the toxic class, by the broadcast non-zero weights; without any, at most ``NO_EVIDENCE``."""
    plain = min(bias, math.log(NO_EVIDENCE / (1 - NO_EVIDENCE)))
    shared = spark.sparkContext.broadcast((np.array(sorted(weights), np.int32), np.array([weights[k] for k in sorted(weights)])))

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        index, value = shared.value
        out = []
        for text in texts_of(texts):
            x = features(text) if text else np.zeros(0, np.int32)
            at = np.searchsorted(index, x)
            at[at == len(index)] = 0
            hit = index[at] == x if len(index) else np.zeros(len(x), bool)
            out.append(bias + float(value[at[hit]].sum()) if hit.any() else plain)
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(out), -35, 35))), pa.float64())

    return toxicity(text)


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    docs = docs.select("doc_id", "text")
    bias, weights = train(docs, labels)
    small_batches(docs.sparkSession)
    return docs.select("doc_id", held_out().alias("held_out"), score_column(F.col("text"), bias, weights, docs.sparkSession).alias("score")
                       ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold."""
    bias, weights = train(docs.select("doc_id", "text"), labels)
    small_batches(docs.sparkSession)
    return docs.where(score_column(F.col("text"), bias, weights, docs.sparkSession) < threshold)
