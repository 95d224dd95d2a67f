"""Quality classifier with supervised subword embeddings.

A text's features are its words, the character n-grams of each word, and a
marker for every pair of words that the text has had before, all hashed into a
table of learned vectors. The text's vector is the average of its features'
vectors; a softmax layer turns it into class probabilities. Vectors and layer
are trained together by stochastic gradient descent in numpy.

Training reads a bounded sample (``TRAIN_ROWS`` labelled rows, chosen by a hash
of the id) in one task; the model is a table of fixed size. Scoring reads every
whole text, each distinct word of a slice once.

Defined results: a null or empty text has no features and gets the score of the
layer's bias. Rows without a label, or with a null id, are never trained on; of
several labels of one id the smallest counts. Without any training row every
score is 0.5. Repeated rows get equal scores; extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import words as W
from tidepool.llm.common import query, read

#: Most rows that training reads.
TRAIN_ROWS = 4000
BUCKETS, DIM, EPOCHS, RATE = 1 << 17, 8, 8, 2.0
NGRAMS = (3, 4)
THRESHOLD = 0.7
MARKER = np.uint64(0x5EEDED)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def _ngrams(part: W.Slice, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of the words that begin at ``first`` (word numbers), with
    each n-gram's word (counted within ``first``). A word's edges count as characters."""
    data = part.data.tobytes()
    joined = b"\n" + b"\n".join([data[a:b] for a, b in zip(part.start[first].tolist(), part.end[first].tolist())]) + b"\n"
    chars = np.frombuffer(joined.decode(errors="replace").encode("utf-32-le"), np.uint32)
    edge = chars == 10
    word = np.cumsum(edge) - 1
    codes = W.mix(chars.astype(np.uint64) + np.uint64(77))
    out, of = [], []
    for n in NGRAMS:
        m = len(chars) - n + 1
        if m <= 0 or not len(first):
            continue
        value = np.full(m, n, np.uint64)
        inner = np.zeros(m, bool)
        for j in range(n):
            value = value * np.uint64(0x100000001B3) + codes[j:j + m]
            if 0 < j < n - 1:
                inner |= edge[j:j + m]
        at = np.flatnonzero(~inner)
        at = at[word[at] < len(first)]
        out.append(_bucket(W.mix(value[at])))
        of.append(word[at])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(of)


def _again(part: W.Slice) -> np.ndarray:
    """Per row: how many of its word pairs it has had before."""
    pairs = np.flatnonzero(part.row[1:] == part.row[:-1]) if len(part.row) else part.row
    keys = W.mix(part.hash[pairs] * np.uint64(31) + part.hash[pairs + 1]) if len(pairs) else part.hash
    keys = keys + part.row[pairs].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, first = np.unique(keys, return_index=True)
    return np.bincount(part.row[pairs], minlength=part.n) - np.bincount(part.row[pairs][first], minlength=part.n)


def features(part: W.Slice) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and counts of every row's features."""
    again, out = _again(part), []
    for r in range(part.n):
        lo, hi = part.bound[r], part.bound[r + 1]
        words, first, count = np.unique(part.hash[lo:hi], return_index=True, return_counts=True)
        grams, of = _ngrams(part, first + lo)
        buckets = np.concatenate([_bucket(words), grams, _bucket(W.mix(np.array([MARKER])))])
        counts = np.concatenate([count, count[of], [again[r]]])
        found, at = np.unique(buckets, return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(found))
        out.append((found[total > 0], total[total > 0]))
    return out


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE,
          seed: int = 0) -> tuple[np.ndarray, float]:
    """Learns vectors and softmax layer; returns what scoring needs: per bucket the difference of
    the two classes' logits that its vector makes, and the bias' difference."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            buckets, counts = rows[i]
            step = np.float32(rate * (1 - done / steps))
            done += 1
            if not len(buckets):
                continue
            share = (counts / counts.sum()).astype(np.float32)
            mean = share @ vectors[buckets]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            vectors[buckets] -= step * np.outer(share, layer @ p)
            layer -= step * np.outer(mean, p)
            bias -= step * p * np.float32(0.1)
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = []
    for batch in batches:
        keys, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for part in W.slices(batch.column(2)):
            found += [(keys[part.first + r], labels[part.first + r], *x) for r, x in enumerate(features(part))]
    # The order of rows must not depend on how Spark dealt them.
    found.sort(key=lambda x: x[0])
    if not found:
        return
    weights, bias = train([x[2:] for x in found], np.array([x[1] for x in found]))
    yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([bias])], names=["weights", "bias"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """key, label and one text for each document of ``sample`` (doc_id, label, key): of several the one with the least hash."""
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = found.groupBy("key", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    return found.select("key", "label", "one.text")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """The model, trained on at most ``rows`` labelled rows that are not held out."""
    sample = (labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
              .groupBy("doc_id").agg(F.min(label_col).cast("int").alias("label"))
              .withColumn("key", F.xxhash64("doc_id")).orderBy("key").limit(rows))
    # The limit bounds this side's size.
    texts = training_texts(docs, sample)
    model = texts.repartition(1).mapInArrow(_train, "weights binary, bias double").collect()
    if not model:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(bytes(model[0].weights), np.float32), model[0].bias


def _score(weights: np.ndarray, bias: float):
    marker = weights[_bucket(W.mix(np.array([MARKER])))][0]

    def run(batches):
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for part in W.slices(batch.column(1)):
                words, first, at = np.unique(part.hash, return_index=True, return_inverse=True)
                grams, of = _ngrams(part, first)
                sums = weights[_bucket(words)] + np.bincount(of, weights=weights[grams], minlength=len(words))
                n = 1 + np.bincount(of, minlength=len(words))
                again = _again(part)
                total = np.bincount(part.row, weights=sums[at], minlength=part.n) + again * float(marker)
                count = np.bincount(part.row, weights=n[at], minlength=part.n) + again
                scores[part.first:part.first + part.n] = 1 / (1 + np.exp(-(total / np.maximum(count, 1) + bias)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id and score (the probability of label 1) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(*model), "doc_id long, score double")


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trains on labelled rows that are not held out and scores every document."""
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels"))).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
