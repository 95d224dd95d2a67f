import numpy as np
import pyarrow as pa
import pytest

from tidepool.llm import classifier as C
from tidepool.llm import words as W
from tidepool.llm.queries import QUERIES


def test_features_match_scoring():
    """A row's score is the average of its features' weights, whatever slice it is read in."""
    texts = ["the cat the cat the cat", "", "Ünder | | |", "a", "the dog"]
    weights = np.random.default_rng(0).normal(size=C.BUCKETS).astype(np.float32)
    rows = [f for part in W.slices(pa.array(texts)) for f in C.features(part)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    got = next(C._score(weights, 0.25)([batch])).column(1).to_pylist()
    for (buckets, counts), s in zip(rows, got):
        z = (weights[buckets] @ counts / counts.sum() if len(buckets) else 0) + 0.25
        assert s == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-5)


def test_learns_on_nulls_ties_and_copies(spark, docs_of):
    good = [(i, f"plain words number {i} and more of the same kind {i * 7}") for i in range(60)]
    bad = [(100 + i, f"BUY!! ### {i} NOW!! ### $$$ {i}") for i in range(60)]
    docs = docs_of(good + bad + [(400, None), (401, ""), (None, "no id"), (3, good[3][1])])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(3, None, 0), (None, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    model = C.fit(docs, labels)
    rows = C.score(docs, model).collect()
    assert len(rows) == 124
    scores = {r.doc_id: r.score for r in rows}
    assert min(scores[i] for i, _ in good) > 0.7 > 0.3 > max(scores[i] for i, _ in bad)
    assert scores[400] == scores[401] and all(0 <= s <= 1 for s in scores.values())
    again = C.fit(docs.repartition(7), labels.repartition(3))
    assert (again[0] == model[0]).all() and again[1] == model[1]


def test_no_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in C.score(docs_of([(1, "x")]), C.fit(docs_of([(1, "x")]), none)).collect()] == [0.5]
    assert C.score(docs_of([]), C.fit(docs_of([]), none)).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op6_quality_classifier"](spark, sf)
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    assert scored.count() == 1000


def test_one_training_text_an_id(spark, docs_of):
    docs = docs_of([(1, f"copy {i}") for i in range(50)] + [(2, "other"), (3, None), (3, None)])
    sample = spark.createDataFrame([(1, 1, 11), (2, 0, 12), (3, 0, 13)], "doc_id long, label int, key long")
    rows = sorted(map(tuple, C.training_texts(docs, sample).collect()))
    assert [(r[0], r[1]) for r in rows] == [(11, 1), (12, 0), (13, 0)] and rows[0][2].startswith("copy") and rows[2][2] is None
    assert rows == sorted(map(tuple, C.training_texts(docs.repartition(7), sample).collect()))
