"""Importance resampling against a plain reading of its definition."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidepool.llm import importance as I
from tidepool.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def buckets(text, n_max=3, n=10_000):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % n for k in range(1, n_max + 1) for i in range(len(w) - k + 1)]


def brute(raw, target, percent=5, min_words=20, n=10_000):
    """(doc_id, n_features, weight, score, rank) of rows (doc_id, text) without repeated ids."""
    s, t = Counter(b for _, x in raw for b in buckets(x, n=n)), Counter(b for x in target for b in buckets(x, n=n))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (total_s + n)) / ((s[b] + 1) * (total_t + n)))) for b in range(n)]
    rows = []
    for i, x in raw:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        f = buckets(x, n=n)
        weight = sum(gain[b] for b in f)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x)) >= min_words))
    ranked = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {r[0]: k + 1 for k, r in enumerate(ranked[:percent * len(ranked) // 100])}
    return sorted(((*r[:4], rank.get(r[0]) if r[4] else None) for r in rows), key=str)


@pytest.mark.parametrize("text", ["", " .. ", "One", "one, two", "a b c d e a b c", "ÄÖ İx ſ K9\x00\x7fz É é -- 'quoted' _under_", "漢字 と かな 🙂 x\n\ny\t", "x" * 3000 + " y"])
@pytest.mark.parametrize("n_max", [1, 2, 3, 5])
@pytest.mark.parametrize("block", [1, 3, 1 << 15])
def test_features(text, n_max, block, monkeypatch):
    monkeypatch.setattr(I, "BLOCK", block)
    n, found = I.features(text, I.scanner(n_max), 10_000)
    assert n == len(words(text)) and sorted(found.tolist()) == sorted(buckets(text, n_max))


def rows_of(df, id_name="doc_id"):
    return sorted(((r.row[id_name], r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=str)


def test_equals_brute_force(spark, docs_of):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünder", "the", "THE"]
    raw = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(400)]
    raw += [(1000, None), (1001, ""), (None, "the " * 30), (1002, "long " * 90_000), (1003, raw[7][1])]
    target = [" ".join(rng.choice(vocabulary[:20], 15)) for _ in range(30)] + [None, ""]
    bench = spark.createDataFrame([(x, i) for i, x in enumerate(target)], "text string, item_id int")
    for docs in (docs_of(raw), docs_of(raw).repartition(5)):
        assert rows_of(I.resample(docs, bench, percent=30)) == brute(raw, target, percent=30)


def test_clashing_columns_repeats_and_empty_tables(spark, docs_of):
    text = " ".join(f"t{i}" for i in range(25))
    names = "rank string, score string, row string, seq string, id string, buckets string"
    same = [(7, text, "s", *"abcdef")] * 40
    bench = spark.createDataFrame([("t1 t2",)], "text string")
    rows = I.resample(docs_of(same, names), bench, percent=50).collect()
    assert sorted(r.rank for r in rows if r.rank is not None) == list(range(1, 21)) and len(rows) == 40
    assert len({(r.weight, r.score) for r in rows}) == 1 and all(r.row["rank"] == "a" and r.row["buckets"] == "f" for r in rows)
    assert I.resample(docs_of([]), bench).collect() == []
    none = spark.createDataFrame([], "text string")
    assert rows_of(I.resample(docs_of([(1, text), (2, "x")]), none, percent=100)) == brute([(1, text), (2, "x")], [], percent=100)


def test_many_buckets(spark, docs_of):
    raw, target = [(i, f"a{i} b{i % 3} c") for i in range(30)], ["b1 c"]
    bench = spark.createDataFrame([(x,) for x in target], "text string")
    got = rows_of(I.resample(docs_of(raw), bench, n_buckets=100_000, min_words=3, percent=10))
    assert got == brute(raw, target, percent=10, min_words=3, n=100_000)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    raw = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op12_importance_resampling"](spark, sf).collect()), key=str)
    assert got == brute(raw, target)
