import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from tidepool.llm import simhash as S
from tidepool.llm.components import connected_components
from tidepool.llm.queries import QUERIES


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(pairs):
    """Smallest id reachable, by brute force; pairs of (id, fingerprint)."""
    fps = np.array([f for _, f in pairs], np.uint64)
    comp = [i for i, _ in pairs]
    left = set(range(len(pairs)))
    while left:
        todo = [left.pop()]
        group = list(todo)
        while todo:
            near = np.flatnonzero(np.bitwise_count(fps ^ fps[todo.pop()]) <= 4)
            new = left & set(near.tolist())
            left -= new
            todo += new
            group += new
        ids = [pairs[g][0] for g in group if pairs[g][0] is not None]
        for g in group:
            comp[g] = min(ids, default=None)
    return comp


def test_fingerprint():
    for t in ("", "One", "A b  c\tD", "a b c d e", "Ünder É x y z " * 9, None):
        assert S.fingerprint((t or "").encode()) == plain(t)


def test_anchors_cover():
    """Every value has an anchor within one bit, and all anchors within two are listed."""
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    keys, places = S.anchors(fps)
    for block, (shift, width) in enumerate(S.BLOCKS):
        for p, f in enumerate(fps):
            value = (int(f) >> shift) & ((1 << width) - 1)
            mine = [int(k) & 0xFFFFFFFF for k in keys[places == p] if int(k) >> 32 == block]
            apart = [(value ^ a).bit_count() for a in mine]
            assert min(apart) <= 1 and max(apart) <= 2 and len(set(mine)) == len(mine)
            for bit in range(width):
                near = np.array([f ^ np.uint64(1 << (shift + bit))], np.uint64)
                assert set(S.anchors(near)[0].tolist()) & {a | block << 32 for a in mine}


def _links(fps, monkeypatch=None):
    keys, places = S.anchors(fps)
    order = np.lexsort((fps[places], keys))
    batch = pa.RecordBatch.from_arrays([pa.array(keys[order].view(np.int64)), pa.array(fps[places][order].view(np.int64))], names=["key", "fp"])
    out = list(S._compare(4)(batch.slice(i, 501) for i in range(0, len(batch), 501)))
    return [(u.as_py(), v.as_py()) for b in out for u, v in zip(b.column(0), b.column(1))]


def test_links_equal_brute_force(monkeypatch):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(900):
        f = rng.choice(fps)
        for _ in range(rng.randint(1, 6)):
            f ^= 1 << rng.randrange(64)
        fps.append(f)
    fps = np.unique(np.array(fps, np.uint64))
    want = components([(i, int(f)) for i, f in enumerate(fps)])
    for small, large in ((64, 4096), (2, 5)):
        monkeypatch.setattr(S, "SMALL", small)
        monkeypatch.setattr(S, "LARGE", large)
        place = {int(f.view(np.int64)): i for i, f in enumerate(fps)}
        parent = list(range(len(fps)))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for u, v in _links(fps):
            a, b = sorted((root(place[u]), root(place[v])))
            parent[b] = a
        assert [root(i) for i in range(len(fps))] == want


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(i, i) == 0 for i in range(41)) and all(got.get(100 + i, 100 + i) == 100 for i in range(30))
    for u, v in edges:
        assert got.get(u, u) == got.get(v, v)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows(docs_of):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base + " more"), (9, None), (2, ""), (8, "other words here now"), (None, base), (8, "other words here now"), (None, "x y z"), (4, " \n")]
    df = docs_of([(*r, "s", 1) if len(r) == 2 else r for r in rows], "fp int")
    got = sorted(((r.id, r.component) for r in S.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 2), (2, 2), (8, 8), (None, 3), (8, 8), (None, None), (4, 2)], key=str)
    kept = S.deduplicate(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 8, None]
    assert S.near_duplicates(docs_of([])).collect() == [] and S.deduplicate(docs_of([])).collect() == []


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, plain(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (f"{f:016x}", c) for (i, f), c in zip(docs, components(docs))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash_dedup"](spark, sf).collect()} == want
