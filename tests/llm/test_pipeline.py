"""The stages on a small table, each against what it should do to its own input."""

import pytest

import corpus_pipeline as P
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_quality_rules import brute as counts
from tests.llm.test_simhash import components, plain
from tests.llm.test_substring_dedup import brute as repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = P.read(spark, SF, "documents")
    out = [docs]
    for name, f in P.STAGES:
        out.append(P.written(f(spark, out[-1], SF), name))
    return [sorted(d.collect(), key=lambda r: r.doc_id) for d in out], out


def test_columns(stages):
    _, frames = stages
    for d in frames[1:-1]:
        assert d.schema == frames[0].schema
    assert frames[-1].columns[:5] == frames[0].columns


def test_quality(stages):
    before, after = stages[0][0], {r.doc_id for r in stages[0][1]}
    for r in before:
        n, chars, symbols, dup, rep = counts(r.text)
        if n < 50 or 2 * rep > n:
            assert r.doc_id not in after
        elif not symbols and not dup and sum("A" <= c <= "Z" for c in r.text) < 0.3 * chars:
            assert r.doc_id in after


def test_near_dedup(stages):
    before = [(r.doc_id, plain(r.text)) for r in stages[0][1]]
    assert [r.doc_id for r in stages[0][2]] == sorted(set(components(before)))


def test_substring_dedup(stages):
    want = {i: (n - gone) for i, n, gone, _ in repeats([(r.doc_id, r.text) for r in stages[0][2]], 20)}
    assert {r.doc_id: len(r.text.split()) for r in stages[0][3]} == want
    assert all(r.n_chars == len(r.text) for r in stages[0][3])


def test_decontamination(spark, stages):
    items = [tuple(r) for r in P.read(spark, SF, "benchmark").select("item_id", "text").collect()]
    want = sorted(i for i, _, n, _ in contaminated([(r.doc_id, r.text) for r in stages[0][3]], items, 10) if not n)
    assert [r.doc_id for r in stages[0][4]] == want


def test_mixing(stages):
    rows = stages[0][5]
    assert {r.doc_id for r in rows} <= {r.doc_id for r in stages[0][4]} and all(0 < r.taken <= 3 * r.size for r in rows)
    by: dict = {}
    for r in rows:
        by.setdefault(r.source, [0, r.target])[0] += r.taken
    for taken, target in by.values():
        assert taken == round(target)
    order = [r.position for r in stages[1][5].collect()]
    assert len(order) == len(rows)
