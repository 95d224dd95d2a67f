import random

import pytest

from tidepool.llm import mixing as M
from tests.llm.harness import matches


def shares(sizes, weights, passes=3):
    """Targets by resharing the excess again and again."""
    total, left = sum(sizes), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while left:
        pool = total - sum(out[i] for i in range(len(sizes)) if i not in left)
        give = {i: pool * weights[i] / sum(weights[j] for j in left) for i in left}
        over = {i for i in left if give[i] > passes * sizes[i]}
        if not over:
            for i in left:
                out[i] = give[i]
            break
        for i in over:
            out[i] = passes * sizes[i]
        left -= over
    return out


def test_targets_equal_resharing(spark):
    rng = random.Random(2)
    for _ in range(4):
        sizes = [rng.choice([0, 1, 5, 40, 900]) for _ in range(rng.randint(1, 9))]
        names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
        rows = {r.source: r.target for r in M.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()}
        want = shares(sizes, [1 + i % 3 for i in range(len(sizes))])
        assert [rows[n] for n in names] == pytest.approx(want)


def test_mix(docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(0, 40)), rng.choice(["b", "a", None, "é"])) for i in range(300)]
    rows += [(7, "same text", "a"), (7, "same text", "a"), (None, "no id", "b"), (900, None, "a"), (901, " \n ", "zz")]
    df = docs_of([(*r, 1) for r in rows], "size int")
    out = M.mix(df).collect()
    assert len(out) == len(rows)
    by: dict = {}
    for r in out:
        assert r.size == len((r.row.text or "").split()) and 0 <= r.taken <= 3 * r.size and r.row.size == 1
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
        x = by.setdefault(r.row.source, [0, 0, r.target, r.source_size])
        x[0] += r.taken
        x[1] += r.size
    for taken, size, target, source_size in by.values():
        assert taken == round(target) and size == source_size
    assert sorted(M.mix(df.repartition(5)).collect(), key=str) == sorted(out, key=str)
    got = [r.position for r in M.curriculum(df).collect()]
    assert got == sorted(got) and len(got) == sum(r.taken > 0 for r in out)
    assert M.mix(docs_of([])).collect() == [] and M.curriculum(docs_of([])).collect() == []


def test_inverse_of_integral(spark):
    knots = ((0.0, 0.0), (0.25, 2.0), (0.5, 2.0), (1.0, 0.5))
    for share in (0.0, 0.1, 0.33, 0.5, 0.77, 0.999):
        t = spark.range(1).select(M._inverse(knots, M.F.lit(share)).alias("t")).first().t
        done = sum((min(t, t1) - t0) * (w0 + (w0 + (w1 - w0) * (min(t, t1) - t0) / (t1 - t0))) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]) if t > t0)
        assert done == pytest.approx(share * M.integral(knots), abs=1e-9)


def test_query(spark):
    assert matches(spark, "op10_source_mixing", "/root/testdata/sf0.001")


def test_all_passes(spark, docs_of):
    # A small source at its cap of three passes beside a large one; a flat schedule.
    flat = (((0.0, 1.0), (1.0, 1.0)),)
    df = docs_of([(i, "w " * 10, "small") for i in range(10)] + [(100 + i, "w " * 10, "big") for i in range(90)])
    rows = M.training_passes(df, schedules=flat).collect()
    by: dict = {}
    for r in rows:
        by.setdefault(r.row.source, []).append(r)
    whole = {r.row.doc_id: r for r in M.mix(df, schedules=flat).collect()}
    for source, got in by.items():
        assert sum(r.words for r in got) == round(got[0].target)
        assert [r.position for r in got] == pytest.approx([10 * i / got[0].target for i in range(len(got))])
    small = by["small"]
    assert len(small) == 30 and max(r.position for r in small) > 0.9 and {r["pass"] for r in small} == {0, 1, 2}
    for i, r in whole.items():
        own = [x for x in rows if x.row.doc_id == i]
        assert sum(x.words for x in own) == r.taken and [x.position for x in own] == [p.position for p in r.passes or ()]
    assert M.training_passes(docs_of([])).collect() == []


def test_passes_query(spark):
    assert matches(spark, "op10_training_passes", "/root/testdata/sf0.001")
