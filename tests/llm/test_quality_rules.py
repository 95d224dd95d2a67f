import re

from tidepool.llm import quality_rules as Q
from tests.llm.harness import matches

SPACE = r"[^\x20\x09-\x0D]+"


def brute(text):
    t = text or ""
    w = re.findall(SPACE, t)
    lines = [x for x in t.split("\n") if re.search(SPACE, x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


CLEAN = " ".join(f"wörd{i}" for i in range(80))
TEXTS = [None, "", " \n\t", "a b c a b c", "é " * 70, CLEAN, CLEAN.upper(), CLEAN + " ###" * 30, (CLEAN[:30] + "\n") * 30,
         "x y z\n" * 3 + CLEAN, "a b c d " * 3, CLEAN, "w" * 3000 + " " + CLEAN]


def test_counts_equal_brute_force(docs_of):
    df = docs_of([(i, t) for i, t in enumerate(TEXTS)] + [(None, CLEAN)])
    rows = Q.quality_report(df).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        if r.doc_id is not None:
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert got == brute(TEXTS[r.doc_id]), r.doc_id
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
        assert not (r.kept and r.base_failed)


def test_filter_equals_report_and_keeps_columns(docs_of):
    df = docs_of([(i, t, "s", i) for i, t in enumerate(TEXTS)], "words int")
    kept = Q.quality_filter(df)
    assert kept.columns == df.columns
    report = {r.doc_id for r in Q.quality_report(df).filter("kept").collect()}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == report == {r.words for r in rows} and report >= {5, 9, 11}
    assert Q.quality_filter(docs_of([])).collect() == [] and Q.quality_report(docs_of([])).collect() == []


def test_order_by_rejections_per_cost():
    a, b, c = (Q.Rule(n, "true", ()) for n in "abc")
    order = Q.ordered([{"rule": a, "cost": 4.0, "rejects": 0.5}, {"rule": b, "cost": 1.0, "rejects": 0.4}, {"rule": c, "cost": 1.0, "rejects": 0.0}])
    assert [r.name for r in order] == ["b", "a", "c"]


def test_plan_is_native(docs_of):
    plan = Q.quality_filter(docs_of([(1, CLEAN)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark):
    assert matches(spark, "op2_quality_rules", "/root/testdata/sf0.001")
