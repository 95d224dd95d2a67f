import random
import re

from tidepool.llm import decontaminate as D
from tests.llm.harness import matches

WORDS = re.compile("[0-9a-z\u0080-\U0010ffff]+")


def words(t):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, size):
    out = []
    wins = [(i, tuple(w[p:p + min(size, len(w))])) for i, t in items if (w := words(t)) for p in range(max(1, len(w) - size + 1))]
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, g in wins:
            for p in range(len(w) - len(g) + 1):
                if tuple(w[p:p + len(g)]) == g:
                    hit |= set(range(p, p + len(g)))
                    found |= {str(item)} - {"None"}
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    vocab = "a b É The c-d x9".split()
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 9)))) for i in range(12)] + [(10, "a b É"), (None, "b b b b b"), (40, None)]
    docs = [(i, rng.choice(", |\n| ".split("|")).join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    docs += [(3, docs[5][1]), (None, docs[6][1]), (77, None), (78, ""), (5, docs[5][1])]
    return docs, items


def test_equals_brute_force(spark, docs_of, monkeypatch):
    docs, items = case(1)
    table = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 5)
    index = D.build_index(docs_of(docs).repartition(3))
    for block, chunk in ((200_000, 1 << 19), (5, 3)):
        monkeypatch.setattr(D, "BLOCK_WORDS", block)
        monkeypatch.setattr(D, "CANDIDATES", chunk)
        got = sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in D.contamination(index, table, 5).collect()), key=str)
        assert got == want


def test_proximity(spark, docs_of):
    docs = docs_of([(1, "one x two y three"), (2, "three two one"), (3, "one two a b c d e f g three"), (4, "one two"), (5, "three")])
    items = spark.createDataFrame([(1, "One, two three")], "item_id long, text string")
    got = {r.id for r in D.contamination(D.build_index(docs), items, 3, near=4).filter("n_hit > 0").collect()}
    assert got == {1, 2}


def test_decontaminate_keeps_columns(spark, docs_of):
    docs, items = case(2)
    df = docs_of([(*d, "s", 1) for d in docs], "segment int")
    kept = D.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"), 5)
    assert kept.columns == df.columns
    want = [i for i, _, n, _ in brute(docs, items, 5) if not n]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[2:4] for r in D.contamination(D.build_index(docs_of([(1, "a b c")])), none).collect()] == [(3, 0)]
    assert D.decontaminate(docs_of([]), none).collect() == []


def test_query(spark):
    assert matches(spark, "op5_decontamination", "/root/testdata/sf0.001")
