import hashlib
import random

from tidepool.llm import words as W
from tidepool.llm.substring_dedup import remove_repeats
from tests.llm.harness import matches


def brute(rows, k):
    seen: dict = {}
    for key, (i, text) in enumerate(rows):
        w = (text or "").split()
        for p in range(len(w) - k + 1):
            seen.setdefault(tuple(w[p:p + k]), []).append((i, key, p))
    out = []
    for key, (i, text) in enumerate(rows):
        w = (text or "").split()
        gone = set()
        for p in range(len(w) - k + 1):
            if any((j is not None and (i is None or j < i)) or (o == key and q < p) for j, o, q in seen[tuple(w[p:p + k])]):
                gone |= set(range(p, p + k))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def random_rows(rng, n, vocab, longest):
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, longest)))) for i in range(n)]
    for _ in range(n // 3):  # near copies and copies
        i, j = rng.randrange(n), rng.randrange(n)
        w = rows[i][1].split()
        if w and rng.random() < 0.7:
            w[rng.randrange(len(w))] = "odd"
        rows[j] = (j, "\n".join(w))
    return rows


def test_equals_brute_force(spark, docs_of, monkeypatch):
    rng = random.Random(5)
    for size in (2 << 20, 200):
        monkeypatch.setattr(W.slices, "__defaults__", (W.NOT_SPACE, False, size))
        rows = random_rows(rng, 60, "a b c é".split(), 60) + random_rows(rng, 10, ["x"], 30)
        rows = [(n, t) for n, (_, t) in enumerate(rows)] + [(None, rows[0][1]), (None, rows[3][1]), (3, rows[3][1]), (500, None), (501, "")]
        got = remove_repeats(docs_of(rows).repartition(3), k=6, s=3)
        got = sorted(((r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str)
        assert got == brute(rows, 6)


def test_text_without_spans_and_extra_columns(docs_of):
    text = "one two three four\nfive  six seven"
    got = {r.row.doc_id: r for r in remove_repeats(docs_of([(1, text, "s", 1), (2, "zero " + text + "\nend", "s", 2)], "covered int"), k=4, s=2).collect()}
    assert got[1].kept_text == text and got[2].kept_text == "zero end" and got[2].row.covered == 2


def test_empty_table(docs_of):
    assert remove_repeats(docs_of([])).collect() == []


def test_query(spark):
    assert matches(spark, "op4_substring_dedup", "/root/testdata/sf0.001")
