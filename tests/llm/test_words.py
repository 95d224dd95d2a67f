"""Words are told apart by their bytes, whatever pattern they are built from."""

import numpy as np
import pyarrow as pa
import pytest

from tidepool.llm import words as W
from tidepool.llm.decontaminate import build_index, contamination
from tidepool.llm.substring_dedup import remove_repeats


def doubling(a: str, b: str, n: int = 10) -> str:
    """0110 1001 ...: a pattern of 2 ** n letters on which polynomial hashes modulo a power of two fail."""
    out = "0"
    for _ in range(n):
        out += out.translate({48: 49, 49: 48})
    return out.replace("0", a).replace("1", b)


X, Y = doubling("a", "b"), doubling("b", "a")


def hashes(texts, **options):
    return [h for part in W.slices(pa.array(texts, pa.string()), **options) for h in part.hash.tolist()]


def test_patterns_have_different_hashes():
    for n in range(1, 13):
        x, y = hashes([doubling("a", "b", n) + " " + doubling("b", "a", n)])
        assert x != y
    rng = np.random.default_rng(0)
    words = sorted({"".join(rng.choice(list("ab\x01é"), rng.integers(1, 90))) for _ in range(20_000)})
    assert len(set(hashes([" ".join(words)]))) == len(words)
    assert len(set(hashes(["a", "a\x00", "a\x00\x00", "\x00", "\x00\x00"]))) == 5


def test_a_word_has_one_hash_wherever_it_stands():
    for word in ("a", "eightby8", "ninebytes9", "x" * 64, "x" * 65, "é" * 40, X):
        got = hashes([word, f"the {word}", f"{word} {'y' * 9} {word}"])
        assert len({got[0], got[2], got[3], got[5]}) == 1
    assert hashes(["The CAT É"], in_word=W.ALNUM, fold=True) == hashes(["the cat É"], in_word=W.ALNUM, fold=True)
    assert hashes(["The"]) != hashes(["the"])


def test_other_words_of_one_pattern_are_no_repeat(spark, docs_of):
    def text(middle):
        return " ".join([f"w{i}" for i in range(10)] + [middle] + [f"v{i}" for i in range(10)])

    docs = docs_of([(1, text(X)), (2, text(Y)), (3, text(X))])
    assert sorted((r.row.doc_id, r.n_removed) for r in remove_repeats(docs).collect()) == [(1, 0), (2, 0), (3, 21)]
    item = spark.createDataFrame([("i1", " ".join(["q"] * 4 + [X] + ["r"] * 5))], "item_id string, text string")
    docs = docs_of([(1, " ".join(["q"] * 4 + [X] + ["r"] * 5)), (2, " ".join(["q"] * 4 + [Y] + ["r"] * 5))])
    got = sorted((r.id, r.n_hit, tuple(r["items"])) for r in contamination(build_index(docs), item).collect())
    assert got == [(1, 10, ("i1",)), (2, 0, ())]


@pytest.mark.parametrize("texts", [[], [None], ["", " "], ["x"]])
def test_small_inputs(texts):
    assert len(hashes(texts)) == sum(bool(t and t.strip()) for t in texts)
