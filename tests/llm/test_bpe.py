"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tidepool.llm import bpe as B
from tidepool.llm.queries import QUERIES


@pytest.fixture(scope="module")
def ranks():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary.load(P.path("byte_bpe_50k.tiktoken"))


def digest(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 300, 20_000])
def test_hash_is_perfect_and_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
    shift, slot = B.perfect_hash(keys)
    assert sorted(slot) == list(range(len(keys)))
    mine = shift[(keys % np.uint64(len(shift))).astype(np.int64)]
    again = np.where(mine < 0, -1 - mine, B.displaced(keys, np.maximum(mine, 0), len(keys)))
    assert (again == slot).all()


def test_every_token_is_found_whole(vocabulary, ranks):
    tokens = list(ranks)
    ends = np.cumsum([len(t) for t in tokens])
    data = np.frombuffer(b"".join(tokens), np.uint8)
    got = vocabulary.whole(data, ends - [len(t) for t in tokens], ends)
    assert got.tolist() == list(ranks.values())
    other = np.frombuffer(b"zqxjkvzq", np.uint8)
    assert vocabulary.whole(other, np.array([0]), np.array([8])).tolist() == [-1]


def test_merges_equal_the_library(vocabulary, reference):
    rng = random.Random(0)
    for _ in range(3000):
        piece = bytes(rng.choice(b"abcdeeeeinorst\xc3\xa9\xe2\x82") for _ in range(rng.randint(1, 40)))
        assert vocabulary.merge(piece) == reference._encode_single_piece(piece)
    for piece in (b"a" * 5000, b"ab" * 3000, bytes(range(256)) * 8):
        assert vocabulary.merge(piece) == reference._encode_single_piece(piece)


def test_texts_equal_the_library(vocabulary, reference):
    run, rng = vocabulary.encoder(), random.Random(1)
    some = ["'s", "'ll", "'", "''", " ", "  ", "\n", "\t", "\x1c", " ", "　", "a", "Z", "é", "ß", "漢字", "1", "٣", "²", "!", "…", "🙂", "́", "the", " quick", "�", "\x00"]
    for _ in range(2000):
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 30)))
        _, ids = run(["", text])
        assert ids.tolist() == reference.encode_ordinary(text)
        assert vocabulary.text(ids) == text.encode()


def test_blocks_and_memory_do_not_change_ids(vocabulary, reference, monkeypatch):
    text = "Wörter und so weiter, " * 400 + "x" * 900 + " end 12345"
    want = reference.encode_ordinary(text)
    monkeypatch.setattr(B, "BLOCK", 64)
    monkeypatch.setattr(B, "REMEMBERED", 2)
    before, ids, after = vocabulary.encoder()([text[:90], text, ""])
    assert before.tolist() == reference.encode_ordinary(text[:90]) and not len(after)
    assert ids.tolist() == want and vocabulary.text(ids) == text.encode()


def test_rows(spark, docs_of, vocabulary, reference):
    long = "word " * 60_000 + "y" * 200_000
    texts = [(1, "a b"), (1, "a b"), (2, None), (None, "x"), (3, ""), (4, long), (5, "<|endoftext|>")]
    rows = B.encode(docs_of([(*t, "s", "ride") for t in texts], "ids string"), vocabulary)
    back = B.decode(rows, vocabulary, carry=("*",)).collect()
    assert len(back) == len(texts)
    for r in back:
        text = r.row.row.text or ""
        assert bytes(r.decoded) == text.encode() and r.row.row.ids == "ride"
        assert np.frombuffer(r.row.ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert B.encode(docs_of([]), vocabulary).collect() == []
    assert [bytes(r.decoded) for r in B.decode(spark.createDataFrame([(None,)], "ids binary"), vocabulary).collect()] == [b""]


def test_vocabularies_that_cannot_be_used(ranks, tmp_path, vocabulary):
    with pytest.raises(ValueError, match="256"):
        B.Vocabulary({b"a": 0})
    with pytest.raises(ValueError, match="distinct"):
        B.Vocabulary({**ranks, b"zzzzqqqq": 0})
    with pytest.raises(ValueError, match="not in the vocabulary"):
        B.Vocabulary({bytes([i]): 2 * i for i in range(256)}).text(np.array([4, 5], "<u4"))


def test_other_pattern_and_rank_file(spark, tmp_path, ranks):
    few = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"abc": 301, b" a": 302}
    file = tmp_path / "few.tiktoken"
    file.write_bytes(b"".join(base64.b64encode(k) + b" %d\n" % v for k, v in few.items()))
    v = B.Vocabulary.load(f"file://{file}", r"\w+", spark)
    want = tiktoken.Encoding("few", pat_str=r"\w+", mergeable_ranks=few, special_tokens={})
    texts = ["abc ab!abcab", "", " a a", "é é", "!"]  # what no pre-token covers has no ids
    assert [ids.tolist() for ids in v.encoder()(texts)] == [want.encode_ordinary(t) for t in texts]
    assert [ids.tolist() for ids in B.Vocabulary(few, r"(\w)+").encoder()(texts)] == [want.encode_ordinary(t) for t in texts]


def test_query_equals_the_library(spark, reference):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op13_byte_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), digest(np.array(ids, "<u4").tobytes()), digest(texts[r.doc_id].encode()))
