"""Byte-level BPE: texts to token ids and back, through a two-tier lookup.

1. A text is split by the vocabulary's pattern into pre-tokens. A minimal
   perfect hash maps every pre-token to the one slot of the vocabulary that
   could hold it; where the slot's bytes are the pre-token's, its id is the
   answer. This is done for all pre-tokens of a block at once, with numpy.
2. The others are merged: their bytes form a linked list, a heap holds the rank
   of every neighbouring pair, and the least rank (of equal ones the leftmost)
   is joined until no pair is in the vocabulary.

The vocabulary (bounded by ``MAX_VOCABULARY_BYTES``) is read in the driver and
travels with the function; the rows are independent, so nothing is shuffled.

Defined cases: a null text is an empty one, and an empty text has no tokens. Long
texts are taken in blocks of ``BLOCK`` bytes, so working memory follows a block, the ids
of one text and its longest pre-token. Every row of the input is returned, repeated
ones too; its columns ride in the struct ``row``, so no name can clash. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import methodcaller

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tidepool.llm import words as W
from tidepool.llm.common import query, read

#: Larger rank files are refused: the vocabulary is sent to every task.
MAX_VOCABULARY_BYTES = 64 << 20
BLOCK = 256 << 10
#: Merged pre-tokens that a task remembers, and the longest that it does.
REMEMBERED, REMEMBERED_LENGTH = 1 << 19, 48
#: Characters of a text whose pre-tokens are held as strings at once; longer texts give their places one by one.
HELD = 1 << 20
NO_RANK = 1 << 62
#: Places of bytes, from the one before the first; slices of it start the lists of links.
PLACES = list(range(-1, 256))
#: Bytes of texts or of ids in one batch that a task hands on.
OUT_BYTES = 4 << 20


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements of a minimal perfect hash of ``keys`` (distinct 64-bit integers), and the slot of every key.

    Keys fall into buckets of about four. From the fullest bucket on, each takes the first displacement that puts
    all its keys into free slots; a bucket of one key names its slot, as ``-1 - slot``.
    """
    n = len(keys)
    n_buckets = n // 4 + 1
    order = np.argsort(keys % np.uint64(n_buckets), kind="stable")
    bound = np.searchsorted((keys % np.uint64(n_buckets))[order], np.arange(n_buckets + 1, dtype=np.uint64))
    sizes = np.diff(bound)
    shift, slot, free = np.zeros(n_buckets, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        members = order[bound[b]:bound[b + 1]]
        if len(members) < 2:
            break
        first, tries = 0, 64
        while True:
            at = displaced(keys[members][None, :], np.arange(first, first + tries)[:, None], n)
            fits = free[at].all(axis=1)
            if len(members) > 1 and fits.any():
                ranked = np.sort(at, axis=1)
                fits &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if fits.any():
                break
            first, tries = first + tries, min(tries * 2, 1 << 14)
        found = int(np.argmax(fits))
        shift[b], slot[members], free[at[found]] = first + found, at[found], False
    single = np.flatnonzero(sizes == 1)
    slot[order[bound[single]]] = np.flatnonzero(free)
    shift[single] = -1 - np.flatnonzero(free)
    return shift, slot


def displaced(keys: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    """The slots of keys under displacements."""
    return (W.mix(keys + shift.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


class Vocabulary:
    """Byte strings and their ids, which are also the ranks of the merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"byte-level BPE needs all 256 bytes; missing: {missing[:5]}")
        if min(ranks.values()) < 0 or max(ranks.values()) >= 1 << 31 or len(set(ranks.values())) < len(ranks):
            raise ValueError("ids are distinct and between 0 and 2**31 - 1")
        self.pattern, self.ranks = pattern, ranks
        pairs = np.full(1 << 16, NO_RANK, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                pairs[token[0] << 8 | token[1]] = rank
        self.pairs = pairs
        tokens = list(ranks)
        lengths = np.array([len(t) for t in tokens], np.int64)
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(tokens), np.uint8)
        keys = _hashes(data, ends - lengths, ends)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two tokens with one hash")
        self.shift, slot = perfect_hash(keys)
        by_slot = np.argsort(slot)
        self.longest = int(lengths.max())
        self.length, self.start, self.data = lengths[by_slot], (ends - lengths)[by_slot], data
        self.id = np.fromiter(ranks.values(), np.int64, len(tokens))[by_slot]
        self.slot_of = np.full(int(self.id.max()) + 1, -1, np.int64)
        self.slot_of[self.id] = np.arange(len(tokens))

    @classmethod
    def load(cls, path: str, pattern: str = public_tokenizers.PATTERN, spark: SparkSession | None = None) -> Vocabulary:
        """From a rank file: base64 bytes and rank on each line. A URI is read by Spark, a plain path by the driver."""
        if spark is not None and "://" in path:
            file = spark.read.format("binaryFile").load(path).filter(F.col("length") <= MAX_VOCABULARY_BYTES).first()
            content = bytes(file.content) if file else None
        else:
            with open(path, "rb") as f:
                content = f.read(MAX_VOCABULARY_BYTES + 1)
        if content is None or len(content) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"a rank file has at most {MAX_VOCABULARY_BYTES} bytes")
        parts = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in parts}, pattern)

    def whole(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ids of ``data[starts[i]:ends[i]]`` that are tokens, -1 for the others."""
        n = len(self.id)
        keys = _hashes(data, starts, ends)
        shift = self.shift[(keys % np.uint64(len(self.shift))).astype(np.int64)]
        slot = np.where(shift < 0, -1 - shift, displaced(keys, np.maximum(shift, 0), n))
        lengths = ends - starts
        likely = np.flatnonzero(self.length[slot] == lengths)
        # Bytes against bytes: the hash alone proves nothing.
        lengths, slot = lengths[likely], slot[likely]
        heads = np.cumsum(lengths) - lengths
        inner = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
        same = data[np.repeat(starts[likely], lengths) + inner] == self.data[np.repeat(self.start[slot], lengths) + inner]
        equal = np.logical_and.reduceat(same, heads) if len(heads) else np.zeros(0, bool)
        out = np.full(len(starts), -1, np.int64)
        out[likely[equal]] = self.id[slot[equal]]
        return out

    def pair_ranks(self, data: np.ndarray) -> np.ndarray:
        """The rank of every pair of neighbouring bytes."""
        return self.pairs[data[:-1].astype(np.int64) << 8 | data[1:]]

    def merge(self, piece: bytes, rank: list[int] | None = None, heap: list[int] | None = None) -> list[int]:
        """The ids of one pre-token: a heap of pairs over linked bytes.

        ``rank`` and ``heap``, where the caller has them: the ranks of its pairs of bytes, and those in the vocabulary
        as ``rank << 32 | place``.
        """
        n, get = len(piece), self.ranks.get
        if rank is None:
            rank = self.pair_ranks(np.frombuffer(piece, np.uint8)).tolist()
            heap = [r << 32 | i for i, r in enumerate(rank) if r != NO_RANK]
        # rank[i]: of the pair that the part at i forms with the part to its right.
        rank.append(NO_RANK)
        if n + 2 <= len(PLACES):
            right, left = PLACES[2:n + 2], PLACES[:n]
        else:
            right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            if rank[i] != top >> 32:
                continue  # one of the pair is gone, or has grown
            gone = right[i]
            rank[gone] = NO_RANK
            right[i] = after = right[gone]
            if after < n:
                left[after] = i
                rank[i] = r = get(piece[i:right[after]], NO_RANK)
                if r != NO_RANK:
                    heappush(heap, r << 32 | i)
            else:
                rank[i] = NO_RANK
            before = left[i]
            if before >= 0:
                rank[before] = r = get(piece[before:after], NO_RANK)
                if r != NO_RANK:
                    heappush(heap, r << 32 | before)
        out, i, ranks = [], 0, self.ranks
        while i < n:
            end = right[i]
            out.append(ranks[piece[i:end]])
            i = end
        return out

    def spans(self, texts: list[str], data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the pre-tokens of ``texts`` begin and end in their bytes ``data``, and how many each text has."""
        pattern, chars = regex.compile(self.pattern), sum(map(len, texts))
        starts = None
        if chars <= HELD and not pattern.groups:
            pieces = [pattern.findall(t) for t in texts]
            counts = np.array([len(p) for p in pieces])
            ends = np.cumsum(np.fromiter(map(len, chain.from_iterable(pieces)), np.int64))
            if len(ends) and ends[-1] == chars:  # nothing of a text is left out
                starts = np.append(0, ends[:-1])
        if starts is None:
            found, at = [], 0
            for t in texts:
                found.append(at + np.fromiter(chain.from_iterable(map(methodcaller("span"), pattern.finditer(t))), np.int64).reshape(-1, 2))
                found[-1] = found[-1][found[-1][:, 1] > found[-1][:, 0]]
                at += len(t)
            counts = np.array([len(f) for f in found])
            starts, ends = np.concatenate(found).T
        if len(data) > chars:
            at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            starts, ends = at[starts], at[ends]
        return starts, ends, counts

    def encoder(self):
        """A function from texts to the ids of each, with a bounded memory of merged pre-tokens."""
        known: dict[bytes, bytes] = {}

        def learn(pieces: list[bytes]) -> dict[bytes, bytes]:
            """The ids of pre-tokens that are not remembered."""
            lengths = np.array([len(p) for p in pieces])
            heads = np.cumsum(lengths) - lengths
            ranks = np.append(self.pair_ranks(np.frombuffer(b"".join(pieces), np.uint8)), NO_RANK)
            place = np.arange(len(ranks)) - np.repeat(heads, lengths)
            heap, rank = np.where(ranks == NO_RANK, NO_RANK, ranks << 32 | place).tolist(), ranks.tolist()
            new = {p: array("I", self.merge(p, rank[s:e], [x for x in heap[s:e] if x < NO_RANK])).tobytes()
                   for p, s, e in zip(pieces, heads.tolist(), (heads + lengths - 1).tolist())}
            if len(known) + len(new) > REMEMBERED:
                known.clear()
            known.update((p, ids) for p, ids in new.items() if len(p) <= REMEMBERED_LENGTH)
            return new

        def block(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The ids of consecutive pre-tokens, and how many each has."""
            base = int(starts[0])
            part, starts, ends = data[base:int(ends[-1])], starts - base, ends - base
            short = np.flatnonzero(ends - starts <= self.longest)
            ids = np.full(len(starts), -1, np.int64)
            if len(short):
                ids[short] = self.whole(part, starts[short], ends[short])
            misses = np.flatnonzero(ids < 0)
            raw = part.tobytes()
            pieces = [raw[s:e] for s, e in zip(starts[misses].tolist(), ends[misses].tolist())]
            found = list(map(known.get, pieces))
            unknown = list(dict.fromkeys(p for p, ids in zip(pieces, found) if ids is None))
            if unknown:
                new = learn(unknown)
                found = [ids or new[p] for p, ids in zip(pieces, found)]
            count = np.ones(len(starts), np.int64)
            count[misses] = np.fromiter(map(len, found), np.int64, len(found)) // 4
            out = np.repeat(ids, count)
            out[out < 0] = np.frombuffer(b"".join(found), np.uint32)
            return out.astype("<u4"), count

        def encode(texts: list[str]) -> list[np.ndarray]:
            data = np.frombuffer("".join(texts).encode(), np.uint8)
            starts, ends, counts = self.spans(texts, data)
            if not len(starts):
                return [np.zeros(0, "<u4") for _ in texts]
            out, first = [], 0
            while first < len(starts):
                last = max(int(np.searchsorted(ends, starts[first] + BLOCK, side="right")), first + 1)
                out.append(block(data, starts[first:last], ends[first:last]))
                first = last
            ids, n = np.concatenate([ids for ids, _ in out]), np.cumsum(np.concatenate([[0], *(n for _, n in out)]))
            bound = n[np.append(0, np.cumsum(counts))]
            return [ids[a:b] for a, b in zip(bound[:-1], bound[1:])]

        return encode

    def text(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        out = []
        for i in range(0, len(ids), BLOCK):
            slot = self.slot_of[ids[i:i + BLOCK]]
            if (slot < 0).any():
                raise ValueError("an id is not in the vocabulary")
            lengths = self.length[slot]
            inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            out.append(self.data[np.repeat(self.start[slot], lengths) + inner].tobytes())
        return b"".join(out)


_BASE = W.Powers(0xD6E8FEB86659FD93)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return W.spans(W.mix(np.arange(1, 257, dtype=np.uint64))[data], starts, ends, _BASE)


def _mapped(make, column: str, null):
    """Batches of (row, value) to batches of (row, result), small ones; ``make()`` turns a list of values into theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = make()
        for batch in batches:
            values, first, held, out, size, waiting = batch.column(1), 0, [], [], 0, 0
            for i in range(batch.num_rows):
                value = values[i].as_py()
                held.append(null if value is None else value)
                waiting += len(held[-1])
                if waiting >= BLOCK or i == batch.num_rows - 1:
                    out += convert(held)
                    size, held, waiting = size + waiting, [], 0
                    if size >= OUT_BYTES or i == batch.num_rows - 1:
                        yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(out)), pa.array(out, pa.binary())], names=["row", column])
                        first, out, size = i + 1, [], 0

    return run


def _apply(rows: DataFrame, make, value, column: str, carry: tuple[str, ...], null) -> DataFrame:
    rows = rows.select(F.struct(*carry).alias("row"), value)
    return rows.mapInArrow(_mapped(make, column, null), StructType([rows.schema["row"], StructField(column, BinaryType())]))


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """row (the columns ``carry``) and ids: the token ids of the text, little-endian unsigned 32-bit integers in one
    binary, as token shards are stored. ``octet_length(ids) / 4`` is their number."""

    def make():
        run = vocabulary.encoder()
        return lambda texts: [ids.tobytes() for ids in run(texts)]

    return _apply(docs, make, F.col(text_col).alias("value"), "ids", carry, "")


def decode(tokens: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """row (the columns ``carry``) and decoded: the bytes that the ids of :func:`encode` stand for. Null ids are none.
    They are a text's UTF-8 unless ids were cut."""
    return _apply(tokens, lambda: lambda many: [vocabulary.text(np.frombuffer(ids, "<u4")) for ids in many], F.col(ids_col).alias("value"), "decoded", carry, b"")


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every document, decodes the ids, and gives the digests of both."""
    vocabulary = Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), spark=spark)
    tokens = encode(read(spark, sf_dir, "documents"), vocabulary, carry=("doc_id",))
    back = decode(tokens.select("row.doc_id", "ids"), vocabulary)
    return back.select("row.doc_id", (F.octet_length("row.ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("row.ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
