"""SimHash near-dedup with anchors from a covering code.

A fingerprint has 64 bits, cut into three blocks; two fingerprints that differ
in at most 4 bits differ in at most one bit of some block. The anchors of a
block are the words of a code that covers all its values: 15 bits carry the
perfect Hamming code (every value is within one bit of a code word), the other
bits stand as they are. Around any value x there is thus an anchor within 1, and
whatever differs from x in one bit of the block is within 1 + 1 of that anchor.
So each distinct fingerprint is replicated to every anchor within 2 (the
covering radius plus the block's threshold) of each of its blocks, and
fingerprints are compared per anchor, on all 64 bits.

Equal fingerprints are one node, so groups of copies cost one row. An anchor's
rows are compared inside the task that sorted them by anchor; it passes on a
star for each locally connected group, never all pairs. Groups too large for
that are cut by five pieces of the other blocks, of which one must be equal.

Defined results: a null or empty text has fingerprint zero and links like any
other. Repeated rows get the same fingerprint and component. A null doc_id is
never a component's id; a component of null ids only has a null id. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import query, read, written
from tidepool.llm.components import connected_components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: (shift, width) of the blocks.
BLOCKS = ((0, 21), (21, 21), (42, 22))
HAMMING = 15
#: Groups up to the first size are compared in one go for many anchors, up to the second one group at a time.
SMALL, LARGE = 64, 4096


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text; bit i of the result is bit i of most shingle hashes."""
    norm = b" ".join(text.lower().split())
    if not norm:
        return 0
    gaps = np.flatnonzero(np.frombuffer(norm, np.uint8) == 0x20)
    n = max(1, len(gaps) + 2 - shingle)
    starts = np.concatenate([[0], gaps[:n - 1] + 1])
    ends = np.append(gaps[shingle - 1:], len(norm)) if len(gaps) >= shingle - 1 else [len(norm)]
    view, hashed = memoryview(norm), xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(view[a:b], SEED) for a, b in zip(starts.tolist(), list(ends))), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["id", "tag", "fp"])

    return run


def _masks(free: int) -> list[np.ndarray]:
    """By the syndrome of a value's Hamming part: what to flip to get at every anchor within 2."""
    one = [1 << (HAMMING + i) for i in range(free)]
    two = [a | b for a, b in itertools.combinations(one, 2)]
    out = [np.array([0, *one, *two], np.uint64)]
    for syndrome in range(1, HAMMING + 1):
        near = 1 << (syndrome - 1)
        pairs = [(1 << (i - 1)) | (1 << ((i ^ syndrome) - 1)) for i in range(1, HAMMING + 1) if i < (i ^ syndrome)]
        out.append(np.array([near, *pairs, *(near | f for f in one)], np.uint64))
    return out


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every anchor within 2 of a block of a fingerprint: the key (block, anchor), and the fingerprint's place."""
    keys, places = [], []
    for block, (shift, width) in enumerate(BLOCKS):
        value = (fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        syndrome = np.zeros(len(fps), np.uint64)
        for i in range(1, HAMMING + 1):
            syndrome ^= ((value >> np.uint64(i - 1)) & np.uint64(1)) * np.uint64(i)
        for s, masks in enumerate(_masks(width - HAMMING)):
            at = np.flatnonzero(syndrome == s)
            keys.append(((value[at][:, None] ^ masks) | np.uint64(block << 32)).ravel())
            places.append(np.repeat(at, len(masks)))
    return np.concatenate(keys), np.concatenate(places)


def _replicate(batches):
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for i in range(0, len(fps), 20_000):
            part = fps[i:i + 20_000]
            keys, places = anchors(part)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(part[places].view(np.int64))], names=["key", "fp"])


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= most


def _small_groups(keys: np.ndarray, fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the connected parts of every group of equal keys, for many groups at once."""
    left, right = [], []
    at = np.arange(len(keys))
    for step in range(1, len(keys)):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        hit = at[_near(fps[at], fps[at + step], most)]
        left.append(hit)
        right.append(hit + step)
    if not left:
        return fps[:0], fps[:0]
    left, right = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(keys))
    while True:
        old = label.copy()
        np.minimum.at(label, right, label[left])
        np.minimum.at(label, left, label[right])
        label = label[label]
        if (label == old).all():
            break
    own = np.flatnonzero(label != np.arange(len(keys)))
    return fps[own], fps[label[own]]


def _one_group(fps: np.ndarray, most: int) -> tuple[list, list]:
    """Stars of the connected parts of one group: a search that compares each reached
    fingerprint with those not reached yet, so dense groups end soon."""
    out: tuple[list, list] = ([], [])
    left = np.unique(fps)
    while len(left):
        root, left, reached = left[0], left[1:], [left[0]]
        while reached and len(left):
            hit = _near(left, reached.pop(), most)
            if hit.any():
                found = left[hit]
                out[0].append(found)
                out[1].append(np.full(len(found), root))
                reached.extend(found)
                left = left[~hit]
    return out


def _large_group(key: int, fps: np.ndarray, most: int) -> tuple[list, list]:
    if len(fps) <= LARGE:
        return _one_group(fps, most)
    own, rest, bits = int(key) >> 32, np.zeros(len(fps), np.uint64), 0
    for block, (shift, width) in enumerate(BLOCKS):
        if block != own:
            rest |= ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)) << np.uint64(bits)
            bits += width
    out: tuple[list, list] = ([], [])
    cuts = np.linspace(0, bits, most + 2).astype(int).tolist()
    for lo, hi in itertools.pairwise(cuts):
        piece = (rest >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
        order = np.argsort(piece, kind="stable")
        for group in np.split(fps[order], np.flatnonzero(np.diff(piece[order])) + 1):
            if len(group) > 1:
                found = _one_group(group, most)
                out[0].extend(found[0])
                out[1].extend(found[1])
    return out


def _compare(most: int) -> Callable:
    """Links among the rows of each anchor, from rows sorted by anchor."""

    def groups(keys, fps):
        bound = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        sizes = np.diff(bound)
        small = np.repeat(sizes <= SMALL, sizes)
        yield _small_groups(keys[small], fps[small], most)
        for i in np.flatnonzero(sizes > SMALL):
            found = _large_group(keys[bound[i]], fps[bound[i]:bound[i + 1]], most)
            if found[0]:
                yield np.concatenate(found[0]), np.concatenate(found[1])

    def run(batches):
        held: list[list[np.ndarray]] = [[], []]

        def links(keys, fps):
            for u, v in groups(keys, fps):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
            if cut:
                yield from links(np.concatenate([*held[0], keys[:cut]]), np.concatenate([*held[1], fps[:cut]]))
                held = [[], []]
            held[0].append(keys[cut:])
            held[1].append(fps[cut:])
        if held[0]:
            yield from links(np.concatenate(held[0]), np.concatenate(held[1]))

    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints (column fp) within ``max_bits`` of each other."""
    if not 0 <= max_bits < 2 * len(BLOCKS):
        raise ValueError("blocks of this number guarantee one bit in a block up to 5 bits in all")
    return (fps.select("fp").distinct().mapInArrow(_replicate, "key long, fp long")
            .repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_compare(max_bits), "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, tag (a hash of its text), fp, and component (the smallest id it is linked to)."""
    text = F.col(text_col)
    marked = written(docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("tag"), text)
                     .mapInArrow(_fingerprints(shingle), "id long, tag long, fp long"), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(near_links(nodes, max_bits)).withColumnRenamed("node", "fp")
    nodes = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = nodes.groupBy("root").agg(F.min("least").alias("component"))
    return marked.join(nodes.join(groups, "root").select("fp", "root", "component"), "fp")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that of the smallest id; ties go to the smallest text hash."""
    found = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    # A null id sorts last: false is before true.
    keep = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tag")).alias("k"))
    keep = keep.select(F.col("k.id").alias("_id"), F.col("k.tag").alias("_tag"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_tag"))
    same = keep.select(F.col("_id").alias("i"), F.col("_tag").alias("t"))
    rows = rows.join(same, F.col("_id").eqNullSafe(F.col("i")) & (F.col("_tag") == F.col("t")), "left_semi")
    # Rows equal in id and text are one document.
    once = Window.partitionBy("_id", "_tag").orderBy("_tag")
    return rows.withColumn("_n", F.row_number().over(once)).filter("_n = 1").select("_row.*")


@query("op3_simhash_dedup")
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its fingerprint and component."""
    return near_duplicates(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))
