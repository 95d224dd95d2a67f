"""Benchmark decontamination with a distributed positional inverted index.

Index: the texts are cut into segments of whole documents (half a megabyte, or
one longer text). A segment is one row: its terms (64-bit hashes, sorted), the
number of postings of each, and the postings (token positions, by term,
delta-coded). The index is written once to the shared folder.

Search: benchmark items become windows of ``window`` words. How often each of
their terms occurs in the whole corpus is read off the index; a window's terms
are ordered from the rarest on. In each segment the postings of the rarest term,
moved back by its offset in the window, are the candidates, and the lists of the
other terms, moved by theirs, are intersected with them in turn. What is left is
an exact phrase match. ``near`` asks instead that all terms stand within a
distance of the rarest one, in any order.

Nothing is shuffled but counts and hits, so no term, however frequent, gathers
in a task. Items are searched in blocks of at most ``BLOCK_WORDS`` words or so
(a longer item alone); only a block is ever sent to the tasks.

Defined results: a null or empty text has no words; an item without words has
no window; an item with fewer words than a window is one window. An item with a
null id marks words but is not listed. Repeated ids of items count once.
Repeated rows of documents are judged one by one. Extra columns pass through
``decontaminate`` untouched; empty tables give empty results (no items: nothing
is hit).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import words as W
from tidepool.llm.common import query, read, scratch_path

WINDOW = 10
#: Words of benchmark text searched at a time: what is sent to tasks is bounded by this.
BLOCK_WORDS = 200_000
#: Candidates held at a time within a segment.
CANDIDATES = 1 << 19

_SEGMENT = ("segment string, ids array<bigint>, tags array<bigint>, n_words array<bigint>, terms binary, counts binary, postings binary")
_HITS = "segment string, idx int, spans array<struct<start:bigint,end:bigint>>, items array<string>"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch.column(2), W.ALNUM, fold=True):
            order = np.argsort(part.hash, kind="stable")
            ordered = part.hash[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(order) else order
            counts = np.diff(np.append(first, len(order))).astype(np.uint32)
            deltas = np.diff(order, prepend=0)
            deltas[first] = order[first]
            rows = batch.slice(part.first, part.n)
            column = lambda x: pa.array([x])
            yield pa.RecordBatch.from_arrays(
                [column(uuid.uuid4().hex), pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
                 pa.array([rows.column(1).to_pylist()], pa.list_(pa.int64())),
                 pa.array([np.diff(part.bound).tolist()], pa.list_(pa.int64())), column(ordered[first].tobytes()), column(counts.tobytes()),
                 column(deltas.astype(np.uint32).tobytes())],
                names=["segment", "ids", "tags", "n_words", "terms", "counts", "postings"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """The positional index of ``docs``, written to ``path`` (shared storage)."""
    path = path or scratch_path(docs.sparkSession, "postings")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"), F.col(text_col).alias("text"))
    index = rows.mapInArrow(_index, _SEGMENT)
    index.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


def _term_counts(vocabulary: np.ndarray):
    def run(batches):
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1)):
                terms, counts = np.frombuffer(terms.as_py(), np.uint64), np.frombuffer(counts.as_py(), np.uint32)
                at = np.flatnonzero(np.isin(terms, vocabulary, assume_unique=True))
                yield pa.RecordBatch.from_arrays([pa.array(terms[at].view(np.int64)), pa.array(counts[at].astype(np.int64))], names=["term", "n"])

    return run


@dataclass
class Windows:
    """Windows of a block of items: terms and their offsets from the rarest term on, length, item."""
    terms: np.ndarray
    offsets: np.ndarray
    length: np.ndarray
    item: np.ndarray
    names: list


def _windows(items: list, size: int) -> Windows:
    texts = pa.array([r["text"] for r in items], pa.string())
    terms, length, item = [], [], []
    for part in W.slices(texts, W.ALNUM, fold=True):
        for r in range(part.n):
            words = part.hash[part.bound[r]:part.bound[r + 1]]
            n = min(size, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                terms.append(np.pad(words[i:i + n], (0, size - n)))
                length.append(n)
                item.append(part.first + r)
    names = [None if r["item_id"] is None else str(r["item_id"]) for r in items]
    terms = np.array(terms, np.uint64).reshape(-1, size)
    return Windows(terms, np.tile(np.arange(size), (len(terms), 1)), np.array(length, np.int64), np.array(item, np.int64), names)


def _rarest_first(w: Windows, counts: dict[int, int]) -> Windows:
    """Windows with all terms in the corpus, terms ordered by how seldom they occur."""
    known = np.array(sorted(counts), np.int64).view(np.uint64)
    known.sort()
    totals = np.array([counts[int(t)] for t in known.view(np.int64)], np.int64)
    at = np.minimum(np.searchsorted(known, w.terms), max(0, len(known) - 1))
    used = w.offsets < w.length[:, None]
    found = known[at] == w.terms if len(known) else np.zeros(w.terms.shape, bool)
    cost = np.where(used, np.where(found, totals[at] if len(known) else 0, 0), np.iinfo(np.int64).max)
    keep = (found | ~used).all(axis=1)
    order = np.argsort(cost[keep], axis=1, kind="stable")
    pick = lambda x: np.take_along_axis(x[keep], order, axis=1)
    return Windows(pick(w.terms), pick(w.offsets), w.length[keep], w.item[keep], w.names)


def _chunks(counts: np.ndarray, most: int) -> Iterator[slice]:
    total = np.cumsum(counts)
    first = 0
    while first < len(counts):
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + most, side="right")))
        yield slice(first, last)
        first = last


def _search(w: Windows, near: int | None):
    """Phrase (or proximity) matches of all windows in every segment."""

    def matches(terms, counts, deltas, bounds):
        first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else counts
        total = np.cumsum(deltas, dtype=np.int64)
        at = np.minimum(np.searchsorted(terms, w.terms), len(terms) - 1)
        used = w.offsets < w.length[:, None]
        live = np.flatnonzero(((terms[at] == w.terms) | ~used).all(axis=1))
        base = total[first] - deltas[first]
        places = total - np.repeat(base, counts)
        keys = (np.repeat(np.arange(len(terms)), counts) << 32) | places
        for part in _chunks(counts[at[live, 0]], CANDIDATES):
            mine = live[part]
            n = counts[at[mine, 0]]
            of = np.repeat(mine, n)
            ends = np.cumsum(n)
            place = places[np.repeat(first[at[mine, 0]], n) + np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n)]
            doc = np.searchsorted(bounds, place, side="right") - 1
            low, high = bounds[doc], bounds[doc + 1]
            if near is None:
                place = place - w.offsets[of, 0]
                ok = (place >= low) & (place + w.length[of] <= high)
                of, place, doc = of[ok], place[ok], doc[ok]
            else:
                low, high = np.maximum(low, place - near), np.minimum(high - 1, place + near)
            for j in range(1, w.terms.shape[1]):
                if not len(of):
                    break
                wanted = j < w.length[of]
                term = at[of, j] << 32
                if near is None:
                    key = term | (place + w.offsets[of, j])
                    ok = ~wanted | (keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key)
                else:
                    i = np.minimum(np.searchsorted(keys, term | low), len(keys) - 1)
                    ok = ~wanted | ((keys[i] >= (term | low)) & (keys[i] <= (term | high)))
                    low, high = low[ok], high[ok]
                of, place, doc = of[ok], place[ok], doc[ok]
            length = w.length[of] if near is None else np.ones(len(of), np.int64)
            yield doc, place - bounds[doc], length, w.item[of]

    def run(batches):
        for batch in batches:
            for segment, n_words, *rest in zip(*(batch.column(i) for i in range(5))):
                terms, counts, deltas = (np.frombuffer(x.as_py(), t) for x, t in zip(rest, (np.uint64, np.uint32, np.uint32)))
                if not len(terms) or not len(w.terms):
                    continue
                bounds = np.concatenate([[0], np.cumsum(n_words.values.to_numpy())])
                found = [np.concatenate(x) for x in zip(*matches(terms, counts.astype(np.int64), deltas.astype(np.int64), bounds))]
                if not found or not len(found[0]):
                    continue
                doc, start, length, item = found
                order = np.lexsort((start, doc))
                doc, start, end, item = doc[order], start[order], (start + length)[order], item[order]
                cuts = np.flatnonzero(np.diff(doc)) + 1
                out = []
                for d, s, e, i in zip(*(np.split(x, cuts) for x in (doc, start, end, item))):
                    # Windows that overlap become one span.
                    e = np.maximum.accumulate(e)
                    new = np.concatenate([[True], s[1:] > e[:-1]])
                    spans = zip(s[new].tolist(), e[np.append(np.flatnonzero(new)[1:] - 1, len(e) - 1)].tolist())
                    names = sorted({w.names[x] for x in i.tolist() if w.names[x] is not None})
                    out.append({"segment": segment.as_py(), "idx": int(d[0]), "spans": [{"start": a, "end": b} for a, b in spans], "items": names})
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    ("segment", pa.string()), ("idx", pa.int32()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))]))

    return run


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, near: int | None = None) -> DataFrame:
    """Hits (segment, idx, spans, items) of the windows of ``items`` (item_id, text), a row a document and block."""
    items = items.select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (6 * BLOCK_WORDS)))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = None
    for block in range(blocks):
        rows = items.filter(F.col("block") == block).select("item_id", "text").collect()
        windows = _windows(rows, window)
        vocabulary = np.unique(windows.terms)
        counted = index.select("terms", "counts").mapInArrow(_term_counts(vocabulary), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        windows = _rarest_first(windows, {r.term: r.n for r in counted.collect()})
        hits = index.select("segment", "n_words", "terms", "counts", "postings").mapInArrow(_search(windows, near), _HITS)
        out = hits if out is None else out.unionByName(hits)
    return out


def contamination(index: DataFrame, items: DataFrame, window: int = WINDOW, near: int | None = None) -> DataFrame:
    """Per indexed row: id, tag, n_words, n_hit (words inside a match) and the ids of matching items."""
    hits = (search(index, items, window, near).groupBy("segment", "idx")
            .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    hits = hits.withColumn("n_hit", F.expr("""
        aggregate(spans, struct(0L as n, 0L as until),
                  (a, x) -> struct(a.n + greatest(0L, x.end - greatest(x.start, a.until)) as n, greatest(a.until, x.end) as until)).n"""))
    rows = index.select("segment", F.posexplode(F.arrays_zip("ids", "tags", "n_words")).alias("idx", "d")).select("segment", "idx", "d.*")
    return rows.join(hits, ["segment", "idx"], "left").select(
        F.col("ids").alias("id"), F.col("tags").alias("tag"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of ``items`` occurs, with all their columns."""
    hit = contamination(build_index(docs, id_col, text_col), items, window).filter("n_hit > 0").select("id", "tag").distinct()
    own_id, own_tag = F.col("_key.id"), F.col("_key.tag")
    rows = docs.select(F.struct("*").alias("_row"), F.struct(F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag")).alias("_key"))
    return rows.join(hit, own_id.eqNullSafe(hit["id"]) & (own_tag == hit["tag"]), "left_anti").select("_row.*")


_WORDS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
              r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
ORACLE = rf"""
with d as (select doc_id, {_WORDS_SQL} as words from documents),
b as (select item_id, words, least(len(words), {WINDOW}) as l from (select item_id, {_WORDS_SQL} as words from benchmark) where len(words) > 0),
w as (select item_id, l, array_to_string(words[i:i + l - 1], ' ') as g
      from (select *, unnest(range(1, len(words) - l + 2)) as i from b)),
g as (select doc_id, i, l, array_to_string(words[i:i + l - 1], ' ') as g
      from (select doc_id, words, l, unnest(range(1, len(words) - l + 2)) as i from d, (select distinct l from b))),
h as (select doc_id, i, l, item_id from g join w using (l, g)),
n as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + l)) as p from h) group by doc_id),
t as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from h group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(n, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n, 0) > 0 as contaminated
from d left join n using (doc_id) left join t using (doc_id)
"""


@query("op5_decontamination", oracle=ORACLE)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words inside occurrences of benchmark windows, and the items."""
    index = build_index(read(spark, sf_dir, "documents"))
    return contamination(index, read(spark, sf_dir, "benchmark")).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
