"""Substring dedup by compaction of the corpus' De Bruijn graph.

Every window of ``k`` words is an edge of the graph. Edges are never shuffled
one by one: consecutive windows of a text that share their minimizer (the
smallest hash among the ``s``-word sequences inside) travel as one path, and
as equal windows have equal minimizers, equal windows meet in one shuffle by
minimizer.

1. Every text is cut into such paths. Paths of one content are compacted: where
   a path's whole content also stands in a smaller document, all of it is
   covered. If all paths of a minimizer have one content, nothing branches
   there, and its first occurrence stays.
2. Where a minimizer has several contents the graph branches. The first path of
   each content is joined back to its text and opened into single windows,
   which are compared by a hash of their own.
3. The covered runs are joined to the texts by their source coordinates, runs
   that touch become spans, and the words of each span go.

Slices of the input (a few megabytes) drop in advance what they themselves show
to be covered, and send a minimizer one row each: a passage that stands in a
third of all documents gives a row a slice, not a row a document. Contents are
compared by hashes of their words' hashes, two for windows and for paths (the minimizer's and
the content's); a word's own hash has 64 bits, so two words that share it count as one.

Defined results: a null or empty text has no words and loses none. A null
doc_id sorts after all others. Rows that share a doc_id are documents of which
neither comes earlier: they take nothing from each other. Extra columns pass
through ``remove_repeats`` untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm import words as W
from tidepool.llm.common import query, read, written

#: Words of a window, and of the sequences among which its minimizer is chosen.
K, S = 20, 8
LAST_ID = np.iinfo(np.int64).max

#: Kinds of rows that the first pass writes.
PATH, BRANCH, COVERED, OPEN = 0, 1, 2, 3
_PATHS = "kind int, m long, h long, id long, tag long, start long, n long"
_WINDOWS = "w long, v long, id long, tag long, start long, covered boolean"


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _first_places(keys: list[np.ndarray], ids: np.ndarray, rows: np.ndarray, starts: np.ndarray):
    """Sorts by the keys, then id, row and start: the order, where each group of equal keys
    begins, and which places are covered: a smaller id, or an earlier start in the same row."""
    order = np.lexsort((starts, rows, ids, *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    group = np.cumsum(new) - 1
    least = ids[order][new][group] if len(order) else ids[:0]
    covered = ids[order] > least
    if len(order):
        same_row = np.concatenate([[False], (rows[order[1:]] == rows[order[:-1]]) & ~new[1:]])
        covered |= same_row
    return order, new, covered


def paths_of(part: W.Slice, k: int, s: int):
    """Row, first window, number of windows, minimizer and content hash of every path of a slice."""
    w, n_smers = k - s + 1, len(part.hash) - s + 1
    if n_smers < w:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    at = np.arange(n_smers)
    smers = W.word_spans(part.hash, at, at + s, seed=3)
    # Windows that begin at 0 .. n - k; those that run over a text's end are not windows.
    n_windows = len(part.hash) - k + 1
    place = np.lib.stride_tricks.sliding_window_view(smers, w).argmin(axis=1) + np.arange(n_windows)
    fits = part.row[:n_windows] == part.row[k - 1:]
    first = fits.copy()
    first[1:] &= ~fits[:-1] | (place[1:] != place[:-1]) | (part.row[1:n_windows] != part.row[:n_windows - 1])
    begin = np.flatnonzero(first)
    count = np.add.reduceat(fits.astype(np.int64), begin) if len(begin) else begin
    content = W.word_spans(part.hash, begin, begin + count + k - 1, seed=5)
    return part.row[begin], begin, count, smers[place[begin]], content


def _cut(k: int, s: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            ids, tags = _ids(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for part in W.slices(batch.column(2)):
                row, begin, count, m, h = paths_of(part, k, s)
                own = ids[part.first + row]
                start = begin - part.bound[row]
                order, new, covered = _first_places([m, h], own, row, begin)
                kind = np.where(covered, COVERED, PATH)
                # Minimizers with several contents inside this slice branch for sure.
                ms = m[order]
                fresh = np.ones(len(ms), bool)
                fresh[1:] = ms[1:] != ms[:-1]
                group = np.cumsum(fresh) - 1
                contents = np.bincount(group, weights=new, minlength=1)
                branching = contents[group] > 1 if len(ms) else fresh
                kind[branching & ~covered] = OPEN
                yield _path_rows(kind, ms, h[order], own[order], tags[part.first + row[order]], start[order], count[order])
                marks = ms[fresh][contents[: int(fresh.sum())] > 1] if len(ms) else ms
                zero = np.zeros(len(marks), np.int64)
                yield _path_rows(zero + BRANCH, marks, marks, zero, zero, zero, zero)

    return run


def _path_rows(kind, m, h, ids, tags, start, n) -> pa.RecordBatch:
    # Only paths and marks must meet by minimizer; the others are spread by their content.
    m = np.where(kind <= BRANCH, m, W.mix(h + start.astype(np.uint64) + ids.astype(np.uint64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(kind.astype(np.int32)), *(pa.array(x.astype(np.int64)) for x in (m.view(np.int64), h.view(np.int64), ids, tags, start, n))],
        names=["kind", "m", "h", "id", "tag", "start", "n"])


def _windows(k: int):
    def run(batches):
        for batch in batches:
            ids, tags = _ids(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            opened = batch.column(3)
            for part in W.slices(batch.column(2)):
                places = opened.slice(part.first, part.n)
                flat = places.flatten()
                lengths = np.diff(places.offsets.to_numpy())
                row = np.repeat(np.arange(part.n), lengths)
                start, n = (x.to_numpy(zero_copy_only=False) for x in flat.flatten())
                row, start = np.repeat(row, n), np.repeat(start, n) + _counts(n)
                at = part.bound[row] + start
                w, v = (W.word_spans(part.hash, at, at + k, seed=x) for x in (7, 11))
                order, _, covered = _first_places([w, v], ids[part.first + row], row, at)
                own = part.first + row[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in (w[order], v[order])]
                    + [pa.array(ids[own]), pa.array(tags[own]), pa.array(start[order]), pa.array(covered)],
                    names=["w", "v", "id", "tag", "start", "covered"])

    return run


def _counts(n: np.ndarray) -> np.ndarray:
    """0..n[0]-1, 0..n[1]-1, ..."""
    total = np.cumsum(n)
    return np.arange(total[-1] if len(n) else 0) - np.repeat(total - n, n)


def covered_runs(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Covered windows of ``docs`` (id, tag, text) as runs: id, tag, start, n (windows)."""
    found = docs.select("id", "tag", "text").mapInArrow(_cut(k, s), _PATHS)
    by_m, by_content = Window.partitionBy("m"), Window.partitionBy("m", "h")
    is_path = F.col("kind") == PATH
    found = (found.repartition("m")
             .withColumn("least", F.min(F.when(is_path, F.col("id"))).over(by_content))
             .withColumn("low", F.min(F.when(F.col("kind") <= BRANCH, F.col("h"))).over(by_m))
             .withColumn("high", F.max(F.when(F.col("kind") <= BRANCH, F.col("h"))).over(by_m))
             .withColumn("marked", F.max(F.col("kind") == BRANCH).over(by_m))
             .withColumn("kind", F.when(is_path & (F.col("least") < F.col("id")), COVERED)
                         .when(is_path & ((F.col("low") != F.col("high")) | F.col("marked")), OPEN)
                         .otherwise(F.col("kind")))
             .filter(F.col("kind") >= COVERED)
             .select("kind", "id", "tag", "start", "n"))
    found = written(found, "repeat-paths")
    opened = (found.filter(F.col("kind") == OPEN).groupBy("id", "tag")
              .agg(F.collect_set(F.struct("start", "n")).alias("opened")))
    windows = (docs.join(opened, ["id", "tag"]).select("id", "tag", "text", "opened")
               .mapInArrow(_windows(k), _WINDOWS))
    # A window that its own slice covers needs no meeting; it is spread by its place.
    same = Window.partitionBy("w", "v")
    order = same.orderBy("id", "tag", "start")
    windows = (windows.withColumn("w", F.when(F.col("covered"), F.xxhash64("id", "start")).otherwise(F.col("w")))
               .withColumn("v", F.when(F.col("covered"), F.lit(None)).otherwise(F.col("v")))
               .withColumn("least", F.min("id").over(same))
               .withColumn("again", (F.lag("start").over(order) < F.col("start"))
                           & (F.lag("id").over(order) == F.col("id")) & (F.lag("tag").over(order) == F.col("tag")))
               .filter("covered or least < id or again")
               .select("id", "tag", "start", F.lit(1).cast("long").alias("n")))
    return found.filter(F.col("kind") == COVERED).select("id", "tag", "start", "n").unionByName(windows)


def _apply(k: int):
    """Texts without their covered words, with the digest columns."""

    def run(batches):
        for batch in batches:
            texts, covers = batch.column(0), batch.column(1)
            rest = batch.drop_columns(batch.schema.names[:2])
            for part in W.slices(texts):
                out: list[list] = [[], [], [], []]
                for r in range(part.n):
                    lo, hi = part.bound[r], part.bound[r + 1]
                    found = covers[part.first + r]
                    text = part.text(r)
                    gone = np.zeros(hi - lo, bool)
                    if found.is_valid and len(found):
                        start, n = (x.to_numpy(zero_copy_only=False) for x in found.values.flatten())
                        gone = W.runs(start, start + n + k - 1, hi - lo)
                    if gone.any():
                        base = part.offsets[r]
                        starts, ends = part.start[lo:hi] - base, part.end[lo:hi] - base
                        keep = ~gone
                        kept = b" ".join([text[a:b] for a, b in zip(starts[keep].tolist(), ends[keep].tolist())])
                        # A removed word goes with the white space behind it.
                        until = np.append(starts[1:], len(text))
                        left = text[:starts[0]] + b"".join([text[a:b] for a, b in zip(starts[keep].tolist(), until[keep].tolist())])
                    else:
                        kept, left = b" ".join(text.split()), text
                    out[0].append(left.decode() if texts[part.first + r].is_valid else None)
                    out[1].append(int(hi - lo))
                    out[2].append(int(gone.sum()))
                    out[3].append(hashlib.sha256(kept).hexdigest())
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(out, kinds)), *rest.slice(part.first, part.n).columns],
                                                 names=["kept_text", "n_words", "n_removed", "kept_sha256", *rest.schema.names])

    return run


def remove_repeats(docs: DataFrame, k: int = K, s: int = S, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with kept_text (the text without the words of
    repeated windows), n_words, n_removed and kept_sha256."""
    # The tag tells rows of one doc_id apart. Both joins below read one shuffle of the texts.
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                        F.struct("*").dropFields(text_col).alias("row"))
    keyed = (keyed.withColumn("id", F.coalesce("id", F.lit(int(LAST_ID))))
             .withColumn("tag", F.xxhash64(F.coalesce("text", F.lit("")))))
    covered = (covered_runs(keyed, k, s).groupBy("id", "tag")
               .agg(F.collect_list(F.struct("start", "n")).alias("covered")))
    joined = keyed.join(covered, ["id", "tag"], "left").select("text", "covered", "row")
    row_type = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_apply(k), f"kept_text string, n_words long, n_removed long, kept_sha256 string, row {row_type}")


_WORDS_SQL = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
ORACLE = rf"""
with d as (select doc_id, {_WORDS_SQL} as words from documents),
w as (
  select doc_id, i, array_to_string(words[i:i + {K - 1}], ' ') as g
  from (select doc_id, words, unnest(range(1, len(words) - {K - 2})) as i from d)),
again as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by g order by doc_id, i) as nth from w) where nth > 1),
gone as (select distinct doc_id, unnest(range(i, i + {K})) as p from again),
lost as (select doc_id, list(p) as ps, count(*) as n from gone group by doc_id)
select d.doc_id, len(words)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
       sha256(array_to_string(case when n is null then words else
         list_filter(words, lambda w, p: not list_contains(ps, p)) end, ' ')) as kept_sha256
from d left join lost using (doc_id)
"""


@query("op4_substring_dedup", oracle=ORACLE)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, removed words, digest of the kept words."""
    return (remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("row.doc_id", "n_words", "n_removed", "kept_sha256"))
