"""Resampling of raw documents by importance: those whose n-grams look like a target's.

Features are all runs of 1 to ``N_MAX`` consecutive words. A text's separators
are collapsed to single spaces, and one overlapped regex scan with lookarounds
at both ends starts at every word and emits the spans of the runs that begin
there; the span's bytes go to CRC-32 and the sum's remainder is the bucket.

1. Each raw document is scanned once; its buckets are written beside it, packed.
2. Bucket counts are summed inside each task and then over tasks, for raw and target.
3. A bucket's gain is the logarithm of the smoothed ratio of its shares; a document's
   weight is the sum of its features' gains, and Gumbel noise from its id makes the draw
   of the highest scores a draw without replacement.
4. Ranks come from a range sort: rows are pinned to range partitions by writing them, and a
   row's rank is the number of rows in the partitions before plus its number inside.

Only the gains (``N_BUCKETS`` numbers) pass the driver.

Defined cases: a null text has no words, and a null id draws its noise as an empty one
and ranks after equal scores. Repeated rows each count and each can be drawn; rows with equal
score and id rank by their place in the input. An empty target gives all buckets the same
smoothing; empty raw tables give empty results. A row's columns ride in the struct
``row``, so no name can clash. A long text is scanned in blocks of ``BLOCK`` words; its buckets, two bytes a feature, are one value.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import islice
from operator import methodcaller

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tidepool.llm.common import query, read, written

N_MAX, N_BUCKETS, MIN_WORDS, SEED = 3, 10_000, 20, 42
#: Of the documents with at least MIN_WORDS words so many hundredths are drawn.
PERCENT = 5
BLOCK = 1 << 15

LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
#: What stands between words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def scanner(n_max: int) -> regex.Pattern:
    """Matches, at the beginning of each word, the word and up to ``n_max - 1`` after it, each with the space before it in a group."""
    more = b""
    for _ in range(n_max - 1):
        more = b"(?:( [^ ]+)" + more + b")?"
    return regex.compile(b"(?<![^ ])([^ ]+)" + more + b"(?![^ ])")


def features(text: str, scan: regex.Pattern, n_buckets: int) -> tuple[int, np.ndarray]:
    """The number of words of ``text`` and the buckets of its features."""
    clean = SEPARATORS.sub(b" ", text.encode().translate(LOWER)).strip(b" ")
    matches, crc = scan.finditer(clean, overlapped=True), zlib.crc32
    n_words, found = 0, array("I")
    while block := list(map(methodcaller("groups"), islice(matches, BLOCK))):
        n_words += len(block)
        runs = list(zip(*block))
        sums = list(map(crc, runs[0]))
        found.extend(sums)
        for more in runs[1:]:
            # A run's sum goes on from that of the run that is a word shorter; None: the text ends before.
            missing = more.index(None) if more[-1] is None else len(more)
            sums = list(map(crc, more[:missing], sums))
            found.extend(sums)
    return n_words, np.frombuffer(found, np.uint32) % np.uint32(n_buckets) if found else np.zeros(0, np.uint32)


def _packed(n_buckets: int):
    return np.dtype("<u2" if n_buckets <= 1 << 16 else "<u4")


def bucketed(docs: DataFrame, text_col: str = "text", n_max: int = N_MAX, n_buckets: int = N_BUCKETS,
             carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """row (the columns ``carry``), n_words, n_features and buckets: those of all features, packed into one binary."""
    kind = _packed(n_buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(n_max)
        for batch in batches:
            first, words, found, size = 0, [], [], 0
            for i in range(batch.num_rows):
                n, buckets = features(batch.column(1)[i].as_py() or "", scan, n_buckets)
                words.append(n)
                found.append(buckets.astype(kind).tobytes())
                size += len(found[-1])
                if size > 4 << 20 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, len(words)), pa.array(words, pa.int64()),
                         pa.array([len(x) // kind.itemsize for x in found], pa.int64()), pa.array(found, pa.binary())],
                        names=["row", "n_words", "n_features", "buckets"])
                    first, words, found, size = i + 1, [], [], 0

    rows = docs.select(F.struct(*carry).alias("row"), F.col(text_col).alias("text"))
    made = [StructField("n_words", LongType()), StructField("n_features", LongType()), StructField("buckets", BinaryType())]
    return rows.mapInArrow(run, StructType([rows.schema["row"], *made]))


def bucket_counts(rows: DataFrame, n_buckets: int = N_BUCKETS) -> np.ndarray:
    """How many features of all rows fall into each bucket."""
    kind = _packed(n_buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_py(), kind), minlength=n_buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    # At most n_buckets rows come out.
    out = np.zeros(n_buckets, np.int64)
    for r in rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the raw texts, both smoothed by one."""
    n, s, t = len(raw), raw.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + n)) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """The rows of :func:`bucketed` with weight in place of their buckets."""
    kind = _packed(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gain[np.frombuffer(b.as_py(), kind)].sum()) for b in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["row", "n_words", "n_features", "weight"])

    rows = rows.select("row", "n_words", "n_features", "buckets")
    return rows.mapInArrow(run, StructType([*rows.schema.fields[:3], StructField("weight", LongType())]))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variable that the id decides."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def drawn(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``rows`` (row, id, n_words, n_features, weight, score, seq) with rank: 1, 2, 3 ... of the highest scores, null for what is not drawn."""
    can = F.col("n_words") >= min_words
    # The rows are written in their range partitions: a partition's number and rows stay as they are from here on.
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("seq")]
    ranged = written(rows.filter(can).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("part").orderBy(*order)
    # One row a partition.
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"),
                         F.floor(F.lit(percent) * F.sum("n").over(Window.partitionBy()) / 100).alias("most"))
    rank = F.row_number().over(inside).cast("long") + F.col("before")
    ranked = ranged.join(F.broadcast(parts), "part").withColumn("rank", rank)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= F.col("most"), F.col("rank")))
    return ranked.select(*rows.columns, "rank").unionByName(rows.filter(~can).withColumn("rank", F.lit(None).cast("long")))


def resample(raw: DataFrame, target: DataFrame, percent: int = PERCENT, n_max: int = N_MAX, n_buckets: int = N_BUCKETS,
             min_words: int = MIN_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """Every row of ``raw``: row (the columns ``carry``), n_words, n_features, weight, score, and rank (null unless drawn).

    ``percent`` hundredths of the rows with at least ``min_words`` words are drawn. The rows of rank not null are the sample.
    """
    found = bucketed(raw.select(F.struct(*carry).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                     "text", n_max, n_buckets, carry=("row", "id"))
    found = written(found.withColumn("seq", F.monotonically_increasing_id()), "features")
    wanted = bucketed(target.select(F.col(target_col).alias("text")).withColumn("one", F.lit(1)), "text", n_max, n_buckets, carry=("one",))
    gain = gains(bucket_counts(found, n_buckets), bucket_counts(wanted, n_buckets))
    rows = weighted(found.select(F.struct("row", "seq").alias("row"), "n_words", "n_features", "buckets"), gain)
    rows = rows.select("row.row.row", "row.row.id", "row.seq", "n_words", "n_features", "weight")
    rows = written(rows.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scores")
    return drawn(rows, percent, min_words).select("row", "n_words", "n_features", "weight", "score", "rank")


@query("op12_importance_resampling")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's features, weight, score and rank in the draw that looks like the benchmark."""
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return resample(docs, target, carry=("doc_id",)).select("row.doc_id", "n_features", "weight", "score", "rank")
