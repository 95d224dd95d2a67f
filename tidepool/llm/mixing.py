"""Mixing sources to target weights, as a curriculum that changes over training time.

Every source has a weight schedule, a piecewise linear function of training
time 0..1. Its integral is the source's weight; weights share out all words of
the corpus, capped at ``max_passes`` times a source's own words, the excess
reshared by weight. The integrated schedule, scaled to the target, is the
cumulative demand for words of the source; a document whose words begin at
offset c of its source's stream (all documents in hash order, again and again
until the target is met) is trained on when the demand reaches c, in a later
pass when it reaches c and the passes before. That inverts the demand in closed
form. Passes of documents are range-sorted by that position.

Offsets are exact prefix sums without one task per source: a source's hash
order is cut into 65,536 ranges, whose sums are added up first, so a source
with a third of all rows is spread over all tasks.

Defined results: a null or empty text has size 0, is taken 0 words and has no
position. Null sources are one source, the last. Repeated rows count each. The
document at a source's last offset is cut, so taken words sum to the rounded
target. Extra columns travel in a struct, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import query, read, word_array

MAX_PASSES = 3

Knots = tuple[tuple[float, float], ...]

#: Schedules of the sources in code point order, repeating; their integrals are 1, 2 and 3.
SCHEDULES: tuple[Knots, ...] = (
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 4.5), (1.0, 1.5)),
)


def integral(knots: Knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def _inverse(knots: Knots, share: Column) -> Column:
    """The time at which the schedule's integral reaches ``share`` of its whole."""
    area, out = integral(knots), F.lit(knots[-1][0])
    pieces, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        pieces.append((t0, w0, (w1 - w0) / (t1 - t0), done, done := done + (t1 - t0) * (w0 + w1) / 2))
    for t0, w0, slope, before, until in reversed(pieces):
        r = share * F.lit(area) - F.lit(before)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * r))
        time = F.when(r <= 0, F.lit(t0)).otherwise(F.lit(t0) + F.lit(2.0) * r / (F.lit(w0) + root))
        out = F.when(share * F.lit(area) < F.lit(until), time).otherwise(out)
    return out


def targets(sizes: DataFrame, schedules: tuple[Knots, ...] = SCHEDULES, max_passes: int = MAX_PASSES) -> DataFrame:
    """``sizes`` (source, source_size) with each source's schedule number, weight and target words.

    One row a source, so plain windows over all of them do. A source stands at
    its cap if the words left by the sources with lower caps per weight would
    give it more than that.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        weight = F.when(F.col("schedule") == i, F.lit(float(integral(knots)))).otherwise(weight)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    return (sizes.withColumn("schedule", ((F.row_number().over(order) - 1) % len(schedules)))
            .withColumn("weight", weight)
            .withColumn("cap", (F.lit(max_passes) * F.col("source_size")).cast("double"))
            .withColumn("total", F.sum("source_size").over(whole).cast("double"))
            .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            .withColumn("capped", F.col("left") * F.col("weight") > F.col("cap") * F.sum("weight").over(onward))
            .withColumn("shared", F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(whole))
            .withColumn("weights", F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(whole))
            .withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("shared") * F.col("weight") / F.col("weights")))
            .select("source", "schedule", "source_size", "target"))


def mix(docs: DataFrame, schedules: tuple[Knots, ...] = SCHEDULES, max_passes: int = MAX_PASSES,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """Every row of ``docs`` as the struct ``row`` (of the columns ``carry``), with size, source_size, target, taken, and
    position: the training time at which its first pass begins, and passes: (pass, words, position) of each (both null if
    none of it is taken)."""
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(F.struct(*carry).alias("row"), F.col(source_col).cast("string").alias("source"),
                       F.size(word_array(F.col(text_col))).cast("long").alias("size"), key.alias("key"),
                       F.xxhash64(F.col(text_col)).alias("tie"))
    rows = rows.withColumn("bucket", F.conv(F.substring("key", 1, 4), 16, 10).cast("int"))
    sums = docs.select(F.col(source_col).cast("string").alias("source"), F.size(word_array(F.col(text_col))).cast("long").alias("size"),
                       F.conv(F.substring(key, 1, 4), 16, 10).cast("int").alias("bucket"))
    sums = sums.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    plan = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), schedules, max_passes)
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    # Per (source, bucket): all that a document needs besides its place inside the bucket.
    plan = plan.withColumnRenamed("source", "plan_source")
    sums = sums.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "ahead", "schedule", "source_size", "target")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    demand = F.round("target").cast("long")
    rows = (rows.withColumn("offset", F.col("ahead") + F.col("inside"))
            .withColumn("full", F.when(F.col("source_size") > 0, F.floor(demand / F.col("source_size"))).otherwise(0))
            .withColumn("rest", demand - F.col("full") * F.col("source_size"))
            .withColumn("taken", F.col("full") * F.col("size")
                        + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("offset")))))

    def time(offset: Column) -> Column:
        out = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            out = F.when(F.col("schedule") == i, _inverse(knots, offset / F.round("target"))).otherwise(out)
        return out

    def one(k: Column) -> Column:
        begin = F.col("offset") + k * F.col("source_size")
        return F.struct(k.alias("pass"), F.least(F.col("size"), demand - begin).alias("words"), time(begin).alias("position"))

    n = F.col("full") + F.when(F.col("rest") > F.col("offset"), 1).otherwise(0)
    passes = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)) - 1), one)
    return (rows.withColumn("position", F.when(F.col("taken") > 0, time(F.col("offset"))))
            .withColumn("passes", F.when(F.col("taken") > 0, passes))
            .select("row", "size", "source_size", "target", "taken", "position", "passes"))


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, range-sorted by position, with the columns of :func:`mix`: one row each, in the
    order of their first passes. :func:`training_passes` has all passes."""
    return mix(docs, **options).filter("taken > 0").orderBy("position", F.expr("xxhash64(row)"))


def training_passes(docs: DataFrame, **options) -> DataFrame:
    """A row for each document and pass that the mix takes, range-sorted by the time at which the pass begins: row, size,
    source_size, target, pass (from 0), words (of the document in this pass) and position."""
    taken = mix(docs, **options).filter("taken > 0").select("row", "size", "source_size", "target", F.explode("passes").alias("p"))
    return taken.select("row", "size", "source_size", "target", "p.*").orderBy("position", F.expr("xxhash64(row)"), "pass")


ORACLE = r"""
with d as (
  select doc_id, source, md5(coalesce(doc_id::varchar, '')) as key,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::bigint as size
  from documents),
s as (
  select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 as schedule
  from d group by source),
c as (select *, (schedule + 1)::double as weight, 3.0 * source_size as cap, sum(source_size) over ()::double as total from s),
l as (
  select *, (total - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)) * weight
         > cap * sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as capped from c),
t as (
  select source, schedule, source_size,
         case when capped then cap::double else (total - sum(case when capped then cap else 0 end) over ())::double * weight
              / sum(case when capped then 0 else weight end) over () end as target from l),
o as (
  select doc_id, size, source_size, schedule, target, round(target)::bigint as demand,
         coalesce(sum(size) over (partition by source order by key, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as ahead
  from d join t using (source)),
k as (
  select *, (demand // source_size) * size + greatest(0, least(size, demand % source_size - ahead)) as taken, ahead / demand::double as f from o)
select doc_id, size, source_size, target, taken::bigint as taken,
       case when taken > 0 then round(case when f = 0 then 0.0 when schedule = 0 then 2 * f / (0.5 + sqrt(0.25 + 2 * f))
            when schedule = 1 then f else 6 * f / (4.5 + sqrt(20.25 - 18 * f)) end, 9) end as position
from k
"""


@query("op10_source_mixing", oracle=ORACLE)
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, in the order of training: words, target of its source, words taken, position."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (mix(docs, carry=("doc_id",)).select("row.doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


ORACLE_PASSES = ORACLE[:ORACLE.rindex(",\nk as (")] + r""",
p as (
  select *, n * source_size + ahead as begin from o, (select unnest(range(0, 3)) as n) where size > 0 and n * source_size + ahead < demand),
f as (select *, begin / demand::double as f from p)
select doc_id, n::bigint as pass, least(size, demand - begin)::bigint as words,
       round(case when f = 0 then 0.0 when schedule = 0 then 2 * f / (0.5 + sqrt(0.25 + 2 * f))
            when schedule = 1 then f else 6 * f / (4.5 + sqrt(20.25 - 18 * f)) end, 9) as position
from f
"""


@query("op10_training_passes", oracle=ORACLE_PASSES)
def op10_training_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pass of every document, in the order of training: pass, words, position."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return training_passes(docs, carry=("doc_id",)).select("row.doc_id", "pass", "words", F.round("position", 9).alias("position")).orderBy(
        "position", "doc_id", "pass")
