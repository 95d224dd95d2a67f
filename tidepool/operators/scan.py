"""Running computations per key that no single task has to hold.

``Window.partitionBy(key)`` puts every row of a key into one task. Here the rows
are range-partitioned by (key, order), so a key with many rows lies in several
consecutive range partitions, its segments; the partition number is pinned by
writing the rows to the checkpoint folder. Then, in Spark's own windows only:

1. a window per (key, segment) computes the running values inside a segment;
2. the last row of each segment is its summary, and a window per key over the
   summaries (at most one row a range partition) gives what each segment takes
   over from those before it;
3. an equi-join on (key, segment) adds that to the rows.

Ranks need no row-level window: rows are first counted per (key, rank value),
and the ranks are running sums of those counts, joined back.

Rows whose plan is estimated at ``ONE_TASK_BYTES`` or less, which one task could hold
if all of them had one key, take Spark's plain windows per key; both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SEG = "_seg"

#: Rows of at most so many bytes (estimated) may all lie in one task.
ONE_TASK_BYTES = 64 << 20

#: Values that must be compared with the row before: their columns, "does it differ", the counter's name.
Flag = tuple[list[str], Callable[[list[Column], list[Column]], Column], str]


def _orders(pairs: Sequence[tuple[str, str]]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_first() for c, d in pairs]


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return cond


def _segments(df: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[str, str]], num_partitions: int | None) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    by = [*(F.col(k).asc_nulls_first() for k in keys), *_orders(pairs)]
    ranged = df.repartitionByRange(num_partitions, *by) if num_partitions else df.repartitionByRange(*by)
    return ranged.withColumn(SEG, F.spark_partition_id()).checkpoint()


def _add(inside: Column, before: Column) -> Column:
    """A running sum inside a segment plus the sum before it; NULL only if both are."""
    return F.when(inside.isNull(), before).when(before.isNull(), inside).otherwise(inside + before)


def _run(seg: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[str, str]], sums: Sequence[tuple[str, str]] = (),
         row_number: str | None = None, lags: Sequence[tuple[str, str]] = (), ffill: Sequence[tuple[str, str]] = (),
         flags: Sequence[Flag] = (), maxes: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Running values over segmented rows; the result keeps the segment column."""
    keys = list(keys)
    inside = Window.partitionBy(*keys, SEG).orderBy(*_orders(pairs))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols: dict[str, Column] = {"_rn": F.row_number().over(inside), "_seg_end": F.lead(F.lit(1)).over(inside).isNull()}
    summary: dict[str, Column] = {"_n": F.col("_rn")}
    for i, (c, _) in enumerate(sums):
        cols[f"_s{i}"] = F.sum(c).over(upto)
    for i, (c, _) in enumerate(maxes):
        cols[f"_m{i}"] = F.max(c).over(upto)
    for i, (c, _) in enumerate(lags):
        cols[f"_l{i}"] = F.lag(c).over(inside)
        summary[f"_v{i}"] = F.col(c)
    for i, (c, _) in enumerate(ffill):
        cols[f"_f{i}"] = F.last(c, ignorenulls=True).over(upto)
    for i, (names, differs, _) in enumerate(flags):
        now, prev = [F.col(c) for c in names], [F.lag(c).over(inside) for c in names]
        cols[f"_d{i}"] = F.when(F.lag(F.lit(1)).over(inside).isNull(), 0).when(differs(now, prev), 1).otherwise(0)
        for j, c in enumerate(names):
            cols[f"_o{i}_{j}"] = F.first(c).over(upto)
            summary[f"_o{i}_{j}"], summary[f"_e{i}_{j}"] = F.col(f"_o{i}_{j}"), F.col(c)
    rows = seg.withColumns(cols)
    if flags:
        rows = rows.withColumns({f"_d{i}": F.sum(f"_d{i}").over(upto) for i in range(len(flags))})
    # A sum has the type that Spark's own window gives it.
    types = {f"_s{i}": rows.schema[f"_s{i}"].dataType for i in range(len(sums))}
    for p, xs in (("_s", sums), ("_f", ffill), ("_d", flags), ("_m", maxes)):
        summary |= {f"{p}{i}": F.col(f"{p}{i}") for i in range(len(xs))}
    ends = rows.filter("_seg_end").select(*keys, SEG, *(c.alias(n) for n, c in summary.items()))

    by_key = Window.partitionBy(*keys).orderBy(SEG)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    carry: dict[str, Column] = {"_n": F.coalesce(F.sum("_n").over(before), F.lit(0))}
    for i in range(len(sums)):
        carry[f"_s{i}"] = F.sum(f"_s{i}").over(before).cast(types[f"_s{i}"])
    for i in range(len(maxes)):
        carry[f"_m{i}"] = F.max(f"_m{i}").over(before)
    for i in range(len(lags)):
        carry[f"_v{i}"] = F.lag(f"_v{i}").over(by_key)
    for i in range(len(ffill)):
        carry[f"_f{i}"] = F.last(f"_f{i}", ignorenulls=True).over(before)
    for i, (names, differs, _) in enumerate(flags):
        # Whether a segment's first row differs from the last row of the segment before.
        first = [F.col(f"_o{i}_{j}") for j in range(len(names))]
        last = [F.lag(f"_e{i}_{j}").over(by_key) for j in range(len(names))]
        ends = ends.withColumn(f"_x{i}", F.when(F.lag(F.lit(1)).over(by_key).isNull(), 1).when(differs(first, last), 1).otherwise(0))
        carry[f"_d{i}"] = F.coalesce(F.sum(F.col(f"_d{i}") + F.col(f"_x{i}")).over(before), F.lit(0)) + F.col(f"_x{i}")
    carried = ends.select(*keys, SEG, *(c.alias(f"_c{n}") for n, c in carry.items()))

    out = rows.alias("r").join(carried.alias("c"), _same("r", "c", [*keys, SEG]))
    made: dict[str, Column] = {}
    for i, (_, name) in enumerate(sums):
        made[name] = _add(F.col(f"_s{i}"), F.col(f"_c_s{i}")).cast(types[f"_s{i}"])
    for i, (_, name) in enumerate(maxes):
        made[name] = F.greatest(F.col(f"_m{i}"), F.col(f"_c_m{i}"))  # skips NULLs
    if row_number:
        made[row_number] = (F.col("_rn") + F.col("_c_n")).cast("long")
    for i, (_, name) in enumerate(lags):
        made[name] = F.when(F.col("_rn") == 1, F.col(f"_c_v{i}")).otherwise(F.col(f"_l{i}"))
    for i, (_, name) in enumerate(ffill):
        made[name] = F.coalesce(F.col(f"_f{i}"), F.col(f"_c_f{i}"))
    for i, (_, _, name) in enumerate(flags):
        made[name] = (F.col(f"_d{i}") + F.col(f"_c_d{i}")).cast("long")
    return out.select("r.*", *(c.alias(n) for n, c in made.items())).drop(*cols)


def _ranks(df: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[str, str]], rank: str | None, dense_rank: str | None,
           num_partitions: int | None) -> DataFrame:
    """``df`` with the rank and dense rank of its rows' values among those of the key."""
    by = [*keys, *(c for c, _ in pairs)]
    counted = _segments(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_k")), keys, pairs, num_partitions)
    ranked = _run(counted, keys, pairs, sums=[("_k", "_upto")], row_number="_dense")
    made = {n: c for n, c in ((rank, (F.col("_upto") - F.col("_k") + 1).cast("long")), (dense_rank, F.col("_dense"))) if n}
    ranked = ranked.select(*by, *(c.alias(n) for n, c in made.items()))
    return df.alias("l").join(ranked.alias("k"), _same("l", "k", by)).select("l.*", *(f"k.{n}" for n in made))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of the rows of ``df``; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _windows(df: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[str, str]], sums: Sequence[tuple[str, str]],
             row_number: str | None, rank: str | None, dense_rank: str | None, rank_by: int | None, lags: Sequence[tuple[str, str]],
             ffill: Sequence[tuple[str, str]], flags: Sequence[Flag], maxes: Sequence[tuple[str, str]]) -> DataFrame:
    """The running values by plain windows per key."""
    over = Window.partitionBy(*keys).orderBy(*_orders(pairs))
    upto = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_rank = Window.partitionBy(*keys).orderBy(*_orders(pairs[:rank_by or len(pairs)]))
    made: dict[str, Column] = {name: F.sum(c).over(upto) for c, name in sums}
    made |= {name: F.max(c).over(upto) for c, name in maxes}
    made |= {name: F.lag(c).over(over) for c, name in lags}
    made |= {name: F.last(c, ignorenulls=True).over(upto) for c, name in ffill}
    made |= {name: fn().over(w).cast("long") for name, fn, w in (
        (row_number, F.row_number, over), (rank, F.rank, by_rank), (dense_rank, F.dense_rank, by_rank)) if name}
    out = df.withColumns(made) if made else df
    for names, differs, name in flags:
        now, prev = [F.col(c) for c in names], [F.lag(c).over(over) for c in names]
        first = F.lag(F.lit(1)).over(over).isNull()
        out = out.withColumn("_flag", F.when(first, 1).when(differs(now, prev), 1).otherwise(0))
        out = out.withColumn(name, F.sum("_flag").over(upto).cast("long")).drop("_flag")
    return out


def keyed_running(df: DataFrame, keys: Sequence[str], order: Sequence[str | tuple[str, str]], *,
                  sums: Sequence[tuple[str, str]] = (), row_number: str | None = None, rank: str | None = None,
                  dense_rank: str | None = None, lags: Sequence[tuple[str, str]] = (),
                  session: tuple[str, float, str] | None = None, rank_by: int | None = None,
                  num_partitions: int | None = None, ffill: Sequence[tuple[str, str]] = (),
                  change_count: tuple[Sequence[str], str] | None = None,
                  maxes: Sequence[tuple[str, str]] = (), spread: bool | str = "auto") -> DataFrame:
    """``df`` with running values per key in the given order.

    ``spread``: whether a key's rows are dealt over many tasks; "auto" decides by the plan's size estimate.

    ``sums``, ``maxes``, ``lags`` and ``ffill`` are (column, new name); ``session`` is (seconds column, gap, new name);
    ``change_count`` is (columns, new name) and counts the rows whose values differ from the row before,
    filled values for columns named in ``ffill``. ``rank`` and ``dense_rank`` go by the first ``rank_by``
    order columns. NULL keys are one key. Give a total order: among rows that tie in all of it any may come first.
    """
    keys = list(keys)
    pairs = [(o, "asc") if isinstance(o, str) else tuple(o) for o in order]
    flags: list[Flag] = []
    if session:
        ts, gap, name = session
        flags.append(([ts], lambda now, prev: prev[0].isNull() | ((now[0] - prev[0]) > gap), name))
    changed: list[Flag] = []
    if change_count:
        filled = dict(ffill)

        def differs(now: list[Column], prev: list[Column]) -> Column:
            any_of = F.lit(False)
            for a, b in zip(now, prev):
                any_of = any_of | ~a.eqNullSafe(b)
            return any_of

        changed.append(([filled.get(c, c) for c in change_count[0]], differs, change_count[1]))
    if spread == "auto":
        spread = estimated_bytes(df) > ONE_TASK_BYTES
    if not spread:
        return _windows(df, keys, pairs, sums, row_number, rank, dense_rank, rank_by, lags, ffill, flags + changed, maxes)
    if rank or dense_rank:
        df = _ranks(df, keys, pairs[:rank_by or len(pairs)], rank, dense_rank, num_partitions)
    if not (sums or maxes or row_number or lags or session or ffill or change_count):
        return df
    seg = _segments(df, keys, pairs, num_partitions)
    # Filled values must be there before they can be compared.
    later = changed if ffill else []
    out = _run(seg, keys, pairs, sums, row_number, lags, ffill, flags + ([] if ffill else changed), maxes)
    if later:
        out = _run(out, keys, pairs, flags=later)
    return out.drop(SEG)
