"""Slowly changing dimensions.

* ``scd2_merge``: apply a batch of current values to a type-2 dimension
  (close the open row, open a new one) - idempotent, change detection is
  NULL-safe, one full outer join between the open rows and the batch.
* ``auto_cdc_scd2``: build type-2 history from a change feed ordered by a
  sequence column (late rows are placed by sequence, NULL updates can be
  ignored, only tracked columns open a new version, untracked ones update the
  open version in place).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .merge import null_salt
from .scan import keyed_running
from .skew import hashable

OPEN_END_DATE = "9999-12-31"


def _changed(tracked: Sequence[str]) -> Column:
    diff = F.lit(False)
    for c in tracked:
        diff = diff | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    return diff


def scd2_merge(dim: DataFrame, updates: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               effective_date, current_col: str = "is_current",
               start_col: str = "effective_start_date", end_col: str = "effective_end_date",
               open_end: str | None = OPEN_END_DATE, version_col: str | None = None) -> DataFrame:
    """Type-2 merge of ``updates`` (one row per key, current values) into ``dim``.

    ``open_end=None`` leaves the end of the open row NULL; ``version_col``
    numbers versions per key (previous + 1).
    """
    keys = list(keys)
    eff = F.lit(effective_date).cast("date") if isinstance(effective_date, str) else effective_date
    attrs = [c for c in updates.columns if c not in keys]
    hist = dim.filter(~F.col(current_col))
    cur = dim.filter(F.col(current_col))
    t = cur.withColumn("_tp", F.lit(True)).withColumn("_nk", null_salt(cur, keys, 1)).alias("t")
    s = updates.withColumn("_sp", F.lit(True)).withColumn("_nk", null_salt(updates, keys, -1)).alias("s")
    cond = F.col("t._nk") == F.col("s._nk")  # NULL keys never match; the salt spreads them
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    j = t.join(s, cond, "full_outer")
    tp, sp = F.col("t._tp").isNotNull(), F.col("s._sp").isNotNull()
    changed = tp & sp & _changed(tracked)
    opened = (sp & ~tp) | changed

    end_type = dim.schema[end_col].dataType
    dim_cols = dim.columns

    # Open rows after the batch: closed when changed, else unchanged.
    keep_or_close = j.filter(tp).select(*[
        (F.when(changed, F.lit(False)).otherwise(F.col(f"t.{c}")) if c == current_col else
         F.when(changed, eff.cast(end_type)).otherwise(F.col(f"t.{c}")) if c == end_col else
         F.col(f"t.{c}")).alias(c) for c in dim_cols])

    def new_value(c):
        if c in keys or c in attrs:
            return F.col(f"s.{c}")
        if c == current_col:
            return F.lit(True)
        if c == start_col:
            return eff
        if c == end_col:
            return F.lit(open_end).cast(end_type)
        if version_col and c == version_col:
            return F.coalesce(F.col(f"t.{c}") + 1, F.lit(1))
        return F.lit(None)

    new_rows = j.filter(opened).select(*[new_value(c).cast(dim.schema[c].dataType).alias(c) for c in dim_cols])
    return hist.unionByName(keep_or_close).unionByName(new_rows)


def auto_cdc_scd2(changes: DataFrame, keys: Sequence[str], sequence_by: str,
                  tracked: Sequence[str] | None = None, except_cols: Sequence[str] = (),
                  ignore_null_updates: bool = True, delete_when: Column | None = None,
                  start_col: str = "__START_AT", end_col: str = "__END_AT",
                  tie_break: Sequence[str] = ()) -> DataFrame:
    """Type-2 history per key from an out-of-order change feed.

    Each output row is one version: tracked columns constant inside it,
    untracked columns carry their last value, ``__START_AT`` is the sequence of
    the change that opened it and ``__END_AT`` the sequence of the next version
    (NULL while open). A row matching ``delete_when`` closes the open version.

    Changes of a key with one sequence value apply in the order of the columns ``tie_break``, then updates before
    deletes, then by a hash of the row; equal changes count once. The ordered steps go through one
    ``keyed_running``, so a key with many changes is spread over many tasks.
    """
    keys = list(keys)
    rows, payload = cdc_changes(changes, keys, sequence_by, except_cols, delete_when, tie_break)
    versions = cdc_versions(rows, keys, payload, list(tracked) if tracked is not None else payload, ignore_null_updates)
    return versions.filter(~F.col("_del")).select(
        *keys, *payload, F.col("_start").alias(start_col), F.col("_end").alias(end_col))


def cdc_changes(changes: DataFrame, keys: Sequence[str], sequence_by: str, except_cols: Sequence[str] = (),
                delete_when: Column | None = None, tie_break: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """``changes`` as keys, payload columns, _seq, _tie (the order of changes with one sequence value) and _del; and the payload's names."""
    payload = [c for c in changes.columns if c not in keys and c != sequence_by and c not in except_cols]
    gone = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    same = F.xxhash64(*[F.col(f.name) for f in changes.schema.fields if hashable(f.dataType)])
    tie = F.struct(*[F.col(c).alias(f"b{i}") for i, c in enumerate(tie_break)], gone.alias("del"), same.alias("hash"))
    return changes.select(*keys, *payload, F.col(sequence_by).alias("_seq"), tie.alias("_tie"), gone.alias("_del")), payload


def cdc_versions(rows: DataFrame, keys: Sequence[str], payload: Sequence[str], tracked: Sequence[str],
                 ignore_null_updates: bool = True, spread: bool | str = "auto") -> DataFrame:
    """All versions, those of deleted keys too: keys, payload, _start, _end, _del, and _seed.

    ``rows`` are those of :func:`cdc_changes`. A row without _tie is a seed: it stands before the changes of its
    sequence value, and _seed tells the version that it is in.
    """
    # A delete ends the fill of NULL updates: what it says, NULLs too, is what later changes start from.
    fills = {c: f"_f_{c}" for c in payload} if ignore_null_updates else {}
    given = {f"_w_{c}": F.when(F.col(c).isNotNull() | F.col("_del"), F.struct(F.col(c).alias("v"))) for c in fills}
    # Two deletes in a row are two versions, unless they are equal.
    rows = rows.withColumns({**given, "_gone": F.when(F.col("_del"), F.struct("_seq", "_tie"))})
    compared = [f"_w_{c}" if fills else c for c in tracked]
    ver = keyed_running(rows, keys, ["_seq", "_tie"], ffill=[(f"_w_{c}", f) for c, f in fills.items()],
                        change_count=([*compared, "_del", "_gone"], "_ver"), spread=spread)
    value = {c: F.col(f"{fills[c]}.v") if fills else F.col(c) for c in payload}
    place = F.struct("_seq", "_tie")
    found = ver.groupBy(*keys, "_ver").agg(
        F.min("_seq").alias("_start"), F.first("_del").alias("_del"), F.max(F.col("_tie").isNull()).alias("_seed"),
        *[(F.first(value[c]) if c in tracked else F.max_by(value[c], place)).alias(c) for c in payload])
    # A version ends where the next one starts: each also reports its start to the one before.
    names = [*payload, "_start", "_del", "_seed"]
    own = F.struct(F.col("_ver").alias("_v"), F.struct(*names).alias("_row"), F.lit(None).cast(found.schema["_start"].dataType).alias("end"))
    to_last = F.struct((F.col("_ver") - 1).alias("_v"), F.lit(None).cast(StructType([found.schema[n] for n in names])).alias("_row"),
                       F.col("_start").alias("end"))
    ends = found.select(*keys, F.explode(F.array(own, to_last)).alias("_x")).groupBy(*keys, "_x._v").agg(
        F.first("_x._row", ignorenulls=True).alias("_row"), F.max("_x.end").alias("_end"))
    return ends.filter(F.col("_row").isNotNull()).select(*keys, "_row.*", "_end")


def current_rows(history: DataFrame, end_col: str = "__END_AT") -> DataFrame:
    return history.filter(F.col(end_col).isNull())


def multi_version_keys(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full history of keys that have more than one version."""
    counts = history.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_versions")).filter("n_versions > 1")
    return history.join(counts, list(keys))
