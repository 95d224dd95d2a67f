"""Schema enforcement, table rules and data-quality checks on DataFrames.

A rule is a named SQL boolean expression. A row satisfies it only when the
expression is TRUE (NULL fails), matching ``WHERE status IS NOT NULL AND
amount > 0`` filters and expectation semantics. Every count below is one
aggregate pass over the data, never one scan per rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.numeric import rnd
from ..sources.sinks import overwrite_partitions


@dataclass(frozen=True)
class Rule:
    name: str
    expr: str

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.expr), F.lit(False))


def not_null(col: str) -> Rule:
    return Rule(f"{col}_not_null", f"{col} IS NOT NULL")


class ConstraintViolation(ValueError):
    pass


class SchemaMismatch(ValueError):
    pass


@dataclass
class RuleSet:
    """Named rules attached to a table (``ADD CONSTRAINT`` / ``DROP CONSTRAINT``)."""

    rules: list[Rule] = field(default_factory=list)

    def add(self, rule: Rule, existing: DataFrame | None = None) -> RuleSet:
        """Add a rule; adding it over data that violates it fails."""
        if existing is not None:
            validate(existing, [rule])
        self.rules = [r for r in self.rules if r.name != rule.name] + [rule]
        return self

    def drop(self, name: str) -> RuleSet:
        self.rules = [r for r in self.rules if r.name != name]
        return self

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(r.name, r.expr) for r in self.rules], "name string, expression string")


def all_hold(rules: Sequence[Rule]) -> Column:
    cond = F.lit(True)
    for r in rules:
        cond = cond & r.holds()
    return cond


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the names of the rules they fail)."""
    failed = F.filter(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    valid = df.filter(all_hold(rules))
    rejected = df.filter(~all_hold(rules)).withColumn("_failed_rules", failed)
    return valid, rejected


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Long form (rule, expression, failed, total) from a single aggregate."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count(F.when(~r.holds(), 1)).alias(f"_f{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.expr).alias("expression"), F.col(f"_f{i}").alias("failed"))
                     for i, r in enumerate(rules)])
    return wide.select(F.explode(rows).alias("_r"), F.col("_total").alias("total")).select("_r.rule", "_r.expression", "_r.failed", "total")


def validate(df: DataFrame, rules: Sequence[Rule], on_fail: str = "raise") -> DataFrame:
    """Check a batch before writing it: a single violating row rejects the batch."""
    counts = violation_counts(df, rules).filter(F.col("failed") > 0).collect()  # one row per rule
    if counts and on_fail == "raise":
        detail = ", ".join(f"{r['rule']} ({r['failed']} rows)" for r in counts)
        raise ConstraintViolation(f"batch violates: {detail}")
    return df


def expect(df: DataFrame, expectations: Mapping[str, str], action: str = "warn") -> DataFrame:
    """Pipeline expectations: ``warn`` keeps rows, ``drop`` removes failing rows,
    ``fail`` aborts the job at the first failing row."""
    rules = [Rule(k, v) for k, v in expectations.items()]
    if action == "warn":
        return df
    if action == "drop":
        return df.filter(all_hold(rules))
    if action == "fail":
        checks = [F.assert_true(r.holds(), F.lit(f"expectation {r.name} failed")) for r in rules]
        # assert_true returns NULL when the row passes; filtering on it keeps the
        # check in the plan (a dropped helper column would be pruned away).
        return df.filter(F.coalesce(*checks).isNull())
    raise ValueError(action)


@dataclass(frozen=True)
class Expectation:
    """A rule with what happens to rows that fail it: ``warn`` keeps them, ``drop`` leaves them out,
    ``fail`` aborts the write."""

    name: str
    expr: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(self.action)

    def rule(self) -> Rule:
        return Rule(self.name, self.expr)


METRICS = ("load_id string, table_name string, rule string, expression string, action string, failed long, "
           "total long, written long")


def write_expected(df: DataFrame, path: str, expectations: Sequence[Expectation], metrics_path: str, load_id: str,
                   table_name: str, mode: str = "append") -> DataFrame:
    """Write a batch and count each expectation's failing rows in the same scan; returns the counts.

    The counts come from an observation just before the write, in the job's last
    stage, which counts every partition once even if tasks are repeated. They are
    kept under ``metrics_path`` in a folder per load, so a load that is replayed
    replaces its counts. Dropped rows count in ``failed`` of every rule that they
    break. A row that breaks a ``fail`` rule aborts the job: no row, no counts.
    An empty batch has zeros.
    """
    expectations = list(expectations)
    observation = Observation()
    counted = df.observe(observation, F.count(F.lit(1)).alias("total"),
                         F.count(F.when(all_hold([e.rule() for e in expectations if e.action == "drop"]), 1)).alias("written"),
                         *[F.count(F.when(~e.rule().holds(), 1)).alias(f"f{i}") for i, e in enumerate(expectations)])
    for action in ("fail", "drop"):
        rules = {e.name: e.expr for e in expectations if e.action == action}
        counted = expect(counted, rules, action) if rules else counted
    counted.write.mode(mode).parquet(path)
    got = observation.get
    rows = [(load_id, table_name, e.name, e.expr, e.action, got.get(f"f{i}", 0), got.get("total", 0), got.get("written", 0))
            for i, e in enumerate(expectations)]
    metrics = df.sparkSession.createDataFrame(rows, METRICS)
    if rows:
        overwrite_partitions(metrics, metrics_path, ["load_id"])
    return metrics


def quality_report(tables: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Per table one aggregate over all its checks, stacked to (table, check, total, passed, pass_rate)."""
    parts = []
    for tname, (df, checks) in tables.items():
        rules = [Rule(k, v) for k, v in checks.items()]
        long = violation_counts(df, rules)
        parts.append(long.select(F.lit(tname).alias("table_name"), F.col("rule").alias("check_name"),
                                 "total", (F.col("total") - F.col("failed")).alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("pass_rate", rnd(F.try_divide(F.col("passed").cast("double"), F.col("total")), 4))


def profile(df: DataFrame, cols: Sequence[str], invalid: Mapping[str, str] | None = None) -> DataFrame:
    """One-pass table profile: total rows, non-null and distinct counts per column, invalid counts."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for c in cols:
        aggs += [F.count(c).alias(f"{c}_non_null"), F.countDistinct(c).alias(f"{c}_distinct")]
    for k, v in (invalid or {}).items():
        aggs.append(F.count(F.when(F.coalesce(F.expr(v), F.lit(False)), 1)).alias(k))
    return df.agg(*aggs)


def enforce(df: DataFrame, schema: StructType, mode: str = "strict") -> DataFrame:
    """Make a batch fit a table schema.

    * ``strict``: same column names and types or ``SchemaMismatch`` listing the difference;
    * ``project``: keep the schema's columns (extra ones dropped), missing ones fail;
    * ``cast``: also convert types with ``try_cast`` (values that do not fit become NULL).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in want if c not in have]
    extra = [c for c in have if c not in want]
    wrong = [c for c in want if c in have and have[c] != want[c]]
    if mode == "strict" and (missing or extra or wrong):
        raise SchemaMismatch(f"missing={missing} extra={extra} type_mismatch={wrong}")
    if mode in ("project", "cast") and missing:
        raise SchemaMismatch(f"missing={missing}")
    if mode == "project" and wrong:
        raise SchemaMismatch(f"type_mismatch={wrong}")
    if mode == "cast":
        return df.select(*[F.col(c).try_cast(want[c]).alias(c) if c in wrong else F.col(c) for c in want])
    return df.select(*want)


def cast_misfits(df: DataFrame, schema: StructType) -> DataFrame:
    """Per column, how many non-NULL values would become NULL under ``enforce(mode='cast')``."""
    aggs = []
    for f in schema.fields:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            c = F.col(f.name)
            aggs.append(F.count(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), 1)).alias(f.name))
    return df.agg(*aggs) if aggs else df.sparkSession.range(1).select()


def evolve_append(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Append with new columns: earlier rows get NULL in them."""
    return existing.unionByName(batch, allowMissingColumns=True)
