"""Column statistics and cost-based join order (survey LAY11).

``CostBased`` gives data in files to a session of its own in which the cost-based optimizer
is on: statistics of its columns (rows, least and greatest value, NULLs, distinct values,
equal-height histograms where asked for) are computed by ``ANALYZE``, and the joins of a query over these
tables are ordered by estimated sizes, whatever order they are written in. The caller's session
keeps its settings; its catalog has the tables only while ``CostBased`` is open, and
DataFrames made meanwhile keep the statistics.

Estimates change which plan runs, never its rows: stale statistics cost time only.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Settings of the session that plans by cost.
COST_CONF = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.cbo.planStats.enabled": "true",
}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class CostBased:
    """Tables in files (``paths``: name to Parquet folder) with statistics, for queries planned by cost.

    ::

        with CostBased(spark, {"orders": p1, "customer": p2}) as cost:
            cost.analyze("orders", ["o_custkey"], histograms=["o_totalprice"])
            df = cost.table("orders").join(...)
    """

    def __init__(self, spark: SparkSession, paths: Mapping[str, str], conf: Mapping[str, str] | None = None):
        self.caller, self.session = spark, spark.newSession()
        # A new session starts from the application's settings: take over what the caller's set at run time.
        for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"):
            self.session.conf.set(key, spark.conf.get(key))
        for key, value in {**COST_CONF, **(conf or {})}.items():
            self.session.conf.set(key, value)
        run = uuid.uuid4().hex[:12]
        self.paths = dict(paths)
        self.names = {name: f"cost_{run}_{i}" for i, name in enumerate(paths)}

    def __enter__(self) -> CostBased:
        for name, path in self.paths.items():
            self.session.catalog.createTable(self.names[name], path=path, source="parquet")
        return self

    def __exit__(self, *exc) -> None:
        for name in self.names.values():
            self.session.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay

    def analyze(self, name: str, columns: Sequence[str] | None = None, histograms: Sequence[str] = ()) -> None:
        """Compute statistics over the whole table: of ``columns`` (None: all that can have some), and of the columns
        ``histograms`` with a histogram as well, for one more scan.

        Histograms are for columns that filters compare. Keys of joins are better without: a join's estimate from two
        histograms does not see that a filter thinned one side, the estimate from distinct values does.
        """
        for which, with_histogram in ((columns, False), (histograms, True)):
            if which is None or len(which):
                targets = "ALL COLUMNS" if which is None else f"COLUMNS {', '.join(map(_quoted, which))}"
                self.session.conf.set("spark.sql.statistics.histogram.enabled", str(with_histogram).lower())
                self.session.sql(f"ANALYZE TABLE {self.names[name]} COMPUTE STATISTICS FOR {targets}")

    def table(self, name: str) -> DataFrame:
        return self.session.table(self.names[name])

    def statistics(self, name: str, columns: Sequence[str]) -> DataFrame:
        """A row per column as the optimizer knows it: table_name, column, rows, nulls, distinct values (an
        estimate), least and greatest value as text (NULL for text columns), number of histogram bins.
        A column that was not analyzed has NULLs."""
        detail = {r["col_name"]: r["data_type"] for r in self.session.sql(f"DESCRIBE EXTENDED {self.names[name]}").collect()}
        size = detail.get("Statistics", "")
        n_rows = int(size.split(",")[1].split()[0]) if "rows" in size else None
        rows = []
        for c in columns:
            lines = self.session.sql(f"DESCRIBE EXTENDED {self.names[name]} {_quoted(c)}").collect()
            known = {r["info_name"]: r["info_value"] for r in lines if r["info_value"] != "NULL"}
            bins = sum(1 for r in lines if r["info_name"].startswith("bin_")) or None
            whole = [int(known[k]) if k in known else None for k in ("num_nulls", "distinct_count")]
            rows.append((name, c, n_rows, *whole, known.get("min"), known.get("max"), bins))
        # By the caller's session: createDataFrame makes its session the active one.
        return self.caller.createDataFrame(rows, "table_name string, column string, rows long, nulls long, distinct_estimate long, "
                                                  "min string, max string, bins int")


def join_order(df: DataFrame) -> list[str]:
    """Folders that the joins of ``df`` read, in the order of its optimized plan."""
    plan, found = df._jdf.queryExecution().optimizedPlan(), []

    def walk(node):
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
        if kids.size() == 0 and node.getClass().getSimpleName() == "LogicalRelation":
            found.append(node.relation().location().rootPaths().head().toString())

    walk(plan)
    return found


def estimated_rows(df: DataFrame) -> int | None:
    """Rows that the optimizer of ``df``'s own session expects of it; None where it has no statistics."""
    sessions, own = df.sparkSession._jvm.org.apache.spark.sql.SparkSession, df.sparkSession._jsparkSession
    active = sessions.getActiveSession()
    sessions.setActiveSession(own)  # estimates are made lazily, under the settings of the active session
    try:
        rows = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
    finally:
        sessions.setActiveSession(active.get()) if active.isDefined() else sessions.clearActiveSession()
    return int(str(rows.get())) if rows.isDefined() else None
