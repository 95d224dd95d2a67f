"""Window-based operators: sessionization and RFM scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import global_ntile
from .scan import keyed_running


def sessionize(df: DataFrame, user_col: str, ts_col: str, tiebreak: str,
               gap_minutes: int = 30) -> DataFrame:
    """Number sessions per user: a gap of more than ``gap_minutes`` starts a new one.

    Gaps are measured on whole seconds (``unix_timestamp`` truncation), so a
    gap of exactly 30 minutes stays in the session. Adds ``gap_minutes`` and
    ``session_num`` (1-based per user). A user's rows are spread over many
    tasks (``keyed_running``).
    """
    secs = df.withColumn("_secs", F.unix_timestamp(F.col(ts_col).cast("timestamp")))
    out = keyed_running(secs, [user_col], [ts_col, tiebreak], lags=[("_secs", "_prev_secs")],
                        session=("_secs", gap_minutes * 60, "session_num"))
    return out.withColumn("gap_minutes", (F.col("_secs") - F.col("_prev_secs")) / 60.0) \
              .drop("_secs", "_prev_secs")


# Segment labels and score cut-offs are fixed values of the RFM report.
RFM_SEGMENTS = [
    (13, "Champions"),
    (11, "Loyal Customers"),
    (9, "Potential Loyalists"),
    (7, "At Risk"),
    (5, "Hibernating"),
]
RFM_OTHERWISE = "Lost"


def rfm_scores(per_customer: DataFrame, key: str, high_value: float, medium_value: float) -> DataFrame:
    """Recency/frequency/monetary quintiles, total score, segment and value band.

    Input: one row per customer with ``recency_days``, ``frequency``,
    ``monetary``. Recency is scored on days descending, so the freshest
    customers get 5 (the stated intent "lower days = better"). Each quintile is
    an exact global ntile computed without a single-task window.
    """
    s = global_ntile(per_customer, 5, [F.col("recency_days").desc(), F.col(key).asc()], "r_score")
    s = global_ntile(s, 5, [F.col("frequency").asc(), F.col(key).asc()], "f_score")
    s = global_ntile(s, 5, [F.col("monetary").asc(), F.col(key).asc()], "m_score")
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    seg = None
    for cut, label in RFM_SEGMENTS:
        seg = F.when(total >= cut, label) if seg is None else seg.when(total >= cut, label)
    seg = seg.otherwise(RFM_OTHERWISE)
    band = (F.when(F.col("monetary") >= high_value, "High Value")
            .when(F.col("monetary") >= medium_value, "Medium Value")
            .otherwise("Low Value"))
    return s.select(key, "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
                    total.alias("rfm_score"), seg.alias("customer_segment"), band.alias("ltv_category"))
