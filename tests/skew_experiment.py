"""Hot-key experiment: plain window vs segmented scan, per-task times.

    python tests/skew_experiment.py [rows]

Builds ``rows`` rows (default 12M) where one key holds a third of them, runs a
running sum per key both ways with the event log written to a fresh scratch
folder, and prints per-stage task counts, longest and mean task seconds.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def task_times(log_dir: str) -> dict[str, list[tuple[int, int, float, float]]]:
    import zstandard
    stage_group, tasks = {}, collections.defaultdict(list)
    for f in sorted(glob.glob(log_dir + "/*/events_*") + glob.glob(log_dir + "/*events*")):
        with open(f, "rb") as fh:
            raw = fh.read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if f.endswith(".zstd") else raw.decode())
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e["Stage IDs"]:
                    stage_group[sid] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks[e["Stage ID"]].append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    out = collections.defaultdict(list)
    for sid, t in sorted(tasks.items()):
        out[stage_group.get(sid)].append((sid, len(t), round(max(t), 1), round(sum(t) / len(t), 1)))
    return out


def main():
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidepool.operators.scan import keyed_running
    from tidepool.session import get_spark
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 12_000_000
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = get_spark(shuffle_partitions=16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100003).cast("long").alias("k"),
        ((F.col("id") * 2654435761) % 1000000007).alias("t"),
        (F.col("id") % 97).cast("double").alias("x"))
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    spark.sparkContext.setJobGroup("window", "window")
    df.withColumn("rt", F.sum("x").over(w)).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("scan", "scan")
    keyed_running(df, ["k"], ["t"], sums=[("x", "rt")], num_partitions=16).write.format("noop").mode("overwrite").save()
    spark.stop()
    for group, stages in task_times(log_dir).items():
        print(group, "stages (id, tasks, longest s, mean s):", stages)


if __name__ == "__main__":
    main()
