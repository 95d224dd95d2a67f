"""Every query of the subpackage runs where Python workers cannot find the package."""

import os
import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[2])
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})  # the driver alone
import __spark_entry__ as entry
from tidepool.llm.queries import QUERIES
from tidepool.session import get_spark
spark = get_spark(master="local[4]")
for name in [*QUERIES, "pipeline"]:
    entry.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


def test_all_queries_run_from_a_foreign_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") >= 15
