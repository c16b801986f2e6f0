"""Queries whose tasks run Python (sorted-run scans) must work when the
driver process only has the repository on its own sys.path."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as e
q = e.queries()
for k in ("drift_numeric_ks", "eval_roc_auc", "prep_fill_median"):
    print(k, q[k](spark, "/root/testdata/sf0.001").count())
"""


def test_scan_queries_from_foreign_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as d:
        res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=d, env=env, capture_output=True,
                             text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    counts = dict(line.split() for line in res.stdout.strip().splitlines())
    assert counts["drift_numeric_ks"] == "5" and counts["eval_roc_auc"] == "1"
    assert int(counts["prep_fill_median"]) > 0
