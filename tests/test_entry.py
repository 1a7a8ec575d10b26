"""The driver contract from a process whose working directory is not the repository."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
print("ENTRY", E.entry(spark).count())
print("KNN", E.queries()["knn_exact"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_entry_and_numpy_keys_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="cartwheel-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ENTRY 25" in out.stdout, out.stderr[-2000:]
    assert "KNN 50" in out.stdout, out.stderr[-2000:]
