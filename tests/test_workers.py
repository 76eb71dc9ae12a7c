import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent
SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as contract
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
for name in ("k03_infeasible_fallback", "h06_adf", "g11_student_t"):
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("workers ok")
"""


def test_kernels_reach_workers_without_the_package(tmp_path):
    """Started elsewhere, worker processes cannot import the package."""
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "workers ok" in done.stdout, done.stderr[-2000:]
