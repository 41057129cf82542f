"""Tasks need no copy of this package on the workers' import path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as entry
for name in ("op6_isolation_forest_quality", "op7_sum_of_squares_packing", "op10_suffix_automata_substrings"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_queries_run_where_workers_cannot_import_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split()) == 6
