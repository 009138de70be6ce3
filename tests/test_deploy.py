"""The package reaches the Python workers when the driver runs outside the repository."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SNIPPET = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
rows = E.queries()["anova_region_test"](spark, "/root/testdata/sf0.001").collect()  # pandas UDF
print("ROWS", len(rows))
"""


def test_udf_queries_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="hrlens-elsewhere-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SNIPPET], cwd=cwd, env=env, capture_output=True, text=True,
                       timeout=600)
    assert "ROWS 1" in r.stdout, r.stderr[-2000:]
