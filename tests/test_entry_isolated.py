"""The driver loads __spark_entry__.py by path from another directory with a
plain session: Python workers must not need to import the package."""

import os
import subprocess
import sys
import tempfile

SCRIPT = r'''
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spec = importlib.util.spec_from_file_location("entry_under_test", ENTRY)
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)
print("entry", E.entry(spark).count())
print("translate", E.queries()["translate_batches"](spark, "/root/testdata/sf0.001").count())
spark.stop()
'''


def test_entry_from_other_directory():
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    cwd = tempfile.mkdtemp(prefix="parcorpus-iso-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", f"ENTRY = {entry!r}\n" + SCRIPT], cwd=cwd, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "entry 876" in out.stdout
    assert "translate " in out.stdout
