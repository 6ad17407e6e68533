"""The driver contract from a plain session in an unrelated folder: nothing may
depend on the working directory (Python workers included)."""

import subprocess
import sys

from conftest import ROOT

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", r"{ROOT}/__spark_entry__.py")
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
print("ENTRY", len(m.entry(spark).collect()))
print("UDF", len(m.queries()["custom_row_function"](spark, "/root/testdata/sf0.001").collect()))
spark.stop()
"""


def test_entry_and_udf_from_another_folder(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(line.split() for line in out.stdout.splitlines() if line.startswith(("ENTRY", "UDF")))
    assert int(lines["ENTRY"]) > 0 and int(lines["UDF"]) == 1500
