"""The driver contract from a fresh process with a plain session (default
settings, non-UTC zone), importing ``__spark_entry__`` from outside the repo."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import sys
sys.path.insert(0, REPO)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "Europe/Paris").getOrCreate())
import __spark_entry__ as e
df = e.entry(spark)
assert df.count() > 0 and df.columns == ["City", "Country", "year", "temperature_moyenne", "source"]
q, o = e.queries(), e.oracle_sql()
assert set(o) <= set(q)
for key in ["stream_windows", "evolution", "yearly_mean"]:
    assert q[key](spark, "/root/testdata/sf0.001").count() > 0, key
print("CONTRACT OK", len(q))
"""


def test_contract_in_fresh_process(tmp_path):
    script = tmp_path / "driver.py"
    script.write_text(f"REPO = {REPO!r}\n" + SCRIPT)
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "CONTRACT OK" in out.stdout
