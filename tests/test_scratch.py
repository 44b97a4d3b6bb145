import subprocess
import sys

import pytest
from conftest import ROOT

JOB = """
import sys
from pyspark.sql import SparkSession
from orderlens import storage
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
folder = storage.scratch_folder(spark, "kept")
print(storage.written(spark, spark.range(5), folder).count(), storage.exists(spark, folder))
if sys.argv[2] == "stop":
    spark.stop()
"""


@pytest.mark.parametrize("end", ["stop", "leave"])
def test_intermediate_tables_end_with_the_driver(tmp_path, end):
    command = [sys.executable, "-c", JOB, str(tmp_path), end]
    run = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0 and run.stdout.split() == ["5", "True"], run.stderr
    assert list((tmp_path / "orderlens").iterdir()) == []
