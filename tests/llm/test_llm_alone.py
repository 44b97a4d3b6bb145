"""The operators on executors that lack the package, and the rest of the repository without the operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from orderlens.llm.queries import QUERIES

ROOT = Path(__file__).resolve().parents[2]
SESSION = """
import sys
sys.path.insert(0, {root!r})  # of the driver only: Python workers do not get it
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", {scratch!r}).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
"""


def run(code, folder, scratch, root=ROOT):
    done = subprocess.run([sys.executable, "-c", SESSION.format(root=str(root), scratch=str(scratch)) + code], cwd=folder, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-4000:]
    return done.stdout


def test_executors_without_the_package(tmp_path):
    code = """
def importable(batches):
    import importlib.util, pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"found": [importlib.util.find_spec("orderlens") is not None] * batch.num_rows})
assert {r.found for r in spark.range(8).mapInArrow(importable, "found boolean").collect()} == {False}
from orderlens.llm.queries import QUERIES
import corpus_pipeline
for name, query in {**QUERIES, "pipeline": corpus_pipeline.run}.items():
    print(name, len(query(spark, "/root/testdata/sf0.001").collect()))
"""
    found = [line.split() for line in run(code, tmp_path, tmp_path / "scratch").splitlines() if line.startswith(("op", "pipeline"))]
    assert [name for name, _ in found] == [*QUERIES, "pipeline"]
    assert all(int(n) > 0 for _, n in found)


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_without_the_operators(tmp_path, pipeline):
    copy = tmp_path / "copy"
    ignored = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=ignored)
    code = """
import __spark_entry__ as e
assert not any(n.startswith("op") or n == "pipeline" for n in e.queries())
assert set(e.queries()) == set(e.oracle_sql())
print("rows", e.entry(spark).count())
"""
    assert "rows 10" in run(code, tmp_path, tmp_path / "scratch", copy)
