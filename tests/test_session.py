"""The shared folder comes from the session, never from the library."""

import os
import subprocess
import sys

import pytest

from stintwise.session import clear_scratch, materialize

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import sys
from pyspark.sql import SparkSession
b = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.driver.host", "127.0.0.1").config("spark.sql.shuffle.partitions", "2")
if len(sys.argv) > 1:
    b = b.config("spark.checkpoint.dir", sys.argv[1])
spark = b.getOrCreate()
from stintwise.plans.registry import QUERIES
print("ROWS", QUERIES["breaks"](spark, "/root/testdata/sf0.001").count())
"""


def _run(conf_dir, *args):
    env = {**os.environ, "SPARK_CONF_DIR": str(conf_dir), "PYTHONPATH": ROOT}
    return subprocess.run([sys.executable, "-c", RUN, *args], env=env, capture_output=True, text=True, timeout=300)


def test_without_a_shared_folder_there_is_one_clear_error(tmp_path):
    got = _run(tmp_path)
    assert got.returncode != 0
    assert "spark.checkpoint.dir is not set" in got.stderr


def test_with_a_folder_given_breaks_runs(tmp_path):
    conf = tmp_path / "conf"
    conf.mkdir()
    got = _run(conf, str(tmp_path / "shared"))
    assert got.returncode == 0, got.stderr[-2000:]
    assert int(got.stdout.split("ROWS")[1]) > 0


def test_scratch_can_be_removed(spark):
    df = materialize(spark.range(10), "gone")
    assert df.count() == 10
    assert clear_scratch(spark)
    assert not clear_scratch(spark)
    with pytest.raises(Exception):
        df.count()
