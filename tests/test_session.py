import os
import subprocess
import sys

import pytest

from terrafold.session import fresh_path, release

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from terrafold.session import cut_lineage, fresh_path, release, shared_folder
builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
if sys.argv[1] in ("key", "both"):
    builder = builder.config("spark.checkpoint.dir", sys.argv[2] + "/key")
spark = builder.getOrCreate()
if sys.argv[1] in ("call", "both"):
    spark.sparkContext.setCheckpointDir(sys.argv[2] + "/call")
assert cut_lineage(spark.range(5)).count() == 5
path = fresh_path(spark, "t")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
assert path.startswith(shared_folder(spark)), (path, shared_folder(spark))
assert spark.sparkContext.getCheckpointDir() == shared_folder(spark)
if sys.argv[1] != "none":
    assert ("/key/" if sys.argv[1] == "key" else "/call/") in path, path
assert release(spark) == 2 and release(spark) == 0
left = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
assert not list(left.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(left))
"""


@pytest.mark.parametrize("given", ["none", "key", "call", "both"])
def test_shared_folder_of_a_plain_session(tmp_path, given):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": f"{root}:{os.environ.get('PYTHONPATH', '')}"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, given, str(tmp_path)], env=env, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr[-1500:]


def test_release_deletes_what_a_run_has_written(spark):
    path = fresh_path(spark, "gone")
    spark.range(2).write.parquet(path)
    assert release(spark) >= 1
    assert release(spark) == 0
    assert not os.path.exists(path.removeprefix("file:"))
