"""A model built while every task over the input fails at its first attempt.

Needs a session that retries tasks, which the shared one does not, hence its own process.
"""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys

from pyspark import TaskContext
from pyspark.sql import SparkSession

shared = sys.argv[1]
spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.sql.shuffle.partitions", "5")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", shared)
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")

from dimloom.plans import quality
from dimloom.plans.model import build_model
from dimloom.plans.run import write_model
from workload import roles

path = shared + "/flat"
roles.flat(roles.Tables(spark, "/root/testdata/sf0.001")).repartition(6).write.parquet(path)
flat = spark.read.parquet(path)


def fail_at_first(batches):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost on purpose")
    yield from batches


steady = build_model(flat)
retried = write_model(build_model(flat.mapInPandas(fail_at_first, flat.schema)), shared + "/model")
for name, table in steady.items():
    again = retried[name]
    assert table.count() == again.count() > 0, name
    assert table.exceptAll(again).count() == 0, name
assert set(quality.report(steady).collect()) == set(quality.report(retried).collect())
print("equal")
"""


def test_retried_tasks_give_the_same_model(tmp_path):
    finished = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)],
        cwd=REPO,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert finished.stdout.strip().endswith("equal"), finished.stderr[-3000:]
