"""Tasks run where the package is not: a fresh process in another folder, with the package on the driver's path alone."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
    "spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "4").config(
    "spark.checkpoint.dir", sys.argv[2] + "/shared").getOrCreate()
import __spark_entry__
queries = __spark_entry__.queries()
for name in sys.argv[4:]:
    print(name, queries[name](spark, sys.argv[3]).count())
"""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_tasks_need_no_package(tmp_path):
    names = ["op3_near_vectors", "op4_language", "op5_lm_scores", "op8_decontamination", "op11_fill_in_middle", "op12_hard_negatives"]
    bare = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    ran = subprocess.run([sys.executable, "-c", SCRIPT, str(REPO), str(tmp_path), FOLDER, *names], cwd=tmp_path, env=bare,
                         capture_output=True, text=True, timeout=600)
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert [line.split()[0] for line in ran.stdout.splitlines() if line.startswith("op")] == names
