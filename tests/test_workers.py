"""Workers have no copy of the package: jobs must bring their functions along."""

from __future__ import annotations

import os
import subprocess
import sys
import zipfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
from logweir.sources.logs import read_zip_logs
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
print("lookups", contract.queries()["q_geo_lookup"](spark, "/root/testdata/sf0.01").count() > 0)
print("rows", read_zip_logs(spark, "log20240319.zip").count())
"""


def test_queries_run_from_any_folder(tmp_path):
    with zipfile.ZipFile(tmp_path / "log20240319.zip", "w") as archive:
        header = "ip,date,time,cik,accession,code,idx,crawler"
        archive.writestr("a.csv", header + "\n1.2.3.a,2024-03-19,10:00:00,1.0,x,200.0,0.0,0.0\n")
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)],
        cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300,
    )
    assert "lookups True" in done.stdout and "rows 1" in done.stdout, done.stderr[-3000:]
