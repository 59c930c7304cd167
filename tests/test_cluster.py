"""Queries that go through a database, on an executor that shares only folders with the driver."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest

from lodestone.operators.limits import ReaderOptions
from lodestone.sources import jdbc
from lodestone.types import Logical

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent
RUN = """
import sys
from pyspark.sql import SparkSession
conf = {"spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.executor.memory": "1g", "spark.checkpoint.dir": f"file://{sys.argv[1]}/shared", "spark.driver.host": "127.0.0.1"}
spark = SparkSession.builder.master("local-cluster[1,1,1024]").config(map=conf).getOrCreate()
import __spark_entry__ as entry
for name in sys.argv[3:]:
    print("ROWS", name, len(entry.queries()[name](spark, sys.argv[2]).collect()))
spark.stop()
"""


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_databases_reach_other_processes(tmp_path):
    home = tmp_path / "home"
    home.mkdir()
    for p in Path(pyspark.__file__).parent.iterdir():  # executors work in Spark's home
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = os.environ | {"SPARK_HOME": str(home), "PYTHONPATH": str(ROOT), "PYSPARK_PYTHON": sys.executable, "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1"}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    names = ["trim_char", "scan_partitioned", "insert_roundtrip", "scan_prefetch"]
    done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path), DATA, *names], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    rows = dict(line.split()[1:] for line in done.stdout.splitlines() if line.startswith("ROWS"))
    assert rows == {"trim_char": "25", "scan_partitioned": "1500", "insert_roundtrip": "1500", "scan_prefetch": "150"}, done.stderr[-3000:]


def test_embedded_database_gets_portions_and_goes_into_an_archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jdbc, "PORTION", 7)
    rows = spark.sql("SELECT id, concat('é', id) AS name, IF(id % 5 = 0, NULL, timestamp_micros(id * 1234567 - 9)) AS ts, id / 7 AS x FROM range(50)")
    rows = rows.withColumn("ts", rows.ts.cast("timestamp_ntz"))
    url = f"jdbc:derby:{tmp_path}/db"
    jdbc.execute(spark, f"{url};create=true", "CREATE TABLE T (X DOUBLE, ID BIGINT, NAME VARCHAR(9), TS TIMESTAMP)", driver=jdbc.DERBY_DRIVER)
    jdbc.insert(rows, url, "T", 3, jdbc.DERBY_DRIVER)
    jdbc.insert(rows.where("id < 0"), url, "T", 3, jdbc.DERBY_DRIVER)
    schema = [("id", Logical("int64")), ("name", Logical("utf8")), ("ts", Logical("timestamp", unit="us")), ("x", Logical("float64"))]
    back = jdbc.scan(spark, jdbc.published(spark, str(tmp_path), "db"), "SELECT ID, NAME, TS, X FROM T", ReaderOptions(schema=schema), jdbc.DERBY_DRIVER)
    assert os.listdir(tmp_path) == ["db.jar"]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.select("id", "name", "ts", "x").collect()), key=str)
