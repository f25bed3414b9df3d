from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridcast.session import settle
from gridcast.sources import tables
from tests.conftest import rows


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sink")
    yield "sink"
    spark.sql("DROP DATABASE sink CASCADE")


def test_overwrite_keeps_the_schema(spark, database):
    tables.overwrite_table(spark.createDataFrame([(1, "a")], "k int, v string"), "sink.t")
    tables.overwrite_table(spark.createDataFrame([("b", 2)], "v string, k int"), "sink.t")
    assert spark.table("sink.t").columns == ["k", "v"] and rows(spark.table("sink.t")) == [(2, "b")]


def test_replace_changes_the_schema(spark, database):
    tables.replace_table(spark.range(2), "sink.r")
    tables.replace_table(spark.createDataFrame([("x",)], "w string"), "sink.r")
    assert rows(spark.table("sink.r")) == [("x",)]


def test_append_adds_runs_and_skips_empty_ones(spark, database):
    one = spark.createDataFrame([("r1", 1)], "run_id string, v int")
    assert tables.append_run(one, "sink.a")
    assert tables.append_run(one.withColumn("run_id", F.lit("r2")), "sink.a")
    assert not tables.append_run(one.where("false"), "sink.a")
    assert rows(spark.table("sink.a"), "run_id", "v") == [("r1", 1), ("r2", 1)]


def test_optional_table(spark, database):
    assert tables.read_optional_table(spark, "sink.none") is None
    tables.replace_table(spark.createDataFrame([(2,), (1,)], "k int"), "sink.o")
    assert tables.read_optional_table(spark, "sink.o", required=["other"]) is None
    assert [r.k for r in tables.read_optional_table(spark, "sink.o", ["k"], ["absent", "k"]).collect()] == [1, 2]


def test_layers_are_views_or_tables(spark):
    assert tables.materialize(spark.range(1), "staging", "one", as_view=True).count() == 1
    assert spark.catalog.tableExists("staging_one")
    assert tables.materialize(spark.range(3), "marts", "three").count() == 3
    assert spark.catalog.tableExists("marts.three")
    spark.sql("DROP DATABASE marts CASCADE")


def test_settle_cuts_lineage_through_the_shared_folder(spark):
    df = settle(spark.range(5).selectExpr("id * 2 as v"))
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    assert rows(df) == [(0,), (2,), (4,), (6,), (8,)]
    assert "checkpoint" in spark.sparkContext.getCheckpointDir()
