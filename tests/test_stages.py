from pyspark.sql import functions as F

import pytest

from cohortlink.plans.stages import Run, broadcast_if_small, fits_broadcast, shared_folder
from cohortlink.sources import files

from .conftest import rows


def test_size_is_measured(spark):
    df = spark.range(1000).select("id", F.lit("x" * 84).alias("text"))
    # 32 bytes for the two columns and 84 for the text, a thousand times.
    assert fits_broadcast(df, 116_000)
    assert not fits_broadcast(df, 115_999)
    assert fits_broadcast(df.limit(0), 0)


def test_only_small_rows_are_marked(spark):
    df = spark.range(1000)
    plan = lambda x: x._jdf.queryExecution().optimizedPlan().toString()
    other = spark.range(10)
    assert "broadcast" in plan(other.join(broadcast_if_small(df), "id"))
    assert "broadcast" not in plan(other.join(broadcast_if_small(df, 10), "id"))


def test_a_run_owns_and_removes_its_tables(spark, tmp_path):
    with Run(spark) as run:
        df = run.table(spark.range(5).withColumn("x", F.col("id") * 2), "numbers")
        assert rows(df) == [(i, 2 * i) for i in range(5)]
        assert shared_folder(spark) in df.inputFiles()[0] and run.folder in df.inputFiles()[0]
        name = run.catalog_name("kept")
        spark.range(3).write.option("path", run.path("kept")).saveAsTable(name)
        assert files.exists(spark, run.folder)
    assert not files.exists(spark, run.folder) and not spark.catalog.tableExists(name)


def test_a_run_cleans_up_after_an_error(spark, tmp_path):
    with pytest.raises(ZeroDivisionError), Run(spark, f"file://{tmp_path}") as run:
        run.table(spark.range(5), "numbers")
        1 / 0
    assert not files.exists(spark, run.folder)


def test_a_run_checks_that_its_folder_is_shared(spark, tmp_path, monkeypatch):
    with Run(spark, f"file://{tmp_path}") as run:
        run.check_shared()
        monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
        monkeypatch.setattr("cohortlink.plans.stages.shared_folder", lambda spark: None)
        with pytest.raises(ValueError, match="share"):
            Run(spark)


def test_small_files_are_created_once(spark, tmp_path):
    path = f"file://{tmp_path}/mark"
    assert files.create(spark, path, "a") and not files.create(spark, path, "b")
    assert files.text_of(spark, path) == "a" and files.names(spark, f"file://{tmp_path}") == ["mark"]
    files.delete(spark, path)
    assert files.text_of(spark, path) is None and not files.exists(spark, path)
