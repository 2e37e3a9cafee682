"""Intermediate tables."""

import os

from pyspark.sql import functions as F

from conftest import rows
from litquarry.session import discard, in_turns, materialize, materialize_all


def shuffle_files(spark):
    """Data files of shuffles in the session's local folders."""
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    return {name for top in folders for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_shuffle_files_go_with_the_write(spark):
    before, setting = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    table = materialize(spark.range(1000).repartition(3).groupBy("id").count(), "kept")
    assert not shuffle_files(spark) - before
    assert table.count() == 1000 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_turns_are_one_table_and_no_shuffle_files(spark):
    before, df = shuffle_files(spark), spark.range(1000).withColumn("key", F.xxhash64(F.col("id") % 50))
    parts = [p.groupBy("key").agg(F.count("id").alias("n")) for p in in_turns(df, F.col("key"), 4)]
    table = materialize_all(parts, "turns")
    assert len(parts) == 4 and not shuffle_files(spark) - before
    assert rows(table) == rows(df.groupBy("key").agg(F.count("id").alias("n")))


def test_discarded_tables_leave_the_disk_and_others_stay(spark):
    kept, gone = materialize(spark.range(5), "x"), materialize(spark.range(5), "x")
    file = gone.inputFiles()[0].removeprefix("file://")
    discard(gone, kept.select("id"), spark.range(5))
    assert not os.path.exists(file) and kept.count() == 5
