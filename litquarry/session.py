"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="litquarry-")


def local_session(app: str = "litquarry", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", _own_folder())
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = _own_folder()
    return folder.rstrip("/")


_given_paths: list[str] = []
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()

TURNS = 4
"""Most parts of a large table that are shuffled one after the other."""


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    path = f"{shared_folder(spark)}/litquarry/{name}-{uuid.uuid4().hex}"
    _given_paths.append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate tables written inside, once their results are no longer needed."""
    before = len(_given_paths)
    try:
        yield
    finally:
        for path in _given_paths[before:]:
            _remove(spark, path)
        del _given_paths[before:]


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage and survives lost executors; the file sizes also give later
    joins exact statistics to choose a broadcast by. The shuffle files of the write go when it
    ends (from Spark 4.1 on), as nothing but the table is read again.
    """
    return materialize_all([df], name)


def materialize_all(frames: list[DataFrame], name: str) -> DataFrame:
    """``materialize`` of the union of ``frames``, written one after the other, so that only one has shuffle files at a time."""
    spark = frames[0].sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_FILE_CLEANUP, "false")
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        for df in frames:
            df.write.mode("append").parquet(path)
    finally:
        spark.conf.set(_FILE_CLEANUP, before)
    table = spark.read.schema(frames[0].schema).parquet(path)
    _written[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``materialize`` returned and that no unwritten result reads; other DataFrames are left alone."""
    for table in tables:
        if path := _written.pop(table, None):
            _remove(table.sparkSession, path)


def in_turns(df: DataFrame, key: Column, turns: int) -> list[DataFrame]:
    """``df`` in disjoint parts by a column that is a hash; rows with one key are in one part."""
    return [df.filter(F.pmod(key, F.lit(turns)) == i) for i in range(turns)] if turns > 1 else [df]


def saved_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The rows saved at a path so far; none where nothing has been written yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
