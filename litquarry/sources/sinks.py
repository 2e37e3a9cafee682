"""Sinks. All are written by the tasks; nothing passes through the driver."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from litquarry.functions.answers import chat_line
from litquarry.functions.hashing import hash_number, seeded_hash
from litquarry.operators.sampling import SEED
from litquarry.session import materialize
from litquarry.sources.tables import CSV_OPTIONS


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
    df.write.mode(mode).csv(path, **options)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row, null fields included."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def _shuffled_lines(df: DataFrame, key: str, seed: int | str, first: list[str], messages: str) -> DataFrame:
    """Chat lines in the seeded order of the key, after the columns of ``first``: files in name order follow it.

    The digests are spread evenly, so equal ranges of them are the partitions. A sort would render
    all lines a second time to sample its ranges.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(chat_line(df, messages).alias("value"), *first, seeded_hash(seed, key).alias("_hash"), F.col(key).alias("_key"))
    part = F.floor(hash_number(F.col("_hash")) * parts / (1 << 32)).cast("int")
    return rows.repartitionById(parts, part).sortWithinPartitions(*first, "_hash", "_key").select("value", *first)


def write_chat_lines(
    df: DataFrame, path: str, key: str, messages: str = "messages", seed: int | str = SEED, mode: str = "overwrite"
) -> None:
    """Chat samples as JSON lines with all their fields, shuffled: in the seeded order of ``key``."""
    _shuffled_lines(df, key, seed, [], messages).write.mode(mode).text(path)


def replace_lines(spark: SparkSession, path: str, write: Callable[[str], None], rows: int) -> None:
    """Put what ``write`` writes in the place of the text folder or file at ``path``, as a whole.

    The new lines go to a folder beside it and must be ``rows`` many before anything is renamed. The
    old ones keep a name of their own until the new ones are in place, and come back if they cannot
    be put there; if writing or counting fails, the path is as it was.
    """
    mark = uuid.uuid4().hex
    new, old, place = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new-{mark}", f"{path}.old-{mark}", path))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write(new.toString())
        found = spark.read.text(new.toString()).count()
        if found != rows:
            raise ValueError(f"{found} lines were written instead of {rows}; {path} is left as it was")
        if not files.rename(place, old):
            raise OSError(f"cannot rename {path}")
        if not files.rename(new, place):
            files.rename(old, place)
            raise OSError(f"cannot put {new} in the place of {path}")
    finally:
        files.delete(new, True)
    files.delete(old, True)


def export_splits(
    df: DataFrame, path: str, key: str = "key", messages: str = "messages", split: str = "split", seed: int | str = SEED
) -> None:
    """One folder of JSON lines per split, each shuffled like ``write_chat_lines``."""
    lines = _shuffled_lines(df.withColumnRenamed(split, "split"), key, seed, ["split"], messages)
    lines.write.mode("overwrite").partitionBy("split").text(path)


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The JSON texts of a task as one array, a line each; the last line is held back to close it."""
    opening, held = "[", "[]"
    for batch in batches:
        if not batch.num_rows:
            continue
        lines = batch.column(0).to_pylist()
        before = [] if held == "[]" else [held + ","]
        lines[0] = opening + lines[0]
        opening, held = "", lines.pop()
        yield pa.RecordBatch.from_pydict({"value": pa.array(before + [line + "," for line in lines], pa.string())})
    yield pa.RecordBatch.from_pydict({"value": pa.array([held if held == "[]" else held + "]"], pa.string())})


def write_json_array(df: DataFrame, *paths: str, mode: str = "overwrite") -> None:
    """The rows as JSON arrays: every part file is one array, so ``read_extractions`` reads the folder.

    For several copies the rows are computed once.
    """
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    if len(paths) > 1:
        rows = materialize(rows, "array")
    for path in paths:
        rows.mapInArrow(_as_array, "value string").write.mode(mode).text(path)
