"""Compare registered queries with their SQL: ``python -m litquarry.catalog.check [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from litquarry.catalog import oracles, queries
from litquarry.session import local_session


def connect(folder: str):
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    return tuple(plain(v) for v in value) if isinstance(value, (list, tuple)) else value


def compare(spark, connection, folder: str, name: str) -> tuple[bool, str]:
    """Equal columns and equal bags of rows."""
    df = queries[name](spark, folder)
    columns = sorted(df.columns)
    rows = Counter(plain(tuple(r)) for r in df.select(*columns).collect())
    if name not in oracles:
        return rows.total() > 0, f"{rows.total()} rows, no SQL"
    result = connection.execute(oracles[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return False, f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    expected = Counter(plain(tuple(r[i] for i in order)) for r in result.fetchall())
    missing, extra = expected - rows, rows - expected
    sample = f" missing {list(missing)[:2]} extra {list(extra)[:2]}" if missing or extra else ""
    return not sample, f"{rows.total()} of {expected.total()} rows{sample}"


def main(folder: str, names: list[str]) -> int:
    spark = local_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for name in names or list(queries):
        start = time.time()
        try:
            good, note = compare(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            good, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failures += not good
        print(f"{'ok  ' if good else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    return failures


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(main(arguments[0] if arguments else "/root/testdata/sf0.01", arguments[1:]))
