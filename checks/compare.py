"""Run registered queries and their SQL side by side: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.queries import QUERIES
from titleloom.session import build_session


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    """Rows in a fixed order, with columns by name and floats rounded; pandas has nulls among integers as NaN."""
    def plain(value):
        if isinstance(value, float):
            if value != value:
                return "null"
            return str(int(value)) if value.is_integer() else repr(round(value, 9))
        if value is None or value is pd.NA:
            return "null"
        if hasattr(value, "item"):
            return plain(value.item())
        return str(value)

    columns = sorted(frame.columns)
    return sorted(tuple(plain(v) for v in row) for row in frame[columns].itertuples(index=False))


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    database = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        database.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return database


def differences(spark, database, folder: str, name: str) -> str:
    """Empty when both sides agree, else what differs."""
    result, relation = QUERIES[name](spark, folder), database.sql(ORACLES[name])
    types = sorted(result.dtypes)
    expected = sorted((c, SPARK_TYPES.get(str(t), str(t))) for c, t in zip(relation.columns, relation.types))
    if types != expected:
        return f"types {sorted(set(types) ^ set(expected))}"
    ours, theirs = result.toPandas(), relation.df()
    left, right = rows_of(ours), rows_of(theirs)
    if left == right:
        print(f"{len(left):7} rows ", end="")
        return ""
    only_left, only_right = set(left) - set(right), set(right) - set(left)
    return (
        f"rows {len(left)} / {len(right)}; {sorted(ours.columns)}; "
        f"ours {sorted(only_left)[:2]}; theirs {sorted(only_right)[:2]}"
    )


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(
        "compare",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    database = connection(folder)
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            found = differences(spark, database, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':5}{name:26}{time.time() - start:6.1f}s {found}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
