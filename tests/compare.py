"""Run queries and their SQL counterparts and compare types and rows exactly.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def differences(result, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL result; nothing if they agree."""
    expected = connection.sql(sql)
    columns = sorted(result.columns)
    if columns != sorted(expected.columns):
        return [f"columns {columns} / {sorted(expected.columns)}"]
    found = []
    types = {name: str(kind) for name, kind in zip(expected.columns, expected.types, strict=True)}
    for name, kind in result.dtypes:
        if TYPES.get(types[name], types[name]) != kind:
            found.append(f"type of {name}: {kind} / {types[name]}")
    rows = Counter(tuple(row) for row in result.select(*columns).collect())
    wanted = Counter(expected.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    extra, missing = rows - wanted, wanted - rows
    if extra or missing:
        found.append(f"{sum(extra.values())} of {sum(rows.values())} rows differ")
        found.append(f"  spark {sorted(map(str, extra))[:2]}")
        found.append(f"  sql   {sorted(map(str, missing))[:2]}")
    return found


def main() -> None:
    import __spark_entry__ as entry
    from tests.session import session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, connection = session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, run in queries.items():
        if (names and name not in names) or name not in oracles:
            continue
        start = time.time()
        try:
            found = differences(run(spark, sf_dir), connection, oracles[name])
        except Exception as error:  # report and go on to the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     ", line[:1500])
    print(f"{failed} failed; without SQL: {sorted(set(queries) - set(oracles))}")


if __name__ == "__main__":
    main()
