"""Side-by-side run of every query against its SQL.

    python -m checks.compare [data_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from checks.oracle import oracle_queries

# DuckDB names of Spark types; decimals are named alike.
SPARK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(data_dir).glob("*.parquet")):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def difference(mine, theirs) -> str | None:
    """None when a DataFrame and a DuckDB relation agree in names, types and rows."""
    types = {
        field.name: SPARK_TYPES.get(
            field.dataType.simpleString(), field.dataType.simpleString().upper()
        )
        for field in mine.schema
    }
    expected = {
        column: str(kind).replace(" ", "") for column, kind in zip(theirs.columns, theirs.types)
    }
    if list(types) != list(expected):
        return f"columns {list(types)} vs {list(expected)}"
    if types != expected:
        return str({c: (types[c], expected[c]) for c in types if types[c] != expected[c]})
    left = _rows(mine.columns, mine.collect())
    right = _rows(theirs.columns, theirs.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    from mercato.queries import all_queries
    from mercato.session import build_session

    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(data_dir)
    queries, oracles = all_queries(), oracle_queries()
    names = sys.argv[2:] or list(queries)
    failures = 0
    for name in names:
        begin = time.time()
        try:
            problem = difference(queries[name](spark, data_dir), con.sql(oracles[name]))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        verdict = "ok  " if problem is None else "FAIL"
        print(f"{verdict} {name} {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failures}/{len(names)} agree; without SQL: {set(queries) - set(oracles)}")
    return failures


if __name__ == "__main__":
    sys.exit(main())
