"""Compare a query with its DuckDB oracle: names, row count and values."""

from __future__ import annotations

from pathlib import Path

import duckdb


def oracle_rows(sql: str, sf_dir: str):
    with duckdb.connect() as db:
        for path in Path(sf_dir).glob("*.parquet"):
            db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
        result = db.execute(sql)
        names = [d[0] for d in result.description]
        return names, result.fetchall()


def normalized(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((value is None, str(value)) for value in row),
    )


def assert_matches(df, sql: str, sf_dir: str) -> int:
    names, expected = oracle_rows(sql, sf_dir)
    assert sorted(names) == sorted(df.columns)
    actual = normalized(df.columns, [tuple(row) for row in df.collect()])
    expected = normalized(names, expected)
    assert len(actual) == len(expected)
    assert actual == expected
    return len(actual)
