"""Comparing a query with its SQL in DuckDB."""

from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}") + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, row count and all values agree."""
    actual = df.collect()
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    kinds = {type(v) for r in expected[:200] for v in r if v is not None}
    kinds_spark = {type(v) for r in actual[:200] for v in r if v is not None}
    out = [] if kinds == kinds_spark else [f"types {kinds_spark} != {kinds}"]
    if len(actual) != len(expected):
        return out + [f"{len(actual)} rows != {len(expected)}"]
    left, right = _rows(df.columns, actual), _rows(names, expected)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ, e.g. {sorted(names)}: {bad[0][0]} != {bad[0][1]}")
    return out
