"""Compare a Spark result with DuckDB's for the same tables, as unordered rows."""

from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    return value.item() if hasattr(value, "item") else value


def canonical(columns, rows):
    """Columns by name, rows in a fixed order, each cell with its Python type."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple((type(r[i]).__name__, str(plain(r[i]))) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return canonical([c[0] for c in result.description], result.fetchall())
