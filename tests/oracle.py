"""Compare a registered query with its SQL on DuckDB: row count, column names, values."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> tuple[int, list[str]]:
    """Rows of the Spark result and a list of differences (empty when equal)."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want_types = {d[0]: str(d[1]) for d in result.description}
    want_rows = result.fetchall()
    got_rows = df.collect()
    problems = []
    if sorted(want_columns) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(want_columns)}")
        return len(got_rows), problems
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, dtype in df.dtypes:
        if names.get(dtype, dtype) != want_types[name]:
            problems.append(f"type of {name}: {dtype} != {want_types[name]}")
    got, want = _normal(df.columns, got_rows), _normal(want_columns, want_rows)
    if got != want:
        in_got, in_want = set(got), set(want)
        missing = [r for r in want if r not in in_got][:3]
        extra = [r for r in got if r not in in_want][:3]
        problems.append(f"rows {len(got)} vs {len(want)}; missing {missing}; extra {extra}")
    return len(got_rows), problems
