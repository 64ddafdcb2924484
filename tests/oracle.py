"""Compares a Spark result with DuckDB over the same tables, by value."""

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and value == int(value):
        return int(value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(con, sql, df):
    """None if equal and not empty, else a short account of what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = _bag(names, result.fetchall())
    found = _bag(df.columns, [tuple(r) for r in df.collect()])
    if not expected and not found:
        return "no rows on either side: the comparison proves nothing"
    if expected == found:
        return None
    return (f"{sum(found.values())} rows, expected {sum(expected.values())}; "
            f"only Spark {list((found - expected).items())[:2]}; "
            f"only SQL {list((expected - found).items())[:2]}")
