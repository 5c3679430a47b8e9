"""Run a query and its oracle SQL on the same tables and compare all values."""

import math

import duckdb

TABLES = ("region", "nation", "orders", "lineitem")


def connect(tables: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return db


def _ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(cells, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df, db, sql: str) -> list[str]:
    expected = db.execute(sql)
    names, want = _ordered([c[0] for c in expected.description], expected.fetchall())
    own_names, got = _ordered(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != own_names:
        return [f"columns {own_names} instead of {names}"]
    if len(want) != len(got):
        return [f"{len(got)} rows instead of {len(want)}"]
    return [f"{g} instead of {w}" for g, w in zip(got, want) if not _same(g, w)][:5]


def _same(got, want) -> bool:
    return all(
        type(g) is type(w) and (g == w or (isinstance(g, float) and math.isnan(g) and math.isnan(w)))
        for g, w in zip(got, want)
    )
