"""A query's rows against its DuckDB twin, as unordered rows with rounded floats."""

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def rows_of(rows, columns, order):
    at = [columns.index(c) for c in order]
    return sorted(([plain(r[i]) for i in at] for r in rows), key=repr)


def check(spark, sf_dir, query, sql):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    order = sorted(df.columns)
    cur = c.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == order
    assert rows_of(df.collect(), df.columns, order) == rows_of(cur.fetchall(), names, order)
