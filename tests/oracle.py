"""Compare a Spark result with the DuckDB text of the same query."""

import math
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0 if value != 0 else 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql, show=3):
    """An empty string if both results hold the same columns and the same bag of rows."""
    reply = con.execute(sql)
    sql_columns = [d[0] for d in reply.description]
    expected = reply.fetchall()
    found = spark_df.collect()
    if sorted(spark_df.columns) != sorted(sql_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_columns)}"
    sql_types = {d[0]: str(d[1]) for d in reply.description}
    spark_types = {name: TYPES[kind] for name, kind in spark_df.dtypes}
    if sql_types != spark_types:
        wrong = {n: (spark_types[n], t) for n, t in sql_types.items() if spark_types[n] != t}
        return f"types (Spark, DuckDB): {wrong}"
    a, b = _bag(spark_df.columns, found), _bag(sql_columns, expected)
    if a == b:
        return ""
    only_spark, only_sql = list((a - b).elements()), list((b - a).elements())
    key = lambda r: tuple(str(v) for v in r)
    return (
        f"{len(found)} vs {len(expected)} rows; {len(only_spark)} only in Spark, "
        f"{len(only_sql)} only in DuckDB\n columns: {sorted(sql_columns)}\n"
        f" Spark:  {sorted(only_spark, key=key)[:show]}\n DuckDB: {sorted(only_sql, key=key)[:show]}"
    )
