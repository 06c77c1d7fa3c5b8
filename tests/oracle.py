"""Compare a Spark result with SQL run over the same files."""

import datetime
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


SPARK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark_df, con, sql):
    """None if equal, else a short account of the difference."""
    rel = con.sql(sql)
    want_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    have_types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), "?") for f in spark_df.schema}
    if have_types != want_types:
        return f"schema: {have_types} != {want_types}"
    have = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = canonical(rel.columns, rel.fetchall())
    if len(have) != len(want):
        return f"rows: {len(have)} != {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return f"values: {a} != {b}"
    return None
