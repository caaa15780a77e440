"""Row-by-row comparison of a registered query with its SQL on DuckDB."""

import glob
import os

import duckdb

TABLES_DIR = "/root/testdata"


def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def key(row):
    return tuple((value is not None, str(value)) for value in row)


def compare(result, connection, sql):
    """Return None if both sides agree in columns, types and values, else a message."""
    names = sorted(result.columns)
    rows = sorted((tuple(r) for r in result.select(*[f"`{n}`" for n in names]).collect()), key=key)
    relation = connection.sql(sql)
    theirs = sorted(relation.columns)
    if names != theirs:
        return f"columns {names} against {theirs}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    for field in result.schema.fields:
        if TYPES.get(field.dataType.simpleString()) != types[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} against {types[field.name]}"
    order = [relation.columns.index(n) for n in names]
    expected = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=key)
    if len(rows) != len(expected):
        return f"{len(rows)} rows against {len(expected)}"
    for ours, other in zip(rows, expected):
        if ours != other:
            return f"{ours} against {other}"
    return None
