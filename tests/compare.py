"""Row-by-row comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import types as T

DUCK_TYPES = {
    "BIGINT": T.LongType(),
    "INTEGER": T.IntegerType(),
    "VARCHAR": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DECIMAL(10,2)": T.DecimalType(10, 2),
    "DECIMAL(28,2)": T.DecimalType(28, 2),
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def assert_equal(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Same columns, types and rows, copies counted; returns the number of rows."""
    expected = connection.execute(sql)
    types = {c[0]: DUCK_TYPES[str(c[1])] for c in expected.description}
    assert {f.name: f.dataType for f in result.schema} == types
    columns = sorted(types)
    at = [[c[0] for c in expected.description].index(c) for c in columns]
    wanted = Counter(tuple(row[i] for i in at) for row in expected.fetchall())
    got = Counter(tuple(row) for row in result.select(*columns).collect())
    extra, missing = got - wanted, wanted - got
    assert not extra and not missing, (
        f"{sum(extra.values())} extra, e.g. {list(extra)[:3]}; "
        f"{sum(missing.values())} missing, e.g. {list(missing)[:3]}"
    )
    return sum(got.values())
