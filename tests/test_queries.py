"""Every registered query against its SQL in DuckDB, on whole tables."""

import math
import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"
TABLES = [path.stem for path in Path(SF_DIR).glob("*.parquet")]
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()

# DuckDB type of each Spark type the queries return.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted_rows(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, v if v is not None else 0) for v in row))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    own = {name for name in QUERIES if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [(c[0], str(c[1])) for c in cursor.description]
    expected = cursor.fetchall()
    assert sorted((f, TYPES[t]) for f, t in found.dtypes) == sorted(columns)
    names = sorted(found.columns)
    got_order = [found.columns.index(c) for c in names]
    want_order = [[c for c, _ in columns].index(c) for c in names]
    assert _sorted_rows(found.collect(), got_order) == _sorted_rows(expected, want_order)


def test_entry_gives_one_row_of_metrics(spark):
    metrics = entry_module.entry(spark)
    assert metrics.columns == ["precision", "recall", "f1Score", "accuracy"]
    assert metrics.count() == 1


def test_line_items_of_large_keys_are_planned_too(spark, tmp_path):
    """Cubes of keys beyond 64 bits: the rows stay, and no part is too large."""
    last = entry_module.LAST_CUBED
    assert last**3 < 2**63 <= (last + 1) ** 3
    keys = [1, 2, last - 1, last, *range(last + 1, last + 401), 9_000_000, None]
    rows = [(key, n, float(n % 50 + 1)) for n, key in enumerate(keys)]
    table = spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_quantity double")
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = entry_module.jdbc_predicates(spark, str(tmp_path)).collect()
    assert sum(row.n for row in found) == len(rows)
    assert max(row.n for row in found) <= 2 * len(rows) / entry_module.JDBC_PARTS
    assert max(row.high for row in found if row.high is not None) > last**3
