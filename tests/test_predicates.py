"""Even parts of uneven keys: every row in one of them, and none too large."""

import random
import sqlite3

import pytest

from ledgerloom.sources.jdbc import JdbcTable, read_jdbc
from ledgerloom.sources.predicates import (
    GRAIN,
    ask_frame,
    cells_of,
    even_predicates,
    hash_predicates,
    plan_parts,
)

DRAW = random.Random(5)
# Well spread, whatever the numbers have in common.
SPREAD = "mod(other * 7919, 10007)"
TABLES = {
    "even": [(n, n) for n in range(5000)],
    "cubes": [(n**3, n) for n in range(3000)],
    "hot": [(7 if n % 3 == 0 else n * n, n) for n in range(3000)],
    "nulls": [(None if n % 3 == 0 else -(n**2), n) for n in range(3000)],
    "no spread": [(5, None if n % 10 == 0 else n) for n in range(2000)],
    "wide": [(DRAW.choice([-1, 1]) * int(10 ** (DRAW.random() * 18)), n) for n in range(4000)],
    "one key": [(9, n) for n in range(100)],
    "all null": [(None, n) for n in range(100)],
    "few": [(1, 1), (100, 2)],
    "empty": [],
}


def ask_sqlite(rows):
    """A stand-in for the database, of another dialect than Spark."""
    base = sqlite3.connect(":memory:")
    base.create_function("mod", 2, lambda a, b: None if a is None else a % b)
    base.execute("CREATE TABLE t (key INTEGER, other INTEGER)")
    base.executemany("INSERT INTO t VALUES (?, ?)", rows)

    def ask(query):
        return base.execute(query.format(table="t")).fetchall()

    return base, ask


@pytest.mark.parametrize("name", sorted(TABLES))
@pytest.mark.parametrize("parts", [1, 8, 50])
def test_every_row_meets_one_condition(name, parts):
    rows = TABLES[name]
    base, ask = ask_sqlite(rows)
    for spread in (None, SPREAD):
        found = even_predicates(ask, "key", parts, spread)
        counts = [base.execute(f"SELECT count(*) FROM t WHERE {own}").fetchone()[0] for own in found]
        met = " + ".join(f"coalesce(({own}), 0)" for own in found[:200])
        assert sum(counts) == len(rows)
        assert base.execute(f"SELECT count(*) FROM t WHERE {met} <> 1").fetchone()[0] == 0
        if spread and rows and name not in ("no spread", "few"):
            assert max(counts) <= 2 * len(rows) / parts + 1


@pytest.mark.parametrize("name", ["cubes", "hot", "nulls", "wide"])
def test_rows_that_come_later_are_read_too(name):
    base, ask = ask_sqlite(TABLES[name])
    found = even_predicates(ask, "key", 8, SPREAD)
    later = [(key, 3) for key in (None, -(10**18) - 5, 10**18 + 5, -1, 0, 1, 6, 7, 8, 10, 123457)]
    base.executemany("INSERT INTO t VALUES (?, ?)", later)
    counts = [base.execute(f"SELECT count(*) FROM t WHERE {own}").fetchone()[0] for own in found]
    assert sum(counts) == len(TABLES[name]) + len(later)


def test_cells_are_small_or_single_keys():
    _, ask = ask_sqlite(TABLES["wide"])
    asked = []
    total, without, cells = cells_of(lambda query: asked.append(query) or ask(query), "key", 10)
    assert (total, without) == (4000, 0)
    assert sum(n for _, _, n in cells) == 4000
    assert all(n * 10 * GRAIN <= total or high - low == 1 for low, high, n in cells)
    assert all(one[1] <= other[0] for one, other in zip(cells, cells[1:], strict=False))
    assert len(asked) < 15


def test_parts_say_how_many_rows_they_hold():
    _, ask = ask_sqlite(TABLES["hot"])
    parts = plan_parts(ask, "key", 10, spread=True)
    hot = [part for part in parts if part.slices > 1]
    assert {part.low for part in hot} == {7}
    assert [part.slice for part in hot] == list(range(len(hot)))
    assert sum(part.rows for part in parts if part.slice == 0) == 3000


def test_a_frame_is_asked_as_a_database_is(spark):
    rows = TABLES["hot"] + TABLES["nulls"]
    frame = spark.createDataFrame(rows, "key bigint, other bigint")
    _, ask = ask_sqlite(rows)
    for parts in (3, 20):
        assert plan_parts(ask_frame(frame), "key", parts, True) == plan_parts(ask, "key", parts, True)


def test_hash_conditions():
    base, _ = ask_sqlite(TABLES["nulls"])
    found = hash_predicates("abs(key)", 7)
    counts = [base.execute(f"SELECT count(*) FROM t WHERE {own}").fetchone()[0] for own in found]
    assert sum(counts) == 3000
    with pytest.raises(ValueError, match="at least 1"):
        hash_predicates("key", 0)


class CountingReader:
    """Stands in for ``spark.read``: answers counts, and keeps what it is asked to load."""

    def __init__(self, ask):
        self.ask, self.asked, self.loaded = ask, [], None

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked.append(options)
        return self

    def load(self):
        return self

    def collect(self):
        return self.ask(self.asked[-1]["dbtable"].removeprefix("(").removesuffix(") answer"))

    def jdbc(self, url, table, predicates, properties):
        self.loaded = (url, table, predicates, properties)
        return self


def test_the_reader_gets_the_conditions():
    base, ask = ask_sqlite(TABLES["hot"])
    spark = CountingReader(ask)
    source = JdbcTable(
        "jdbc:postgresql://host/db", "t", "me", "secret", partition_column="key", num_partitions=9, even_rows=True, spread=SPREAD
    )
    read_jdbc(spark, source)
    url, table, predicates, properties = spark.loaded
    assert (url, table, properties["password"]) == ("jdbc:postgresql://host/db", "t", "secret")
    assert "url" not in properties
    assert all("FROM t" in asked["dbtable"] for asked in spark.asked)
    assert predicates == even_predicates(ask, "key", 9, SPREAD)
    counts = [base.execute(f"SELECT count(*) FROM t WHERE {own}").fetchone()[0] for own in predicates]
    assert sum(counts) == 3000 and max(counts) <= 2 * 3000 / 9


@pytest.mark.parametrize(
    "options",
    [
        {"single_task": True, "even_rows": True},
        {"partition_column": "a", "num_partitions": 2, "spread": "b"},
        {"partition_column": "a", "num_partitions": 2, "lower_bound": 1, "upper_bound": 2, "even_rows": True},
    ],
)
def test_options_that_do_not_fit_are_refused(options):
    with pytest.raises(ValueError):
        JdbcTable("jdbc:postgresql://host/db", "t", **options)
