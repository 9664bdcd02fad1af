"""What the reader asks Spark for. No database is run, so no row is read here."""

import pytest

from ledgerloom.sources.jdbc import JdbcTable, read_jdbc


class FakeReader:
    """Stands in for ``spark.read`` and records every load."""

    def __init__(self, bounds=(1, 900)):
        self.loads, self.bounds, self.pending = [], bounds, None

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.pending = options
        return self

    def load(self):
        self.loads.append(self.pending)
        return self

    def jdbc(self, url, table, predicates, properties):
        self.loads.append({"url": url, "table": table, "predicates": predicates, **properties})
        return self

    def first(self):
        return self.bounds


URL = "jdbc:postgresql://host/db"


def test_credentials_are_options_and_not_in_the_url():
    spark = FakeReader()
    read_jdbc(spark, JdbcTable(URL, "tx", "me", "secret", single_task=True))
    assert spark.loads == [
        {
            "url": URL,
            "driver": "org.postgresql.Driver",
            "fetchsize": "10000",
            "user": "me",
            "password": "secret",
            "dbtable": "tx",
        }
    ]


def test_password_is_not_shown():
    assert "secret" not in repr(JdbcTable(URL, "tx", "me", "secret", single_task=True))


def test_given_bounds_split_the_read():
    spark = FakeReader()
    read_jdbc(
        spark,
        JdbcTable(URL, "tx", partition_column="id", num_partitions=50, lower_bound=0, upper_bound=10**9),
    )
    (load,) = spark.loads
    assert load["partitionColumn"] == "id"
    assert (load["lowerBound"], load["upperBound"], load["numPartitions"]) == ("0", "1000000000", "50")


def test_missing_bounds_are_asked_of_the_database_once():
    spark = FakeReader()
    read_jdbc(spark, JdbcTable(URL, "(SELECT * FROM tx) q", partition_column="id", num_partitions=4))
    asked, load = spark.loads
    assert asked["dbtable"] == "(SELECT min(id) AS lo, max(id) AS hi FROM (SELECT * FROM tx) q) bounds"
    assert "partitionColumn" not in asked
    assert (load["lowerBound"], load["upperBound"]) == ("1", "900")


def test_empty_table_is_read_in_one_part():
    spark = FakeReader(bounds=(None, None))
    read_jdbc(spark, JdbcTable(URL, "tx", partition_column="id", num_partitions=4))
    assert "partitionColumn" not in spark.loads[-1]


def test_predicates_give_one_task_each():
    spark = FakeReader()
    read_jdbc(spark, JdbcTable(URL, "tx", "me", "secret", predicates=["id < 5", "id >= 5 OR id IS NULL"]))
    (load,) = spark.loads
    assert load["predicates"] == ["id < 5", "id >= 5 OR id IS NULL"]
    assert (load["url"], load["table"], load["user"]) == (URL, "tx", "me")


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"single_task": True, "predicates": ["a"]},
        {"partition_column": "id"},
        {"num_partitions": 3},
        {"lower_bound": 1, "upper_bound": 2},
        {"partition_column": "id", "num_partitions": 3, "lower_bound": 1},
        {"partition_column": "id", "num_partitions": 3, "predicates": ["a"]},
        {"predicates": []},
    ],
)
def test_options_that_do_not_fit_are_refused(options):
    with pytest.raises(ValueError):
        JdbcTable(URL, "tx", **options)
