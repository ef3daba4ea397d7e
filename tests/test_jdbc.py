"""JDBC discovery without a database: argument checks and error isolation.

No database is started: the driver class below does not exist, so every
connection attempt fails before anything is opened.
"""

import pytest

from cartograph.sources import jdbc as J

SRC = {"name": "src", "url": "jdbc:none://nowhere/db", "driver": "org.example.NoSuchDriver",
       "user": "u", "password": "p"}


def test_explicit_tables():
    assert J.explicit_tables({"tables": " a, ,b ,"}) == ["a", "b"]
    assert J.explicit_tables({"tables": ["x", " ", "y "]}) == ["x", "y"]
    assert J.explicit_tables({}) == []


def test_missing_arguments_are_clear():
    with pytest.raises(ValueError, match="url"):
        J.discover_jdbc(None, {"name": "s", "driver": "d"})


def test_unreachable_source_warns_per_table(spark):
    datasets, warnings = J.discover_jdbc(spark, dict(SRC, tables="t1, t2"))
    assert datasets == [] and [w[0] for w in warnings] == ["src:t1", "src:t2"]


def test_failing_catalog_query_is_a_warning(spark):
    with pytest.raises(Exception):
        J.catalog_tables(spark, SRC)
    datasets, warnings = J.discover_jdbc(spark, SRC)
    assert datasets == [] and [w[0] for w in warnings] == ["src:catalog"]
