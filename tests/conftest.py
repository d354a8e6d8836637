from __future__ import annotations

import pytest

from smelter.session import get_session

AS_TEXT = ("timestamp", "date", "decimal(10,2)")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_all(options):
        for key, value in options.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def table(spark):
    """DataFrame from a DDL schema and rows; times are given as text."""

    def make(schema: str, *rows):
        wanted = spark.createDataFrame([], schema).schema
        as_text = [f.dataType.simpleString() in AS_TEXT for f in wanted]
        given = ", ".join(
            f"{f.name} {'string' if text else f.dataType.simpleString()}"
            for f, text in zip(wanted, as_text)
        )
        values = [
            tuple(str(v) if text and v is not None else v for v, text in zip(row, as_text))
            for row in rows
        ]
        df = spark.createDataFrame(values, given)
        return df.select(*(df[f.name].cast(f.dataType).alias(f.name) for f in wanted))

    return make


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
