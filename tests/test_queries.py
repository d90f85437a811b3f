"""Every query against its SQL on the smallest tables; the others must run and keep their schema on empty tables."""

from __future__ import annotations

import pytest

from quire import catalog
from tests.compare import connection, differences


@pytest.fixture(scope="module")
def con(data):
    return connection(data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_agrees_with_sql(spark, data, con, name):
    assert differences(catalog.QUERIES[name](spark, data), con, catalog.ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_gives_rows(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() > 0


@pytest.fixture(scope="module")
def empty(spark, data, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    import glob
    import os

    for path in glob.glob(f"{data}/*.parquet"):
        spark.read.parquet(path).limit(0).write.parquet(str(folder / os.path.basename(path)))
    return str(folder)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_empty_tables(spark, empty, name):
    assert catalog.QUERIES[name](spark, empty).count() in (0, 1)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
