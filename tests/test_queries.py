"""Every registered query against the SQL text that must give the same rows."""

import os

import pytest

from batchkit.catalog import QUERIES, SQL
from batchkit.sources.files import file_manifest
from oracle import assert_same, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def sql_engine():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sql_engine, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), sql_engine, SQL[name]) > 0


def test_file_manifest_lists_the_files(spark):
    rows = {r["name"]: r["size_bytes"] for r in file_manifest(spark, SF_DIR).collect()}
    assert rows == {name: os.path.getsize(f"{SF_DIR}/{name}") for name in os.listdir(SF_DIR)}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
