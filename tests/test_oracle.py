"""Every query against its SQL on the small tables, values and all."""

import glob
import os

import duckdb
import pytest

from tierstream.plans.oracles import ORACLES
from tierstream.plans.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, raw_spark, database):
    frame = QUERIES[name](raw_spark, FOLDER)
    got = [tuple(row) for row in frame.collect()]
    relation = database.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    expected = relation.fetchall()
    assert len(got) == len(expected)
    assert comparable(got, frame.columns) == comparable(expected, relation.columns)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
