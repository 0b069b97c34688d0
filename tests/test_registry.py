"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from check_oracles import TABLES, canonical  # noqa: E402

SF = entry.ENTRY_DATA
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        cursor = db.execute(ORACLES[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(df.columns) == sorted(columns)
        assert canonical(got, df.columns) == canonical(cursor.fetchall(), columns)


@pytest.mark.parametrize("name", ["writing_labels", "attention_labels_overlapping", "dot_rate", "norm_stats", "still_samples",
                                  "redacted_coordinates", "picked_times", "points_in_windows"])
def test_query_with_cut_groups_and_salted_joins(spark, db, name):
    spark.conf.set("spark.motionloom.rowsPerTask", "30")
    spark.conf.set("spark.motionloom.broadcastRows", "2")
    try:
        test_query(spark, db, name)
    finally:
        spark.conf.unset("spark.motionloom.rowsPerTask")
        spark.conf.unset("spark.motionloom.broadcastRows")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["recording_id", "n_samples", "labelled_share"] and df.count() > 0
