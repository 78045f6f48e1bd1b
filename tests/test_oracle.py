"""Every catalog query against its DuckDB SQL (the driver's gate, at sf0.001),
plus the entry smoke check."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from strata.operators import lifecycle as L
from strata.operators import rules as R
from strata.plans.catalog import catalog
from tools.check import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog()))
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    o = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert digest(s) == digest(o)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 115
    assert "good_tags_text" in df.columns and "type" in df.columns


@pytest.mark.parametrize("name", ["extract_candidates", "lifecycle_fused", "node_points", "resolve_ways"])
def test_the_fixture_tells_the_first_visible_version_from_the_last(spark, con, name, monkeypatch):
    """An engine that ships the wrong version's tags, position or refs is seen."""
    scalar = L.lifecycle_scalar

    def first_visible(history, deletion_changeset=False):
        right = scalar(history, deletion_changeset)
        first = L.first_version(history.filter("visible")).select(
            *L.KEYS, F.col("version").alias("last_good_version"), F.col("lat").alias("last_lat"), F.col("lon").alias("last_lon"))
        return right.drop("last_good_version", "last_lat", "last_lon").join(first, L.KEYS, "left").select(*right.columns)

    monkeypatch.setattr(L, "lifecycle_scalar", first_visible)
    monkeypatch.setattr(R, "lifecycle_scalar", first_visible)
    s = catalog()[name](spark, SF_SMALL).toPandas()
    assert digest(s) != digest(con.execute(E.oracle_sql()[name]).df())
    values = ["good_tags_text", "last_nds_refs", "geometry", "node_version"]
    assert len(s) and any(c in s.columns for c in values)
