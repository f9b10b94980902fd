"""Every registered parcel query against DuckDB on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from tilth.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{source}'")
    return db


def rows(df) -> list[tuple]:
    df = df[sorted(df.columns)].astype(object)

    def cell(v):
        if v is None or v != v:
            return ""
        return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(cell(v) for v in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_spatial_join_has_no_nested_loop(spark):
    plan = QUERIES["tile_bbox_join"](spark, SF)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_geometry_is_not_dealt_into_cells(spark):
    """The exchange by cell carries keys and boxes; geometry joins the pairs that are left."""
    plan = QUERIES["tile_spatial_join"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    generated = [line for line in plan.split("\n") if "Generate explode" in line]
    assert generated and not any("geom" in line for line in generated)


def test_date_filter_reaches_the_scan(spark):
    plan = spark.read.parquet(f"{SF}/events.parquet").filter("ts >= timestamp_ntz '2024-01-05'")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts)" in plan


def test_composite_is_one_shuffle(spark):
    from tilth.operators.composite import median

    obs = spark.createDataFrame([("T", 0, 0, 1, 2, 3, 4, True)], "tile_id string, px long, py long, b04 long, b03 long, b02 long, b08 long, valid boolean")
    plan = median(obs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
