"""Registered queries run on the smallest tables and agree with their SQL, and their plans are as meant."""

import glob
import math
import os

import pytest

from corpusloom.plans import oracles
from corpusloom.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return int(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    done = duck.execute(oracles.SQL[name])
    have = [x[0] for x in done.description]
    want = sorted((tuple(plain(r[have.index(c)]) for c in names) for r in done.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(oracles.SQL)))
def test_runs(spark, name):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    df = QUERIES[name](spark, DATA)
    first, again = (sorted(map(str, df.collect())) for _ in range(2))
    assert first and first == again


def test_flagship_computes_its_text_once(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    plan = QUERIES["flagship"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("d{3})") == plan.count("Generate explode")  # the cleaning pattern stands once for each generator


def test_scan_reads_what_is_needed(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    plan = QUERIES["m3_histogram"](spark, DATA)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<source:string>" in plan and "CartesianProduct" not in plan
