"""Every catalogued query against its SQL in an independent engine."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR
from crawlcorpus.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _rows(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v
                         for v in row) for row in frame.itertuples(index=False, name=None)),
                  key=repr)


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
               "double": "DOUBLE"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    found, sql = entry.queries()[name](spark, SF_DIR), entry.oracle_sql()[name]
    kinds = {r[0]: r[1] for r in duck.execute(f"describe {sql}").fetchall()}
    assert {column: SPARK_TYPES[kind] for column, kind in found.dtypes} == kinds
    assert _rows(found.toPandas()) == _rows(duck.execute(sql).fetchdf())


@pytest.mark.parametrize("name", ["boilerplate_paragraphs", "main_text"])
def test_main_text_is_map_only(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    spread = plan.count("REPARTITION_BY_NUM")  # of the scan, which one small file needs
    assert plan.count("Exchange hash") == spread and "Window" not in plan and "Sort" not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
