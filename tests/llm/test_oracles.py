"""Queries against their SQL in another engine, with column types."""

import glob
import os

import duckdb
import pytest

from conftest import SF_DIR
from crawlcorpus.llm.catalog import ORACLES, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        duck.execute(f"create view {view} as select * from '{path}'")
    found, sql = QUERIES[name](spark, SF_DIR), ORACLES[name]
    kinds = {r[0]: r[1] for r in duck.execute(f"describe {sql}").fetchall()}
    assert {column: TYPES[kind] for column, kind in found.dtypes} == kinds
    columns = ", ".join(found.columns)
    want = duck.execute(f"select {columns} from ({sql})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(want)
