from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from llm.llm_helpers import CLASHING, odd_texts

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not SF_DIR.exists():
        pytest.skip("test tables are not here")
    return str(SF_DIR)


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


@pytest.fixture(scope="session")
def odd(spark):
    df = spark.createDataFrame(odd_texts(), "doc_id bigint, text string").repartition(3)
    return df.selectExpr("*", *(f"{v} as {k}" for k, v in CLASHING.items()))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, quality int, toxic int")
