"""Registered queries against their SQL, over the smallest tables."""

import os

import duckdb
import pytest

from paperledger.llm.oracle import ORACLE
from paperledger.llm.queries import REGISTERED
from tests.compare import duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert spark_rows(REGISTERED[name](spark, SF)) == duck_rows(con, ORACLE[name])
