import os

import pytest
from oracle import DATA, assert_same

from tagloom.llm.queries import ORACLE_SQL, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    assert_same(spark, QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_one_row_for_each_document(spark, name):
    assert QUERIES[name](spark, DATA).count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
