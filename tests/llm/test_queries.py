"""Every training-data query that SQL can express, against its SQL."""

import pytest

from check import connect, difference, spark_rows, sql_rows
from lanewright.llm.oracle import ORACLE
from lanewright.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, sf_dir, name):
    ours = spark_rows(QUERIES[name](spark, sf_dir))
    assert difference(ours, sql_rows(connect(sf_dir), ORACLE[name])) is None
