"""The queries that SQL can express against their SQL, on the smallest data."""

import pytest
from helpers import DATA, same_rows

from lexstrata.llm import queries, sql


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_equals_sql(spark, duck, name):
    same_rows(queries.QUERIES[name](spark, str(DATA)), duck.execute(sql.ORACLE[name]))
