"""Every core query against its SQL on the smallest data, and the driver's contract."""

import pytest
from helpers import DATA, same_rows

import __spark_entry__ as entry
from lexstrata.plans import registry

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")
WITHOUT_SQL = {"ll_u3_u7_compare_models"}


def test_contract(spark):
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    assert set(registry.QUERIES) - set(registry.ORACLE) == WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_equals_sql(spark, duck, name):
    same_rows(registry.QUERIES[name](spark, str(DATA)), duck.execute(registry.ORACLE[name]))


def test_machine_payload(spark):
    rows = registry.QUERIES["jdg_k2_machine_payload"](spark, str(DATA)).collect()
    assert rows and all(r["rag_chunks_count"] > 0 for r in rows if r["total_lines"] > 1)


def test_compare_models(spark):
    row = registry.QUERIES["ll_u3_u7_compare_models"](spark, str(DATA)).first()
    assert row["model"] == "Logistic Regression" and row["tn"] + row["fp"] + row["fn"] + row["tp"] > 0


def test_compare_models_is_whole(spark):
    rows = registry.QUERIES["ll_u3_u7_compare_models"](spark, str(DATA)).collect()
    assert {r["model"] for r in rows} == {"Logistic Regression", "Linear SVM", "Random Forest"} and len(rows) == 3
    assert [r["f1"] for r in rows] == sorted((r["f1"] for r in rows), reverse=True)
    tests = registry.QUERIES["ll_u6_split"](spark, str(DATA)).where("NOT is_train").groupBy().sum("count").first()[0]
    assert {r["tn"] + r["fp"] + r["fn"] + r["tp"] for r in rows} == {tests}
