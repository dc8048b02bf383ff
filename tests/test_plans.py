"""Plans that must stay small, whatever stands in the projections below them."""

import pytest

from lexstrata.operators import stats as A


@pytest.fixture
def stats(spark, tmp_path):
    rows = [(1, "主文\r\na\r\n事實\r\nb\r\n理由\r\nc"), (2, None), (3, "主文\r\na\r\n事實及理由\r\nb"), (4, "x"), (5, "主文\r\na\r\nb\r\n事實及理由\r\nb")]
    spark.createDataFrame(rows, "doc_id long, jfull string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    return A.doc_stats(spark.read.parquet(str(tmp_path / "docs")))


@pytest.mark.parametrize("make", [A.traditional_counts, A.largest_classes])
def test_no_filter_on_what_the_class_is_made_of(stats, make):
    """A filter on the symbol stood on the scan with all of its expressions, each many times over."""
    plan = make(stats)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("主文") == 1


def test_classes_leave_out_errors(stats):
    assert {tuple(r) for r in A.traditional_counts(stats).collect()} == {("separated", 1), ("combined", 2), ("incomplete", 1)}
    assert [tuple(r)[:3] for r in A.largest_classes(stats).collect()] == [("MS", 2, 2.5), ("MFR", 1, 2.0), ("N", 1, 0.0)]
