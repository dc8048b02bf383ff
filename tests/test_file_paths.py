"""Files of one document each: where they are written and how they are read again."""

import pytest
from pyspark.sql import functions as F

from lexstrata.sources import readers, writers


@pytest.mark.parametrize("form", ["{}/a", "file:{}/b", "file://{}/c", "file:{}/s p", "file://{}/s%20p", "file://{}/s p"])
def test_written_where_they_are_read(spark, tmp_path, form):
    """pyarrow took file:/x for a relative path and %20 for a space, which Spark doesn't."""
    path = form.format(tmp_path)
    rows = spark.createDataFrame([("1.json", '{"JID": "x", "JFULL": "甲"}'), ("2.json", '{"JFULL": null}')], "name string, text string")
    writers.write_file_per_document(rows, path, F.col("name"), F.col("text"))
    assert {(r["file_name"], r["jid"], r["jfull"]) for r in readers.judgment_files(spark, path).collect()} == {("1.json", "x", "甲"), ("2.json", "Unknown", None)}


def test_many_files_to_a_task(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"{i}.json").write_text('{"JFULL": "a"}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        found = readers.judgment_files(spark, str(tmp_path))
        assert found.count() == 200 and found.rdd.getNumPartitions() <= 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found.sparkSession is spark and spark.conf.get("spark.sql.files.openCostInBytes") != "65536"
