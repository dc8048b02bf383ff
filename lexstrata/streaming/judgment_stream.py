"""Judgments that arrive as a stream. An extension: documents are independent, so that each batch runs the batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import Analysis

SCHEMA = "doc_id bigint, file_name string, court string, jid string, jfull string, ingested_at timestamp"


def stream_chunks(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, max_files: int = 100) -> StreamingQuery:
    """Append the retrieval chunks of newly arrived Parquet files of judgments to a Parquet table; ends when all are done.

    A batch is written to a folder of its own, so that a batch that is run again after a failure replaces its rows."""
    docs = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", max_files).parquet(in_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        Analysis(batch.select("doc_id", "file_name", "jfull")).rag.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_markers(docs: DataFrame) -> DataFrame:
    """Marker lines per hour of arrival and category, of a streaming frame of judgments: windowed counts with a watermark."""
    from pyspark.sql import functions as F

    from ..operators.detect import with_category

    lines = docs.select("ingested_at", F.explode(F.split("jfull", "\n")).alias("raw")).withColumn("symbol", F.substring(F.trim("raw"), 1, 1))
    lines = with_category(lines.withWatermark("ingested_at", "2 days")).where("category IS NOT NULL")
    return lines.groupBy(F.window("ingested_at", "1 hour"), "category").agg(F.count("*").alias("count"))
