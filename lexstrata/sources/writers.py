"""Writers: machine results, Markdown, class files, reports. All write through Spark; one file a document only on request."""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

CHUNK_FIELDS = ["chunk_id", "chunk_type", "level", "start_line", "end_line", "title", "leveling_symbol", "content", "full_text", "hierarchy_path", "parent_titles", "location"]


def machine_payload(files: DataFrame, stats: DataFrame, rag: DataFrame) -> DataFrame:
    """doc_id, filename, learning_region, processing_stats, rag_chunks: one nested row a document.

    files: doc_id, file_name, learning_region; stats: doc_id and the five counts; rag: of rag_chunks."""
    chunks = rag.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.struct(*CHUNK_FIELDS).alias("c")))), lambda x: x["c"]).alias("rag_chunks"))
    rows = files.join(stats, "doc_id").join(chunks, "doc_id", "left")
    counts = ["total_lines", "total_symbols_detected", "learned_rules_count", "final_levels"]
    n = F.when(F.col("rag_chunks").isNull(), 0).otherwise(F.size("rag_chunks")).cast("long")
    return rows.select("doc_id", F.col("file_name").alias("filename"), "learning_region", F.struct(*counts, n.alias("rag_chunks_count")).alias("processing_stats"), "rag_chunks")


def write_machine_json(payload: DataFrame, path: str) -> None:
    """JSON lines, one document a line, in as many files as tasks."""
    payload.drop("doc_id").write.mode("overwrite").json(path)


def write_machine_files(payload: DataFrame, path: str) -> None:
    """One {stem}_machine.json a document."""
    fields = [c for c in payload.columns if c != "doc_id"]
    write_file_per_document(payload, path, F.concat(stem(F.col("filename")), F.lit("_machine.json")), F.to_json(F.struct(*fields)))


def full_path(spark: SparkSession, path: str) -> tuple[str, str]:
    """A path with its file system, as Spark reads it, and the part of it within the file system. file:/x, file:///x and,
    where files are the default, /x are one folder; nothing in a path is decoded."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at)
    return at.toString(), at.toUri().getPath()


def write_file_per_document(rows: DataFrame, path: str, name: Column, text: Column) -> None:
    """One file a row, named name, written by the tasks to the file system of path (file, hdfs, s3 or gs, by its scheme).
    Written anew if a task runs again. Off a local master path needs a scheme, so that no executor keeps files to itself."""
    if not re.match(r"[A-Za-z][\w+.-]*:/", path) and not rows.sparkSession.sparkContext.master.startswith("local"):
        raise ValueError(f"{path}: name the file system that all executors share, as hdfs:// or file://")
    full, inner = full_path(rows.sparkSession, path)

    def write(part: Iterator[Row]) -> None:
        from pyarrow import fs

        system, root = (fs.LocalFileSystem(), inner) if full.startswith("file:") else fs.FileSystem.from_uri(full)
        system.create_dir(root, recursive=True)
        for row in part:
            with system.open_output_stream(f"{root}/{PurePosixPath(row['name']).name}") as f:
                f.write(row["text"].encode("utf-8"))

    rows.select(name.alias("name"), text.alias("text")).foreachPartition(write)


def stem(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"\.[^.]*\z", "")


def write_markdown(markdown: DataFrame, files: DataFrame, path: str) -> None:
    """One .md file a document."""
    rows = markdown.join(files.select("doc_id", "file_name"), "doc_id")
    write_file_per_document(rows, path, F.concat(stem(F.col("file_name")), F.lit(".md")), F.col("markdown"))


def write_json(rows: DataFrame, path: str, one_file: bool = False) -> None:
    """JSON lines; one_file: of small aggregates."""
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_by_class(stats: DataFrame, path: str) -> None:
    """Document statistics, in a folder for each class symbol."""
    stats.write.mode("overwrite").partitionBy("symbol").json(path)


def write_errors(files: DataFrame, path: str) -> None:
    """file_name, error of each file that couldn't be used, as JSON lines."""
    files.where("error IS NOT NULL").select("file_name", "error").write.mode("overwrite").json(path)


def table_text(title: str, rows: DataFrame) -> str:
    """A Markdown table of all rows of a small aggregate. Top-k tables are cut by their makers."""
    names = rows.columns
    out = [f"## {title}", "", "| " + " | ".join(names) + " |", "|" + " --- |" * len(names)]
    for r in rows.collect():
        out.append("| " + " | ".join("" if v is None else f"{v:.4g}" if isinstance(v, float) else f"{v:,}" if isinstance(v, int) else str(v) for v in r) + " |")
    return "\n".join([*out, ""])


def report(title: str, parts: dict[str, DataFrame]) -> str:
    """A Markdown report with a table for each aggregate."""
    return "\n".join([f"# {title}", "", *[table_text(k, v) for k, v in parts.items()]])
