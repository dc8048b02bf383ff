"""Readers: judgment files and tables, labelled lines, machine results, models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JUDGMENT = "JID string, JFULL string"
_CHUNK = (
    "struct<chunk_id: string, chunk_type: string, level: bigint, start_line: bigint, end_line: bigint, title: string, leveling_symbol: string, content: string, full_text: string,"
    " content_lines: array<string>, hierarchy_path: array<bigint>, parent_titles: array<string>, location: string>"
)
MACHINE = f"filename string, learning_region string, rag_chunks array<{_CHUNK}>, line_based_chunks array<{_CHUNK}>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, file_name, court, jid (Unknown if null), jfull of the judgment table."""
    return table(spark, sf_dir, "judgments").select("doc_id", "file_name", "court", F.coalesce("jid", F.lit("Unknown")).alias("jid"), "jfull")


def whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, path, file_name of the *.json files of a folder, or of files.

    Spark counts 4 MB for opening a file, and would make a task of every few of them. The count is a setting of the session
    of a scan: this one gets a copy of the session with a lower one, and the rows stay in the session itself."""
    copy = spark._jsparkSession.cloneSession()
    copy.conf().set("spark.sql.files.openCostInBytes", "65536")
    reader = spark.read
    reader._jreader = copy.read()
    files = reader.text(path, wholetext=True, pathGlobFilter="*.json").select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"))
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, files._jdf.queryExecution().logical()), spark)


def judgment_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """doc_id, file_name, jid, jfull, n_chars (of the file), error of the *.json files of a folder, not of its subfolders.

    A file that can't be used has a null jfull and an error, and stops no other. doc_id is a hash of the path, equal in
    every run. max_files: only the first by name; the names are ranked before any file is read."""
    files = whole_files(spark, path)
    if max_files is not None:
        names = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select("path")
        first = [r[0] for r in names.orderBy("path").limit(max_files).collect()]
        files = whole_files(spark, first) if first else files.where(F.lit(False))
    keys = F.json_object_keys("value")
    parsed = F.from_json("value", JUDGMENT)
    rows = files.withColumns({"keys": keys, "j": parsed})
    error = (
        F.when(F.col("keys").isNull(), "Error processing: not a JSON object")
        .when(~F.array_contains("keys", "JFULL"), "No JFULL field found")
        .when(F.col("j.JFULL").isNull(), "Error processing: JFULL is null")
    )
    return rows.select(
        F.xxhash64("path").alias("doc_id"), F.url_decode(F.regexp_replace("file_name", r"\+", "%2B")).alias("file_name"), F.coalesce("j.JID", F.lit("Unknown")).alias("jid"),
        F.when(error.isNull(), F.col("j.JFULL")).alias("jfull"), F.length("value").cast("long").alias("n_chars"), error.alias("error"),
    )


def labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """line_text, sentiment of CSV files with a header; quoted fields may hold line breaks."""
    return spark.read.csv(path, header=True, schema="line_text string, sentiment string", multiLine=True, quote='"', escape='"')


def machine_results(spark: SparkSession, path: str) -> DataFrame:
    """filename, learning_region, seq, level, chunk_type, start_line, end_line, content_lines, leveling_symbol, chunk_id of
    machine results, one JSON document a file: an object, or an array whose first element counts.

    An empty array has an error row of its own. Chunks without content_lines get the lines of their content, and a
    section its title before them. Missing levels are -1, missing types content."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select("value", F.col("_metadata.file_name").alias("file"))
    first = F.when(F.ltrim("value").startswith("["), F.try_element_at(F.from_json("value", f"array<struct<{_ddl_to_struct(MACHINE)}>>"), F.lit(1))).otherwise(F.from_json("value", MACHINE))
    rows = raw.select("file", first.alias("m")).select(F.coalesce("m.filename", "file").alias("filename"), "m.learning_region", F.coalesce("m.rag_chunks", "m.line_based_chunks").alias("chunks"))
    rows = rows.select("filename", "learning_region", F.posexplode_outer("chunks").alias("seq", "c"))
    level, kind = F.coalesce("c.level", F.lit(-1)), F.coalesce("c.chunk_type", F.lit("content"))
    lines = F.coalesce("c.content_lines", F.when(F.coalesce("c.content", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split("c.content", "\n")))
    titled = (kind == "hierarchical_section") & (level >= 1) & (F.coalesce("c.title", F.lit("")) != "")
    lines = F.when(titled & F.col("c.content_lines").isNull(), F.concat(F.array("c.title"), lines)).otherwise(lines)
    return rows.select(
        "filename", "learning_region", F.col("seq").cast("long").alias("seq"), level.alias("level"), kind.alias("chunk_type"), "c.start_line", "c.end_line", lines.alias("content_lines"), "c.leveling_symbol", "c.chunk_id",
        F.when(F.col("c").isNull(), F.lit("no chunks")).alias("error"),
    )


def _ddl_to_struct(ddl: str) -> str:
    """The fields of a table schema as those of a struct."""
    out, depth, word = [], 0, ""
    for ch in ddl + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            name, kind = word.strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            word = ""
        else:
            word += ch
    return ", ".join(out)


def model(path: str) -> PipelineModel:
    """A saved line classifier; an error if the folder is missing."""
    return PipelineModel.load(path)
