"""The whole analysis of judgments as one plan, and its entry points."""

from __future__ import annotations

import argparse
import logging
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import chunks as C
from ..operators import detect as D
from ..operators import markdown as M
from ..operators import rag as R
from ..operators import stats as A
from ..operators import structure as L
from ..sources import readers, writers
from . import reports as R_

log = logging.getLogger(__name__)


class Analysis:
    """Frames of the analysis of docs (doc_id, file_name, jfull), each made when it is asked for.

    scorer: a function from a text column to a score column, for lines that only a soft rule accepts; without it the
    rules decide. keep() stores the frames that others are made of, where several outputs are written."""

    def __init__(self, docs: DataFrame, scorer: D.Scorer | None = None, threshold: float = 0.5) -> None:
        # Whole documents are shuffled once by doc_id; every later window, join and group on doc_id keeps that partitioning,
        # so that lines are never shuffled, and all branches read the one exchange.
        # Rows that no join keeps are dropped before, or filters pushed under some branches would make exchanges of their own.
        docs = docs.where("doc_id IS NOT NULL AND jfull IS NOT NULL").select("doc_id", "file_name", "jfull")
        self.docs, self.scorer, self.threshold = docs.repartition("doc_id"), scorer, threshold

    @cached_property
    def lines(self) -> DataFrame:
        return D.detect_lines(self.docs, self.scorer, self.threshold)

    @cached_property
    def found(self) -> DataFrame:
        return self.lines.select(*D.COLUMNS)

    @cached_property
    def structure(self) -> DataFrame:
        return L.file_structure(self.docs)

    @cached_property
    def rules(self) -> DataFrame:
        return L.learn_rules(self.found, self.structure)

    @cached_property
    def rule_maps(self) -> DataFrame:
        """The learned levels, one small row a document. An exchange of their own: all branches that use them read the one
        stage, so that lines are detected for them once."""
        return L.rule_maps(self.rules).repartition(F.xxhash64("doc_id"))

    @cached_property
    def levels(self) -> DataFrame:
        return L.category_levels(self.found, self.rule_maps)

    @cached_property
    def hierarchy(self) -> DataFrame:
        return L.apply_rules(self.found, self.rule_maps)

    @cached_property
    def chunks(self) -> DataFrame:
        return C.line_chunks(self.lines, self.rule_maps)

    @cached_property
    def rag(self) -> DataFrame:
        return R.rag_chunks(self.chunks)

    @cached_property
    def tree(self) -> DataFrame:
        return R.machine_tree(self.chunks)

    @cached_property
    def files(self) -> DataFrame:
        return self.docs.select("doc_id", "file_name").join(self.structure.select("doc_id", "learning_region"), "doc_id")

    @cached_property
    def markdown(self) -> DataFrame:
        return M.to_markdown(self.chunks, self.files)

    @cached_property
    def processing_stats(self) -> DataFrame:
        """doc_id, total_lines, learning_lines, total_symbols_detected, learned_rules_count, rule_coverage, final_levels,
        line_based_chunks_count."""
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        rows = self.structure.join(self.rule_maps.select("doc_id", F.size("rules").alias("learned_rules_count")), "doc_id", "left")
        rows = rows.join(L.coverage(self.levels), "doc_id", "left").join(self.chunks.groupBy("doc_id").agg(F.count("*").alias("line_based_chunks_count")), "doc_id", "left")
        rows = rows.withColumnsRenamed({"total_symbols": "total_symbols_detected", "total_levels": "final_levels"})
        learning = F.coalesce(F.col("total_lines") - F.col("learn_start"), F.lit(0)).cast("long")
        return rows.select(
            "doc_id", "total_lines", learning.alias("learning_lines"), zero("total_symbols_detected"), zero("learned_rules_count"), F.coalesce("rule_coverage", F.lit(0.0)).alias("rule_coverage"),
            zero("final_levels"), zero("line_based_chunks_count"),
        )

    @cached_property
    def summaries(self) -> DataFrame:
        """doc_id, summary: one line of text."""
        s = self.files.join(self.processing_stats, "doc_id")
        text = F.format_string("%s: region %s, %d symbols, %d rules, %d levels, %d chunks", "file_name", "learning_region", "total_symbols_detected", "learned_rules_count", "final_levels", "line_based_chunks_count")
        return s.select("doc_id", text.alias("summary"))

    @cached_property
    def payload(self) -> DataFrame:
        return writers.machine_payload(self.files, self.processing_stats, self.rag)

    def batch_totals(self) -> DataFrame:
        """learning_region, documents, lines, symbols, mean_coverage."""
        rows = self.files.join(self.processing_stats, "doc_id")
        return rows.groupBy("learning_region").agg(F.count("*").alias("documents"), F.sum("total_lines").alias("lines"), F.sum("total_symbols_detected").alias("symbols"), F.avg("rule_coverage").alias("mean_coverage"))

    def keep(self) -> Analysis:
        self.lines = self.lines.persist()
        self.rules = self.rules.persist()
        self.chunks = self.chunks.persist()
        return self

    def report(self) -> str:
        return writers.report("Adaptive detection", {
            "Regions": self.batch_totals().orderBy("learning_region"),
            "Methods": D.by_method(self.found).orderBy("method_used"),
            "Categories": D.by_category(self.found).orderBy(F.desc("count"), "symbol_category"),
            "Slowest to read: most symbols": D.file_stats(self.found).orderBy(F.desc("total_markers"), "doc_id").limit(20),
            "Chunks": C.chunk_types(self.chunks).orderBy("level", "chunk_type"),
        })


def process_directory(spark: SparkSession, in_dir: str, out_dir: str, max_files: int | None = None, reports: bool = True, file_per_document: bool = True) -> Analysis:
    """Analyse the JSON files of a folder; write machine results, Markdown (a file a document, or JSON lines), the files' errors
    and, unless told otherwise, the report, with each document's details as JSON lines and as text."""
    files = readers.judgment_files(spark, in_dir, max_files)
    analysis = Analysis(files.where("error IS NULL").select("doc_id", "file_name", "jfull")).keep()
    writers.write_machine_json(analysis.payload, f"{out_dir}/machine")
    if file_per_document:
        writers.write_markdown(analysis.markdown, analysis.files, f"{out_dir}/markdown")
    else:
        writers.write_json(analysis.markdown.join(analysis.files.select("doc_id", "file_name"), "doc_id"), f"{out_dir}/markdown")
    writers.write_errors(files, f"{out_dir}/errors")
    if reports:
        details = R_.adaptive_details(analysis.processing_stats, analysis.rules, analysis.hierarchy, analysis.files)
        writers.write_json(details, f"{out_dir}/details")
        R_.details_text(details).select("value").write.mode("overwrite").text(f"{out_dir}/details_text")
        writers.write_text(spark, analysis.report() + writers.table_text("Errors", A.error_counts(files).orderBy("kind")), f"{out_dir}/report")
    return analysis


def detect_directory(spark: SparkSession, in_dir: str, out_dir: str, max_files: int | None = None, scorer: D.Scorer | None = None) -> str:
    """Detect the markers of the JSON files of a folder; write a result for each file, totals, errors and the report; its text."""
    files = readers.judgment_files(spark, in_dir, max_files)
    docs = files.where("error IS NULL").select("doc_id", "file_name", "jfull")
    writers.write_errors(files, f"{out_dir}/errors")
    return R_.save_batch(D.detect(docs, scorer), docs, out_dir)


def analyze_corpus(spark: SparkSession, in_dir: str, out_dir: str, max_files: int | None = None) -> str:
    """Statistics of the JSON files of a folder, as save_corpus leaves them; the report."""
    return R_.save_corpus(readers.judgment_files(spark, in_dir, max_files), out_dir)


def markdown_of_machine_results(spark: SparkSession, path: str) -> DataFrame:
    """filename, markdown of the machine results in a folder, without analysing the judgments again.

    Chunks are taken by start line, then in the file's order. Results without chunks have no row."""
    rows = readers.machine_results(spark, path).where("error IS NULL").withColumn("doc_id", F.xxhash64("filename"))
    order = Window.partitionBy("doc_id").orderBy(F.coalesce("start_line", F.lit(0)), "seq")
    rows = rows.withColumn("seq", (F.row_number().over(order) - 1).cast("long"))
    files = rows.groupBy("doc_id").agg(F.first("filename").alias("file_name"), F.first(F.coalesce("learning_region", F.lit(""))).alias("learning_region"))
    return M.to_markdown(rows, files).join(files.select("doc_id", F.col("file_name").alias("filename")), "doc_id").select("filename", "markdown")


RUNS = {
    "analyse": lambda spark, a: process_directory(spark, a.input, a.output, a.max_files, not a.no_report, not a.json_lines),
    "detect": lambda spark, a: detect_directory(spark, a.input, a.output, a.max_files),
    "strict": lambda spark, a: R_.save_ultra_strict(readers.judgment_files(spark, a.input, a.max_files).where("error IS NULL"), a.output),
    "corpus": lambda spark, a: analyze_corpus(spark, a.input, a.output, a.max_files),
    "sections": lambda spark, a: R_.save_sections(readers.judgment_files(spark, a.input, a.max_files), a.output),
    "markdown": lambda spark, a: writers.write_json(markdown_of_machine_results(spark, a.input), a.output),
    "locations": lambda spark, a: writers.write_text(spark, R_.location_report(Analysis(readers.judgment_files(spark, a.input, a.max_files).where("error IS NULL").select("doc_id", "file_name", "jfull")).rag), a.output),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Analyse the structure of judgments")
    parser.add_argument("run", choices=sorted(RUNS))
    parser.add_argument("input", help="a folder of JSON files, or one of them")
    parser.add_argument("output")
    parser.add_argument("--max-files", type=int)
    parser.add_argument("--no-report", action="store_true")
    parser.add_argument("--json-lines", action="store_true", help="Markdown as JSON lines, not a file a document")
    parser.add_argument("--verbose", action="store_true")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    spark = SparkSession.builder.appName("lexstrata").getOrCreate()
    log.info("Running %s over %s", args.run, args.input)
    RUNS[args.run](spark, args)
    log.info("Wrote %s", args.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
