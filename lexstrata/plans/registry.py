"""All core queries by name, over the tables of a data folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import symbols as S
from ..functions import text as X
from ..operators import chunks as C
from ..operators import detect as D
from ..operators import evaluate as E
from ..operators import lines as N
from ..operators import markdown as M
from ..operators import rag as R
from ..operators import sections as P
from ..operators import stats as A
from ..operators import structure as L
from ..sources import readers, writers
from .oracle import DIGITS, ORACLE, ROUNDED  # noqa: F401
from .pipeline import Analysis

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = "jdg_a5_hierarchy_levels"
QUERIES: dict[str, Query] = {}
SEP = "¦"


def query(name: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return add


def flat(c: Column | str) -> Column:
    """An array as text, so that other engines' nested types needn't match."""
    return F.array_join(c, SEP)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return readers.judgments(spark, d)


def _analysis(spark: SparkSession, d: str) -> Analysis:
    return Analysis(_docs(spark, d))


def _over_docs(name: str, f: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, d: f(_docs(spark, d))


def _over_analysis(name: str, f: Callable[[Analysis], DataFrame]) -> None:
    QUERIES[name] = lambda spark, d: f(_analysis(spark, d))


# Sources and lines
_over_docs("jdg_s1_judgments", lambda d: d)
_over_docs("jdg_s5_raw_length", lambda d: d.select("doc_id", F.length("jfull").cast("long").alias("n_chars")))
_over_docs("jdg_lines_crlf", N.crlf_lines)
_over_docs("jdg_lines_lf", N.lf_lines)
_over_docs("jdg_p1_without_space", lambda d: N.lf_lines(d).select("doc_id", "idx0", X.without_space(F.col("raw")).alias("bare"), X.strip(F.col("raw")).alias("stripped")))

def _written(spark: SparkSession, name: str) -> str:
    """A folder of the shared one for files that a query writes before it reads them."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="lexstrata-")
    return writers.full_path(spark, f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}")[0]


@query("src_s1_json_files")
def json_files(spark: SparkSession, d: str) -> DataFrame:
    """The judgments as JSON files, one each, read again: rows with a null text have no JFULL."""
    path = _written(spark, "json-files")
    rows = _docs(spark, d)
    writers.write_file_per_document(rows, path, F.concat(F.col("doc_id").cast("string"), F.lit(".json")), F.to_json(F.struct(F.col("jid").alias("JID"), F.col("jfull").alias("JFULL"))))
    return readers.judgment_files(spark, path).select("file_name", "jid", "jfull", "error")


@query("src_s6_training_csv")
def training_csv(spark: SparkSession, d: str) -> DataFrame:
    """The labelled lines as a CSV file with a header, read again; of a null and an empty field a CSV file makes no difference."""
    path = _written(spark, "training-csv")
    empty = lambda c: F.coalesce(c, F.lit(""))
    rows = readers.table(spark, d, "labelled_lines").select(empty(F.col("line_text")).alias("line_text"), empty(F.col("sentiment")).alias("sentiment"))
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    read = readers.labelled_csv(spark, path).select(empty(F.col("line_text")).alias("line_text"), empty(F.col("sentiment")).alias("sentiment"))
    return read.groupBy("line_text", "sentiment").agg(F.count("*").alias("count"))


# Sections and dates
_over_docs("jdg_p2_line_labels", lambda d: N.crlf_lines(d).select("doc_id", "idx0", P.line_label(F.col("raw")).alias("label")))
_over_docs("jdg_p3_date_lines", lambda d: N.lf_lines(d).where(X.is_roc_date(F.col("raw"))).select("doc_id", "idx0"))
_over_docs("jdg_w1_carry_forward", lambda d: P.split_sections(d, copy_facts=False))
_over_docs("jdg_t1_sections", P.split_sections)
_over_docs("jdg_t1_section_stats", P.section_stats)
_over_docs("jdg_t2_dates", P.extract_dates)

# Detection
_over_docs("jdg_p5_private_use", lambda d: _first_chars(d).where(S.is_pua(F.col("symbol"))).select("doc_id", "idx0", S.code_name(F.col("symbol")).alias("code")))
_over_docs("jdg_p6_symbol_category", lambda d: D.with_category(_first_chars(d)).groupBy("symbol", F.coalesce("category", F.lit("無效字符")).alias("category")).agg(F.count("*").alias("count")))
_over_docs("jdg_p7_pua_group", lambda d: _first_chars(d).select("doc_id", "idx0", S.pua_group(F.col("symbol")).alias("pua_group")).where("pua_group IS NOT NULL"))
_over_docs("jdg_p9_ultra_strict", D.ultra_strict)
_over_docs("jdg_p10_strict_pua", lambda d: D.detect(d).where("method_used = 'ultra_strict_pua'").select("doc_id", "line_number", "detected_symbol"))
_over_docs("jdg_p11_soft_candidates", lambda d: D.detect(d).where("method_used = 'soft_rule_only'").select("doc_id", "line_number", "detected_symbol", "symbol_category"))
_over_docs("jdg_p12_detect", D.detect)
_over_docs("jdg_j1_dictionary_join", lambda d: D.with_category(_first_chars(d)).where("category IS NOT NULL").select("doc_id", "idx0", "symbol", "category"))
_over_docs("jdg_w2_previous_line", lambda d: N.lines_with_before(d).select("doc_id", "idx0", "proper"))


def _first_chars(d: DataFrame) -> DataFrame:
    lines = N.lf_lines(d).select("doc_id", "idx0", F.substring(X.strip(F.col("raw")), 1, 1).alias("symbol"))
    return lines.where("symbol <> ''")


# Analyses of detections
_over_docs("jdg_a1_ultra_by_category", lambda d: D.ultra_by_category(D.ultra_strict(d)).select("doc_id", "category", "count", flat(F.transform("members", lambda m: F.concat(m["line_number"], m["symbol"]))).alias("members")))
_over_docs("jdg_a2_ultra_by_pua_group", lambda d: D.ultra_by_pua_group(D.ultra_strict(d)))
_over_docs("jdg_a3_ultra_by_code", lambda d: D.ultra_by_code(D.ultra_strict(d)))
_over_docs("jdg_a3b_ultra_by_level", lambda d: D.ultra_by_level(D.ultra_strict(d)))
_over_docs("jdg_k7_top_codes", lambda d: D.ultra_by_code(D.ultra_strict(d)).orderBy(F.desc("count"), "unicode_code").limit(20))
_over_docs("jdg_a4_by_method", lambda d: D.by_method(D.detect(d)))


@query(FLAGSHIP)
def hierarchy_levels(spark: SparkSession, d: str) -> DataFrame:
    rows = D.hierarchy_levels(D.detect(_docs(spark, d)))
    return rows.withColumn("examples", flat(F.transform("examples", lambda e: F.concat(e["line_number"], F.lit(":"), e["text"]))))


_over_docs("jdg_a6_by_category", lambda d: D.by_category(D.detect(d)))
_over_docs("jdg_a7_score_stats", lambda d: D.score_stats(D.detect(d)))
_over_docs("jdg_a7b_summary", lambda d: D.detection_summary(D.detect(d)))
_over_docs("jdg_a12b_file_stats", lambda d: D.file_stats(D.detect(d)))
_over_docs("jdg_a12b_batch_totals", lambda d: D.batch_totals(D.file_stats(D.detect(d))))
_over_docs("jdg_a12c_marker_projection", lambda d: D.marker_projection(D.detect(d)))
_over_docs("jdg_k5_most_markers", lambda d: D.file_stats(D.detect(d)).orderBy(F.desc("total_markers"), "doc_id").limit(20).select("doc_id", "total_markers"))

# The detections table holds scored results of a model; the same analyses run on it.
_scored = lambda spark, d: readers.table(spark, d, "detections")
QUERIES["det_a4_by_method"] = lambda spark, d: D.by_method(_scored(spark, d))
QUERIES["det_a7_score_stats"] = lambda spark, d: D.score_stats(_scored(spark, d))
QUERIES["det_a12b_file_stats"] = lambda spark, d: D.file_stats(_scored(spark, d))

# Learning and application of levels
_over_docs("jdg_t3_structure", L.file_structure)
_over_analysis("jdg_a13_rules", lambda a: a.rules.withColumn("examples", flat("examples")))
_over_analysis("jdg_j4_category_levels", lambda a: a.levels.withColumn("examples", flat(F.transform("examples", lambda e: e["text"]))))
_over_analysis("jdg_a14_hierarchy", lambda a: a.hierarchy)
_over_analysis("jdg_a14_coverage", lambda a: L.coverage(a.levels))

# Chunks
_over_docs("jdg_p4_special_markers", C.special_markers)
_over_analysis("jdg_t4_line_chunks", lambda a: a.chunks.withColumn("content_lines", flat("content_lines")))
_over_analysis("jdg_a15_level_content", lambda a: C.level_content(a.chunks).withColumn("content", flat("content")))
_over_analysis("jdg_a15b_chunk_types", lambda a: C.chunk_types(a.chunks))
_over_analysis("jdg_t5_rag_chunks", lambda a: a.rag.withColumns({"hierarchy_path": flat(F.col("hierarchy_path").cast("array<string>")), "parent_titles": flat("parent_titles")}))
_over_analysis("jdg_p20_locations", lambda a: a.rag.groupBy("chunk_type", "location").agg(F.count("*").alias("count")))
_over_analysis("jdg_t6_machine_tree", lambda a: a.tree.withColumn("content_lines", flat("content_lines")))
_over_analysis("jdg_a16_location_stats", lambda a: R.location_stats(a.rag))
_over_analysis("jdg_a19_processing_stats", lambda a: a.processing_stats)
_over_analysis("jdg_a12_batch_totals", lambda a: a.batch_totals())
_over_analysis("jdg_p21_summaries", lambda a: a.summaries)
_CHUNK_TEXT = ("chunk_id", "chunk_type", "level", "start_line", "end_line", "title", "leveling_symbol", "location", "full_text")
_over_analysis("jdg_k2_machine_payload", lambda a: a.payload.select("doc_id", "filename", "learning_region", "processing_stats.*", flat(F.transform("rag_chunks", lambda c: F.concat_ws("|", *[c[x] for x in _CHUNK_TEXT]))).alias("chunks")))


@query("rag_a16_location_stats")
def rag_location_stats(spark: SparkSession, d: str) -> DataFrame:
    return R.location_stats(readers.table(spark, d, "rag_chunks"))


# Markdown
_over_analysis("jdg_t7_markdown", lambda a: a.markdown)
_over_analysis("jdg_p19_second_date", lambda a: M.second_date_position(a.chunks))
_over_analysis("jdg_p18_between_marks", lambda a: a.chunks.select("doc_id", "seq", M.between_marks(a.chunks).alias("near")).where("near").select("doc_id", "seq"))


@query("jdg_p13_p16_text_kinds")
def text_kinds(spark: SparkSession, d: str) -> DataFrame:
    lines = N.lf_lines(_docs(spark, d))
    c = F.col("raw")
    kinds = {"appendix": M.is_appendix(c), "appendix_header": M.is_appendix_header(c, F.lit(True)), "section": M.is_section_title(c), "date": M.is_date_title(c)}
    return lines.select("doc_id", "idx0", *[v.alias(k) for k, v in kinds.items()]).where("appendix OR appendix_header OR section OR date")


@query("lc_p17_sanitize")
def sanitize(spark: SparkSession, d: str) -> DataFrame:
    return readers.table(spark, d, "line_chunks").select("row_id", flat(M.sanitize_lines(F.col("content_lines"))).alias("lines"))


# Corpus statistics
_over_docs("jdg_a9_part_counts", A.part_counts)
_over_docs("jdg_a10_doc_stats", A.doc_stats)
_over_docs("jdg_a8_section_summary", lambda d: A.section_summary(A.doc_stats(d)))
_over_docs("jdg_a9b_section_presence", lambda d: A.section_summary(A.doc_stats(d)).select("section", "present"))
_over_docs("jdg_a10_class_counts", lambda d: A.class_counts(A.doc_stats(d)))
_over_docs("jdg_a10b_traditional", lambda d: A.traditional_counts(A.doc_stats(d)))
_over_docs("jdg_a10c_largest", lambda d: A.largest_classes(A.doc_stats(d)))
_over_docs("jdg_a11_date_summary", A.date_summary)
_over_docs("jdg_a11_month_counts", A.month_counts)
_over_docs("jdg_a11b_sizes", lambda d: A.size_summary(A.doc_stats(d)))
_over_docs("jdg_a11c_errors", lambda d: A.error_counts(d.select(F.when(F.col("jfull").isNull(), F.concat(F.lit("Error processing: "), "file_name")).alias("error"))))


# Evaluation
@query("ll_a18_class_balance")
def class_balance(spark: SparkSession, d: str) -> DataFrame:
    return E.class_balance(readers.table(spark, d, "labelled_lines"))


@query("ll_u6_split")
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.table(spark, d, "labelled_lines").select("line_id", E.clean_label(F.col("sentiment")).alias("label")).where("label IS NOT NULL")
    return E.stratified_split(rows, "label", "line_id").groupBy("label", "is_train").agg(F.count("*").alias("count"))


@query("det_a17_metrics")
def detection_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The scores of the detections table against its own rule: a symbol was detected."""
    rows = readers.table(spark, d, "detections").where("bert_score IS NOT NULL AND final_prediction IS NOT NULL")
    return E.metrics(rows.select(F.col("detected_symbol").isNotNull().cast("double").alias("label"), F.col("final_prediction").cast("double").alias("prediction"), F.col("bert_score").alias("score")))


@query("ll_u3_u7_compare_models")
def compare_models(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.table(spark, d, "labelled_lines").where("line_text IS NOT NULL").select("line_id", F.col("line_text").alias("text"), E.clean_label(F.col("sentiment")).alias("label")).where("label IS NOT NULL")
    return E.compare(rows).metrics


# The same generic operators over documents
def _doc_lines(spark: SparkSession, d: str) -> DataFrame:
    return N.lf_lines(readers.table(spark, d, "documents").select("doc_id", F.col("text").alias("jfull")))


@query("doc_lines")
def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    return _doc_lines(spark, d).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("raw")).alias("n_chars"))


@query("doc_w5_islands")
def doc_islands(spark: SparkSession, d: str) -> DataFrame:
    """Runs of lines that are not blank."""
    rows = _doc_lines(spark, d).withColumn("full", X.strip(F.col("raw")) != "")
    rows = rows.where("full").withColumn("island", F.col("idx0") - F.row_number().over(N.in_order()))
    return rows.groupBy("doc_id", "island").agg(F.min("idx0").alias("first"), F.max("idx0").alias("last")).select("doc_id", "first", "last")


@query("doc_w3_first_appearance")
def doc_first_appearance(spark: SparkSession, d: str) -> DataFrame:
    """First characters of lines, ranked in each document by first appearance."""
    rows = _doc_lines(spark, d).select("doc_id", "idx0", F.substring(X.strip(F.col("raw")), 1, 1).alias("c")).where("c <> ''")
    rows = rows.groupBy("doc_id", "c").agg(F.min("idx0").alias("first"))
    return rows.select("doc_id", "c", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("first")).cast("long").alias("rank"))


@query("doc_a8_length_stats")
def doc_lengths(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.table(spark, d, "documents").where("text IS NOT NULL").groupBy("source", F.length("text").cast("long").alias("n")).agg(F.count("*").alias("docs"))
    rows = rows.groupBy("source").agg(F.sum("docs").alias("total"), A.histogram_median(F.col("n"), F.col("docs")).alias("median"), F.min("n").alias("min"), F.max("n").alias("max"))
    return rows.withColumnRenamed("total", "docs")


@query("doc_top_sources")
def doc_top_sources(spark: SparkSession, d: str) -> DataFrame:
    return readers.table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "source").limit(10)


def _rounded(f: Query, columns: list[str]) -> Query:
    return lambda spark, d: f(spark, d).withColumns({c: F.round(c, DIGITS) for c in columns})


for _name, _columns in ROUNDED.items():
    QUERIES[_name] = _rounded(QUERIES[_name], _columns)
