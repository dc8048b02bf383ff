"""Reports: small aggregates as text, and the files that runs leave. Every table is a small aggregate, written whole, or a top-k list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import detect as D
from ..operators import evaluate as E
from ..operators import rag as R
from ..operators import stats as A
from ..operators.sections import sections_by_document
from ..sources.writers import report, write_by_class, write_errors, write_json, write_text

HIGH, LOW, DENSE = 0.8, 0.6, 0.5


def detection_report(found: DataFrame) -> str:
    """Methods, categories, confidence bands, levels and a preview of detected markers."""
    bands = F.when(F.col("bert_score") >= HIGH, "high").when(F.col("bert_score") >= LOW, "middle").otherwise("low")
    levels = D.hierarchy_levels(found, examples=2).groupBy("symbol_category", "level").agg(F.count("*").alias("documents"), F.sum("count").alias("markers"))
    preview = found.where("final_prediction").orderBy("doc_id", "line_number").select("doc_id", "line_number", "detected_symbol", "symbol_category", F.left("line_text", F.lit(50)).alias("text")).limit(15)
    # Markers of over DENSE of the lines make a document dense.
    dense = D.file_stats(found).groupBy(F.when(F.col("total_markers") > DENSE * F.col("total_lines"), "dense").otherwise("mixed").alias("density")).agg(F.count("*").alias("documents"))
    return report("Detection", {
        "Summary": D.detection_summary(found), "Methods": D.by_method(found).orderBy("method_used"), "Categories": D.by_category(found).orderBy(F.desc("count"), "symbol_category"),
        "Confidence": found.where("final_prediction").groupBy(bands.alias("band")).agg(F.count("*").alias("count")).orderBy("band"), "Scores": D.score_stats(found), "Density": dense.orderBy("density"),
        "Levels": levels.orderBy("level", F.desc("documents"), "symbol_category"), "First markers": preview,
    })


def ultra_strict_report(markers: DataFrame) -> str:
    samples = markers.where("is_pua").groupBy("category").agg(F.array_join(F.slice(F.array_sort(F.collect_set("unicode_code")), 1, 5), " ").alias("codes"))
    return report("Strict markers", {
        "Categories": markers.groupBy("category").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "category"), "Code points": D.ultra_by_code(markers).orderBy(F.desc("count"), "unicode_code").limit(20),
        "Private-use groups": D.ultra_by_pua_group(markers).orderBy(F.desc("count"), "category"), "Samples": samples.orderBy("category"),
        "First markers": markers.orderBy("doc_id", "line_number").select("doc_id", "line_number", "symbol", "category").limit(15),
    })


def save_ultra_strict(docs: DataFrame, path: str) -> str:
    """Strict markers and their aggregates as JSON lines, and the report; its text."""
    markers = D.ultra_strict(docs)
    text = ultra_strict_report(markers)
    write_json(markers, f"{path}/markers")
    for name, rows in (("by_category", D.ultra_by_category(markers)), ("by_code", D.ultra_by_code(markers)), ("by_pua_group", D.ultra_by_pua_group(markers)), ("by_level", D.ultra_by_level(markers))):
        write_json(rows, f"{path}/{name}")
    write_text(docs.sparkSession, text, f"{path}/report")
    return text


def batch_report(found: DataFrame) -> str:
    """Totals of a batch, and the documents with most markers."""
    files = D.file_stats(found)
    return report("Batch", {"Totals": D.batch_totals(files), "Most markers": files.orderBy(F.desc("total_markers"), "doc_id").limit(20)})


def location_report(rag: DataFrame) -> str:
    return report("Locations", {"Locations": R.location_stats(rag).orderBy(F.desc("count"), "location")})


def corpus_report(docs: DataFrame, case_types: int = 10) -> str:
    """Years and courts in full, the case_types most frequent case types and the number of those left out."""
    stats, parts = A.doc_stats(docs), A.part_counts(docs)
    of = lambda kind: parts.where(F.col("kind") == kind).select(F.col("value").alias(kind), "count")
    return report("Corpus analysis", {
        "Sections": A.section_summary(stats).orderBy("section"), "Classes": A.class_counts(stats).orderBy(F.desc("count"), "symbol"), "Traditional classes": A.traditional_counts(stats).orderBy(F.desc("count"), "class"),
        "Largest classes": A.largest_classes(stats), "Years": of("year").orderBy("year"), "Case types": of("case_type").orderBy(F.desc("count"), "case_type").limit(case_types),
        "Case types left out": of("case_type").agg(F.greatest(F.count("*") - case_types, F.lit(0)).alias("types")), "Courts": of("court").orderBy("court"),
        "Dates": A.date_summary(docs), "Months": A.month_counts(docs), "Sizes": A.size_summary(stats),
    })


def save_batch(found: DataFrame, files: DataFrame, path: str) -> str:
    """What a batch run leaves, as JSON lines: a result for each document (its counts, and its markers in order), the totals,
    and the report; its text. files: doc_id, file_name."""
    stats = D.file_stats(found)
    item = F.struct("line_number", "detected_symbol", "symbol_category", "rule_based_score", "bert_score", "method_used", "line_text")
    markers = found.where("final_prediction").groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("markers"))
    write_json(files.select("doc_id", "file_name").join(stats, "doc_id").join(markers, "doc_id", "left"), f"{path}/results")
    write_json(D.batch_totals(stats), f"{path}/stats", one_file=True)
    text = batch_report(found)
    write_text(found.sparkSession, text, f"{path}/report")
    return text


def adaptive_details(stats: DataFrame, rules: DataFrame, hierarchy: DataFrame, files: DataFrame, first: int = 5) -> DataFrame:
    """doc_id, file_name, learning_region, the counts of stats, the first rules by level and the first markers by line."""

    def firsts(rows: DataFrame, order: str, fields: list[str], name: str) -> DataFrame:
        items = F.array_sort(F.collect_list(F.struct(order, *[c for c in fields if c != order])))
        return rows.groupBy("doc_id").agg(F.slice(items, 1, first).alias(name))

    top_rules = firsts(rules, "assigned_level", ["symbol_category", "assigned_level", "confidence", "occurrences"], "first_rules")
    top_marks = firsts(hierarchy, "line_number", ["line_number", "detected_symbol", "symbol_category", "assigned_level", "is_learned_rule"], "first_markers")
    return files.join(stats, "doc_id").join(top_rules, "doc_id", "left").join(top_marks, "doc_id", "left")


def details_text(details: DataFrame) -> DataFrame:
    """doc_id, value: a Markdown section for each document."""
    lines = lambda items, show: F.array_join(F.transform(F.coalesce(items, F.array()), show), "\n")
    rules = lines(F.col("first_rules"), lambda r: F.format_string("- level %s: %s, %s times, confidence %.2f", r["assigned_level"], r["symbol_category"], r["occurrences"], r["confidence"]))
    marks = lines(F.col("first_markers"), lambda m: F.format_string("- line %s: %s, level %s", m["line_number"], m["detected_symbol"], m["assigned_level"]))
    head = F.format_string("## %s\n\nregion %s, %s symbols, %s rules, coverage %.2f, %s levels, %s chunks\n", "file_name", "learning_region", "total_symbols_detected", "learned_rules_count", "rule_coverage", "final_levels", "line_based_chunks_count")
    return details.select("doc_id", F.concat_ws("\n", head, rules, marks, F.lit("")).alias("value"))


def save_corpus(files: DataFrame, path: str) -> str:
    """What a corpus analysis leaves: the statistics of every document, also by class, the classes with their counts, the
    errors, and the report; its text. files: of judgment_files."""
    docs = files.where("error IS NULL").select("doc_id", "file_name", "jfull")
    stats = A.doc_stats(docs).join(docs.select("doc_id", "file_name"), "doc_id")
    write_json(stats, f"{path}/raw_data")
    write_by_class(stats, f"{path}/classes")
    write_json(A.class_counts(A.doc_stats(docs)).orderBy(F.desc("count"), "symbol"), f"{path}/class_summary", one_file=True)
    write_errors(files, f"{path}/errors")
    text = corpus_report(docs) + report("Errors", {"Errors": A.error_counts(files).orderBy("kind")})
    write_text(files.sparkSession, text, f"{path}/report")
    return text


def save_sections(files: DataFrame, path: str) -> None:
    """The sections of every document as JSON lines, and how many files could be split and how many not."""
    docs = files.where("error IS NULL").select("doc_id", "file_name", "jfull")
    write_json(sections_by_document(docs).join(docs.select("doc_id", "file_name"), "doc_id"), f"{path}/results")
    counts = files.agg(F.count_if(F.col("error").isNull()).alias("success"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.count("*").alias("total"))
    write_json(counts, f"{path}/statistics", one_file=True)


def save_detections(found: DataFrame, path: str) -> None:
    """All detections, and the hierarchy of the positive ones, as JSON lines."""
    found.write.mode("overwrite").json(f"{path}/detections")
    D.hierarchy_levels(found).write.mode("overwrite").json(f"{path}/hierarchy")


def save_comparison(comparison: E.Comparison, path: str) -> str:
    """Every model, the metrics as JSON and CSV, and a summary whose first model is the best; the summary."""
    for name, model in comparison.models.items():
        model.write().overwrite().save(f"{path}/models/{name.replace(' ', '_')}")
    comparison.metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics_json")
    comparison.metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/metrics_csv")
    samples = comparison.info.first().asDict()  # one row
    best = comparison.metrics.limit(1).select(F.current_timestamp().alias("trained_at"), F.lit(path).alias("model_path"), *[F.lit(v).alias(k) for k, v in samples.items()], "*")
    write_json(best, f"{path}/training_info", one_file=True)
    text = report("Model comparison", {"Models": comparison.metrics, "Classes": comparison.class_reports})
    write_text(comparison.metrics.sparkSession, text, f"{path}/summary")
    return text
