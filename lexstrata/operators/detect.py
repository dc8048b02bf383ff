"""Detection of hierarchy markers, by rule and with an optional scorer, and analyses of what is found."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import symbols as S
from ..functions import text as X
from .lines import lf_lines, lines_with_before

Scorer = Callable[[Column], Column]
SOFT = ("soft_rule_only", "soft_rule_bert")


def with_category(rows: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Add category: of the standard table, else the private-use group, else null. The table has 115 rows and is broadcast."""
    table = S.symbol_table(rows.sparkSession).withColumnsRenamed({"symbol": symbol, "category": "_standard"})
    return rows.join(F.broadcast(table), symbol, "left").withColumn("category", F.coalesce("_standard", S.pua_group(F.col(symbol)))).drop("_standard")


def ultra_strict(docs: DataFrame) -> DataFrame:
    r"""Markers in the strict form: one symbol, 、 and text; the line before ends with \r, except before the first line."""
    lines = lines_with_before(docs).withColumn("content", X.strip(F.col("raw")))
    lines = lines.where(F.col("proper") & F.col("content").rlike(r"(?ds)^.、"))
    lines = with_category(lines.withColumn("symbol", F.substring("content", 1, 1))).where("category IS NOT NULL")
    return lines.select(
        "doc_id", (F.col("idx0") + 1).alias("line_number"), "symbol", S.code_name(F.col("symbol")).alias("unicode_code"), "category", "content",
        S.is_pua(F.col("symbol")).alias("is_pua"), F.lit(True).alias("has_proper_newline"),
    )


COLUMNS = ["doc_id", "line_number", "line_text", "detected_symbol", "symbol_category", "rule_based_score", "bert_score", "final_prediction", "method_used"]


def detect(docs: DataFrame, scorer: Scorer | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per line: doc_id, line_number (from 1), line_text, detected_symbol, symbol_category, rule_based_score,
    bert_score, final_prediction, method_used."""
    return detect_lines(docs, scorer, threshold).select(*COLUMNS)


def detect_lines(docs: DataFrame, scorer: Scorer | None = None, threshold: float = 0.5) -> DataFrame:
    """The columns of detect, idx0 and the raw line.

    Blank lines, private-use symbols before 、, and lines that begin with a standard symbol are told apart by rule; only
    the last are scored. They are filtered before the scorer, since Spark would run it on all rows inside a when."""
    lines = lf_lines(docs).withColumn("line_text", X.strip(F.col("raw"))).withColumn("symbol", F.substring("line_text", 1, 1))
    lines = with_category(lines)
    pua = S.is_pua(F.col("symbol"))
    kind = (
        F.when(F.col("line_text") == "", "empty_line")
        .when(pua & (F.substring("line_text", 2, 1) == "、"), "ultra_strict_pua")
        .when(~pua & F.col("category").isNotNull(), "soft_rule_only")
        .otherwise("rule_rejected")
    )
    lines = lines.withColumn("kind", kind)

    def rows(lines: DataFrame, bert: Column, prediction: Column, method: Column) -> DataFrame:
        marked = F.col("kind").isin("ultra_strict_pua", "soft_rule_only")
        rule = F.when(F.col("kind") == "ultra_strict_pua", 1.0).when(F.col("kind") == "soft_rule_only", 0.5).otherwise(0.0)
        return lines.select(
            "doc_id", "idx0", "raw", (F.col("idx0") + 1).alias("line_number"), "line_text", F.when(marked, F.col("symbol")).alias("detected_symbol"), F.when(marked, F.col("category")).alias("symbol_category"),
            rule.alias("rule_based_score"), bert.cast("double").alias("bert_score"), prediction.alias("final_prediction"), method.alias("method_used"),
        )

    certain = F.when(F.col("kind") == "ultra_strict_pua", 1.0).otherwise(0.0)
    if scorer is None:
        return rows(lines, certain, F.col("kind").isin("ultra_strict_pua", "soft_rule_only"), F.col("kind"))
    soft = lines.where("kind = 'soft_rule_only'").withColumn("score", scorer(F.col("line_text")))
    return rows(lines.where("kind <> 'soft_rule_only'"), certain, F.col("kind") == "ultra_strict_pua", F.col("kind")).unionByName(
        rows(soft, F.col("score"), F.col("score") >= threshold, F.lit("soft_rule_bert"))
    )


def hierarchy_levels(found: DataFrame, examples: int = 3) -> DataFrame:
    """doc_id, symbol_category, level, count, is_pua, examples: categories ranked by first appearance in the document."""
    found = found.where("final_prediction")
    item = F.struct("line_number", F.col("detected_symbol").alias("symbol"), X.shorten(F.col("line_text")).alias("text"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "symbol_category").orderBy("line_number"))
    cats = found.withColumn("nth", nth).withColumn("item", item).groupBy("doc_id", "symbol_category").agg(
        F.min("line_number").alias("first_line"),
        F.count("*").alias("count"),
        F.min_by(S.is_pua(F.col("detected_symbol")), "line_number").alias("is_pua"),
        F.array_sort(F.collect_list(F.when(F.col("nth") <= examples, F.col("item")))).alias("examples"),
    )
    level = F.dense_rank().over(Window.partitionBy("doc_id").orderBy("first_line"))
    return cats.select("doc_id", "symbol_category", level.cast("long").alias("level"), "count", "is_pua", "examples")


def by_method(found: DataFrame) -> DataFrame:
    return found.groupBy("method_used").agg(F.count("*").alias("total"), F.count_if("final_prediction").alias("positive"))


def by_category(found: DataFrame) -> DataFrame:
    """Positive detections by category."""
    return found.where("final_prediction").groupBy("symbol_category").agg(F.count("*").alias("count"))


def score_stats(found: DataFrame) -> DataFrame:
    """Mean, population deviation, least and greatest score of scored candidates; zeros if there are none."""
    s = F.col("bert_score")
    aggs = {"mean": F.avg(s), "std": F.stddev_pop(s), "min": F.min(s), "max": F.max(s)}
    return found.where(F.col("method_used").isin(*SOFT) & (s > 0)).agg(F.count("*").alias("count"), *[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in aggs.items()])


def detection_summary(found: DataFrame) -> DataFrame:
    total, positive = F.count("*"), F.count_if("final_prediction")
    return found.agg(total.alias("total_lines"), positive.alias("positive"), F.try_divide(positive, total).alias("positive_ratio"), F.count_if(F.col("method_used") == "ultra_strict_pua").alias("ultra_strict"))


def ultra_by_category(markers: DataFrame) -> DataFrame:
    return markers.groupBy("doc_id", "category").agg(F.count("*").alias("count"), F.array_sort(F.collect_list(F.struct("line_number", "symbol"))).alias("members"))


def ultra_by_pua_group(markers: DataFrame) -> DataFrame:
    return markers.where("is_pua").groupBy("category").agg(F.count("*").alias("count"))


def ultra_by_code(markers: DataFrame) -> DataFrame:
    return markers.groupBy("unicode_code").agg(F.count("*").alias("count"), F.count_if("has_proper_newline").alias("compliant"))


def ultra_by_level(markers: DataFrame) -> DataFrame:
    """Markers per document and level, levels by first appearance of their category."""
    first = markers.groupBy("doc_id", "category").agg(F.min("line_number").alias("first_line"), F.count("*").alias("n"))
    level = F.dense_rank().over(Window.partitionBy("doc_id").orderBy("first_line"))
    return first.select("doc_id", level.cast("long").alias("level"), F.col("n").alias("count"))


def file_stats(found: DataFrame) -> DataFrame:
    """Counts per document, as a batch run reports them. rule_only includes the strict markers."""
    rule, bert, yes = F.col("rule_based_score"), F.col("bert_score"), F.col("final_prediction")
    return found.groupBy("doc_id").agg(
        F.count("*").alias("total_lines"),
        F.count_if(yes).alias("total_markers"),
        F.count_if(F.col("method_used") == "ultra_strict_pua").alias("ultra_strict_markers"),
        F.count_if(yes & (F.col("method_used") == "soft_rule_bert")).alias("bert_refined_markers"),
        F.count_if(yes & (F.col("method_used") != "soft_rule_bert")).alias("rule_only_markers"),
        F.count_if(rule > 0).alias("candidates"),
        F.count_if((bert > 0) & (bert < 1)).alias("bert_processed"),
    )


def batch_totals(files: DataFrame) -> DataFrame:
    """Sums over all documents, with the rates of candidates and markers."""
    names = [c for c in files.columns if c != "doc_id"]
    sums = files.agg(F.count("*").alias("files"), *[F.sum(c).cast("long").alias(c) for c in names])
    return sums.withColumns({"candidate_rate": F.try_divide("candidates", "total_lines"), "marker_rate": F.try_divide("total_markers", "candidates")})


def marker_projection(found: DataFrame) -> DataFrame:
    """Positive detections with their code point."""
    return found.where("final_prediction").select("doc_id", "line_number", S.code_name(F.col("detected_symbol")).alias("unicode_code"), "symbol_category", "rule_based_score", "bert_score", S.is_pua(F.col("detected_symbol")).alias("is_pua"))
