"""Learning of each document's own levels, and their application to the whole document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .sections import line_label

REGIONS = ("S-D", "R-D", "全文")


def _section_heads(lines: Column, section: Column, most: int = 3) -> Column:
    """The first lines of a section, in order: a fold over the lines that carries the last label on."""
    start = F.struct(section.alias("section"), F.lit("header").alias("at"), F.array().cast("array<string>").alias("heads"))

    def step(s: Column, line: Column) -> Column:
        at = F.coalesce(line["label"], s["at"])
        more = (at == s["section"]) & (F.size(s["heads"]) < most)
        return F.struct(s["section"].alias("section"), at.alias("at"), F.when(more, F.array_append(s["heads"], line["raw"])).otherwise(s["heads"]).alias("heads"))

    return F.aggregate(lines, start, step)["heads"]


def _first_equal(lines: Column, heads: Column) -> Column:
    """The index of the first line that isn't empty and is one of heads. A fold: heads are its start value and so computed
    once, where a lambda that named them would compute them for every line."""
    start = F.struct(heads.alias("heads"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("at"))

    def step(s: Column, line: Column) -> Column:
        hit = s["at"].isNull() & (line != "") & F.array_contains(s["heads"], line)
        return F.struct(s["heads"].alias("heads"), (s["i"] + 1).alias("i"), F.when(hit, s["i"]).otherwise(s["at"]).alias("at"))

    return F.aggregate(lines, start, step)["at"]


def file_structure(docs: DataFrame) -> DataFrame:
    """doc_id, has_* flags, learning_region, learn_start (line index, null for an empty span), total_lines.

    The span runs from the first line that equals one of the region section's first three lines to the end of the
    document; without such a line it is empty, and the region stays. Each document by itself: a projection, and an
    aggregate by doc_id, which needs no shuffle where documents are partitioned by it. The aggregate is a barrier: filters
    on its columns would else be pushed down with all that they are computed from, again for each use."""
    rows = docs.where(F.col("jfull").isNotNull()).select("doc_id", "jfull")
    rows = rows.withColumn("parts", F.transform(F.split("jfull", "\r\n", -1), lambda x: F.struct(x.alias("raw"), line_label(x).alias("label"))))
    has = lambda s: F.exists("parts", lambda x: F.coalesce(x["label"] == s, F.lit(False)))
    rows = rows.withColumns({f"has_{s}": has(s) for s in ("main_text", "facts", "reasons", "facts_and_reasons")})
    # Where the two are combined and facts are missing, facts are their copy.
    rows = rows.withColumn("has_facts", F.col("has_facts") | F.col("has_facts_and_reasons"))
    region = F.when(F.col("has_facts_and_reasons"), "S-D").when(F.col("has_reasons"), "R-D").otherwise("全文")
    wanted = F.when(F.col("has_facts_and_reasons"), "facts_and_reasons").otherwise("reasons")
    heads = F.when(region != "全文", F.transform(_section_heads(F.col("parts"), wanted), X.strip))
    rows = rows.withColumns({"learning_region": region, "heads": heads, "lines": F.split("jfull", "\n", -1)})
    start = F.when(F.col("learning_region") == "全文", 0).otherwise(_first_equal(F.transform("lines", X.strip), F.col("heads")))
    names = [f"has_{s}" for s in ("main_text", "facts", "reasons", "facts_and_reasons")]
    rows = rows.select("doc_id", *names, start.cast("long").alias("learn_start"), F.size("lines").cast("long").alias("total_lines"))
    rows = rows.groupBy("doc_id").agg(*[F.bool_or(c).alias(c) for c in names], F.max("learn_start").alias("learn_start"), F.max("total_lines").alias("total_lines"))
    return rows.select("doc_id", *names, region.alias("learning_region"), "learn_start", "total_lines")


def _first_appearance(rows: DataFrame) -> DataFrame:
    """doc_id, symbol_category, first_line, n, examples of positive detections, and region if they have a region."""
    nth = F.row_number().over(Window.partitionBy("doc_id", "symbol_category").orderBy("line_number"))
    region = [F.first("learning_region").alias("region")] if "learning_region" in rows.columns else []
    rows = rows.withColumn("nth", nth)
    example = F.when(F.col("nth") <= 3, F.struct("line_number", X.shorten(F.col("line_text"), always=True).alias("text")))
    return rows.groupBy("doc_id", "symbol_category").agg(F.min("line_number").alias("first_line"), F.count("*").alias("n"), F.array_sort(F.collect_list(example)).alias("examples"), *region)


def learn_rules(found: DataFrame, structure: DataFrame) -> DataFrame:
    """doc_id, symbol_category, assigned_level, confidence, learning_source, occurrences, examples: levels by first
    appearance in the learning span. A document without markers there has no rules."""
    span = found.where("final_prediction").join(structure.select("doc_id", "learning_region", "learn_start"), "doc_id").where("line_number > learn_start")
    cats = _first_appearance(span.select("doc_id", "symbol_category", "line_number", "line_text", "learning_region"))
    doc = Window.partitionBy("doc_id")
    return cats.select(
        "doc_id", "symbol_category", F.dense_rank().over(doc.orderBy("first_line")).cast("long").alias("assigned_level"), (F.col("n") / F.sum("n").over(doc)).alias("confidence"),
        F.col("region").alias("learning_source"), F.col("n").alias("occurrences"), F.transform("examples", lambda e: e["text"]).alias("examples"),
    )


def rule_maps(rules: DataFrame) -> DataFrame:
    """doc_id, rules: a map from category to level (at most MAX_LEVELS entries). Joined by doc_id alone, so that rows that
    are partitioned by document needn't be shuffled by category too. What is such a table already stays as it is."""
    if "rules" in rules.columns:
        return rules
    entry = F.struct("symbol_category", "assigned_level")
    return rules.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(entry)).alias("rules"))


def level_of(category: Column) -> Column:
    """The learned level of a category, or null. rules: of rule_maps."""
    return F.try_element_at("rules", category)


def category_levels(found: DataFrame, rules: DataFrame) -> DataFrame:
    """doc_id, symbol_category, assigned_level, is_learned, count, examples: learned levels, then the next free ones by
    first appearance for categories that were not learned."""
    cats = _first_appearance(found.where("final_prediction").select("doc_id", "symbol_category", "line_number", "line_text"))
    both = cats.join(rule_maps(rules), "doc_id", "left").withColumn("learned", level_of(F.col("symbol_category")))
    fresh = F.col("learned").isNull()
    top = F.coalesce(F.array_max(F.map_values("rules")), F.lit(0))
    rank = F.sum(fresh.cast("long")).over(Window.partitionBy("doc_id").orderBy("first_line").rowsBetween(Window.unboundedPreceding, 0))
    return both.select("doc_id", "symbol_category", F.coalesce("learned", top + rank).cast("long").alias("assigned_level"), (~fresh).alias("is_learned"), F.col("n").alias("count"), "examples")


def apply_rules(found: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per positive detection with its level and whether it was learned."""
    levels = category_levels(found, rules)
    entry = F.struct("symbol_category", F.struct("assigned_level", "is_learned").alias("v"))
    maps = levels.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(entry)).alias("levels"))
    rows = found.where("final_prediction").join(maps, "doc_id").withColumn("v", F.element_at("levels", F.col("symbol_category")))
    return rows.select("doc_id", "line_number", "detected_symbol", "symbol_category", "v.assigned_level", F.col("v.is_learned").alias("is_learned_rule"), "line_text", "method_used", "bert_score")


def coverage(levels: DataFrame) -> DataFrame:
    """doc_id, rule_coverage (learned categories of all), total_levels, total_symbols. levels: of category_levels."""
    known: Column = F.count_if("is_learned")
    return levels.groupBy("doc_id").agg((known / F.count("*")).alias("rule_coverage"), F.countDistinct("assigned_level").alias("total_levels"), F.sum("count").alias("total_symbols"))
