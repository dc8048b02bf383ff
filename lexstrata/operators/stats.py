"""Statistics of a corpus of judgments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sections import SECTIONS, date_count, extract_dates, section_sizes, with_segments


def file_parts(docs: DataFrame) -> DataFrame:
    """doc_id, court, year, case_type, number, date, version of file names with six parts or more; others have no row."""
    parts = F.split(F.regexp_replace("file_name", r"\.[^.,/]*\z", ""), ",")
    names = ["court", "year", "case_type", "number", "date", "version"]
    return docs.select("doc_id", parts.alias("p")).where(F.size("p") >= 6).select("doc_id", *[F.col("p")[i].alias(c) for i, c in enumerate(names)])


def part_counts(docs: DataFrame) -> DataFrame:
    """kind (year, case_type, court), value, count."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("year", "case_type", "court")])
    return file_parts(docs).select(F.explode(kinds).alias("x")).groupBy("x.kind", "x.value").agg(F.count("*").alias("count"))


def class_symbol(has: dict[str, Column], dates: Column) -> Column:
    """M, S or F, R, and D1 or D2, as the document has them; N if it has none."""
    combined = has["facts_and_reasons"]
    parts = [
        F.when(has["main_text"], "M"),
        F.when(combined, "S").when(has["facts"], "F"),
        F.when(has["reasons"] & ~combined, "R"),
        F.when(dates >= 2, "D2").when(dates == 1, "D1"),
    ]
    joined = F.concat(*[F.coalesce(p, F.lit("")) for p in parts])
    return F.when(joined == "", "N").otherwise(joined)


def doc_stats(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, n_<section>, dates_count, symbol; ERROR for a null text. A projection: nothing is exchanged."""
    names = [f"n_{s}" for s in SECTIONS]
    good = with_segments(docs, True).select("doc_id", F.length("jfull").cast("long").alias("n_chars"), *section_sizes(F.col("segments")), date_count(F.col("jfull")).alias("dates_count"))
    bad = docs.where(F.col("jfull").isNull()).select("doc_id", F.lit(None).cast("long").alias("n_chars"), *[F.lit(None).cast("long").alias(c) for c in names], F.lit(0).cast("long").alias("dates_count"), F.lit("ERROR").alias("symbol"))
    has = {s: F.col(f"n_{s}") > 0 for s in SECTIONS}
    return good.withColumn("symbol", class_symbol(has, F.col("dates_count"))).unionByName(bad)


def section_summary(stats: DataFrame) -> DataFrame:
    """section, present, empty, avg, median (the upper one), min, max of line counts over the documents without error."""
    rows = without_errors(stats).select(F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"n_{s}").alias("n")) for s in SECTIONS])).alias("x")).select("x.*")
    # Few different counts: the median is taken from their histogram, not from a list of all documents.
    hist = rows.groupBy("section", "n").agg(F.count("*").alias("docs"))
    return hist.groupBy("section").agg(
        F.sum(F.when(F.col("n") > 0, F.col("docs")).otherwise(0)).alias("present"), F.sum(F.when(F.col("n") == 0, F.col("docs")).otherwise(0)).alias("empty"),
        (F.sum(F.col("n") * F.col("docs")) / F.sum("docs")).alias("avg"), histogram_median(F.col("n"), F.col("docs")).alias("median"), F.min("n").alias("min"), F.max("n").alias("max"),
    )


def histogram_median(value: Column, count: Column) -> Column:
    """The upper median of values with counts, as an aggregate over distinct values."""
    pairs = F.array_sort(F.collect_list(F.struct(value.cast("long").alias("v"), count.cast("long").alias("c"))))
    half = F.floor(F.aggregate(pairs, F.lit(0).cast("long"), lambda s, p: s + p["c"]) / 2)
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("v"))

    def step(s: Column, p: Column) -> Column:
        seen = s["seen"] + p["c"]
        return F.struct(seen.alias("seen"), F.when(s["v"].isNull() & (seen > half), p["v"]).otherwise(s["v"]).alias("v"))

    return F.aggregate(pairs, start, step)["v"]


def class_counts(stats: DataFrame) -> DataFrame:
    """symbol, count, percent of the documents without error (null for ERROR)."""
    ok = F.count_if(F.col("symbol") != "ERROR")
    totals = stats.agg(ok.alias("ok"))  # one row
    rows = stats.groupBy("symbol").agg(F.count("*").alias("count"))
    return rows.join(F.broadcast(totals), F.col("symbol") != "ERROR", "left").select("symbol", "count", F.try_divide(F.col("count") * 100, F.col("ok")).alias("percent"))


def traditional_class(symbol: Column) -> Column:
    has = symbol.contains
    return (
        F.when(has("S"), "combined")
        .when(has("M") & has("F"), "separated")
        .when(symbol.startswith("R"), "procedural")
        .when(symbol.startswith("M") & ~has("R"), "main_only")
        .when(symbol.startswith("F") & ~has("R"), "facts_only")
        .otherwise("incomplete")
    )


def without_errors(stats: DataFrame) -> DataFrame:
    """The documents with a text. The filter is on n_chars: Spark puts a filter on symbol below the projections, and there
    writes out every expression that the symbol is made of, each as often as it is used."""
    return stats.where("n_chars IS NOT NULL")


def traditional_counts(stats: DataFrame) -> DataFrame:
    return without_errors(stats).groupBy(traditional_class(F.col("symbol")).alias("class")).agg(F.count("*").alias("count"))


def largest_classes(stats: DataFrame, n: int = 3) -> DataFrame:
    """Mean lines of the n largest classes (ties by name)."""
    means = [F.avg(f"n_{s}").alias(f"mean_{s}") for s in ("main_text", "facts", "reasons", "facts_and_reasons")]
    return without_errors(stats).groupBy("symbol").agg(F.count("*").alias("count"), *means).orderBy(F.desc("count"), "symbol").limit(n)


def date_summary(docs: DataFrame) -> DataFrame:
    return extract_dates(docs).agg(F.countDistinct("doc_id").alias("files_with_dates"), F.count("*").alias("total_dates"))


def month_counts(docs: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent months of dates (ties by name)."""
    month = F.concat("year", F.lit("年"), "month", F.lit("月"))
    return extract_dates(docs).groupBy(month.alias("month")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "month").limit(n)


def size_summary(stats: DataFrame) -> DataFrame:
    """Mean, upper median, least and greatest size in characters / 1024."""
    hist = without_errors(stats).groupBy("n_chars").agg(F.count("*").alias("docs"))
    kb = lambda c: c / 1024
    return hist.agg(kb(F.sum(F.col("n_chars") * F.col("docs")) / F.sum("docs")).alias("avg_kb"), kb(histogram_median(F.col("n_chars"), F.col("docs"))).alias("median_kb"), kb(F.min("n_chars")).alias("min_kb"), kb(F.max("n_chars")).alias("max_kb"))


def error_counts(errors: DataFrame) -> DataFrame:
    """kind (the text before the first colon), count. errors: a column error."""
    return errors.where("error IS NOT NULL").groupBy(F.substring_index("error", ":", 1).alias("kind")).agg(F.count("*").alias("count"))


