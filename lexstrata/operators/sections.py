"""Sections and dates of judgments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

SECTIONS = ["header", "main_text", "facts", "reasons", "facts_and_reasons", "footer"]


def line_label(raw: Column) -> Column:
    """The section that a line opens, or null. A heading is looked for anywhere in the line."""
    bare = X.without_space(raw)
    return (
        F.when(bare.contains("主文"), "main_text")
        .when(bare.rlike(r"^事實[及與和]理由\z"), "facts_and_reasons")
        .when(bare.contains("事實"), "facts")
        .when(bare.contains("理由"), "reasons")
        .when(X.is_roc_date(raw), "footer")
    )


def with_segments(docs: DataFrame, copy_facts: bool) -> DataFrame:
    """Add lines (parted by \\r\\n) and segments: runs of lines of one section, as (section, start, size, pos), where pos is the
    number of lines of that section before. The last label is carried forward, from header on.

    All of it is a projection: a run begins where a label differs from the one before it, so that what is carried forward
    needs neither an exchange of lines nor an order of them. Null texts are left out."""
    rows = docs.where(F.col("jfull").isNotNull()).withColumn("lines", F.split("jfull", "\r\n", -1))
    marks = F.filter(F.transform("lines", lambda x, i: F.struct(line_label(x).alias("section"), i.alias("start"))), lambda m: m["section"].isNotNull())
    head = F.struct(F.lit("header").alias("section"), F.lit(0).alias("start"))
    rows = rows.withColumn("marks", F.concat(F.array(head), marks))
    before = lambda i: F.element_at("marks", i)["section"]
    changes = F.filter("marks", lambda m, i: (i == 0) | (m["section"] != before(F.greatest(i, F.lit(1)))))
    rows = rows.withColumn("marks", changes)
    stop = lambda i: F.coalesce(F.try_element_at("marks", i + 2)["start"], F.size("lines"))
    runs = F.transform("marks", lambda m, i: F.struct(m["section"].alias("section"), m["start"].alias("start"), (stop(i) - m["start"]).alias("size")))
    rows = rows.withColumn("runs", F.filter(runs, lambda r: r["size"] > 0))
    if copy_facts:
        copies = F.transform(F.filter("runs", lambda r: r["section"] == "facts_and_reasons"), lambda r: F.struct(F.lit("facts").alias("section"), r["start"].alias("start"), r["size"].alias("size")))
        rows = rows.withColumn("runs", F.when(F.exists("runs", lambda r: r["section"] == "facts"), F.col("runs")).otherwise(F.concat("runs", copies)))
    earlier = lambda r: F.aggregate(F.filter("runs", lambda x: (x["section"] == r["section"]) & (x["start"] < r["start"])), F.lit(0), lambda n, x: n + x["size"])
    return rows.withColumn("segments", F.transform("runs", lambda r: F.struct(r["section"].alias("section"), r["start"].alias("start"), r["size"].alias("size"), earlier(r).alias("pos")))).drop("marks", "runs")


def split_sections(docs: DataFrame, copy_facts: bool = True) -> DataFrame:
    """doc_id, section, pos (from 0), line.

    copy_facts: where a document has facts_and_reasons and no facts, its lines also stand under facts."""
    # Outer, though nothing is ever empty: for an inner one Spark adds a filter on the size, computed anew below all of this.
    rows = with_segments(docs, copy_facts).select("doc_id", "lines", F.explode_outer("segments").alias("s"))
    rows = rows.select("doc_id", "s.section", F.col("s.pos").alias("first"), F.posexplode_outer(F.slice("lines", F.col("s.start") + 1, F.col("s.size"))).alias("i", "line"))
    return rows.select("doc_id", "section", (F.col("first") + F.col("i")).cast("long").alias("pos"), "line")


def sections_by_document(docs: DataFrame) -> DataFrame:
    """doc_id, sections: for each section of the document the array of its lines, as a map. A projection."""
    rows = with_segments(docs, True)
    lines_of = lambda s: F.flatten(F.transform(F.filter("segments", lambda r: r["section"] == s), lambda r: F.slice("lines", r["start"] + 1, r["size"])))
    entries = F.filter(F.array(*[F.struct(F.lit(s).alias("key"), lines_of(s).alias("value")) for s in SECTIONS]), lambda e: F.size(e["value"]) > 0)
    return rows.select("doc_id", F.map_from_entries(entries).alias("sections"))


def section_sizes(segments: Column) -> list[Column]:
    """The number of lines of each section (n_header and so on)."""
    size = lambda s: F.aggregate(F.filter(segments, lambda r: r["section"] == s), F.lit(0).cast("long"), lambda n, r: n + r["size"])
    return [size(s).alias(f"n_{s}") for s in SECTIONS]


def section_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the number of lines of each section (n_header and so on)."""
    return with_segments(docs, True).select("doc_id", *section_sizes(F.col("segments")))


def date_lines(docs: DataFrame) -> DataFrame:
    """doc_id, idx0, raw of the lines that dates are looked for in: by \\r\\n if the text has one, else by \\n."""
    pattern = F.when(F.col("jfull").contains("\r\n"), F.lit("\r\n")).otherwise(F.lit("\n"))
    docs = docs.where(F.col("jfull").isNotNull())
    return docs.select("doc_id", F.posexplode_outer(F.split("jfull", pattern, -1)).alias("idx0", "raw")).withColumn("idx0", F.col("idx0").cast("long"))


_SHORT = r"(?U)民國(\d+)年(\d+)月(\d+)日"


def _tries(raw: Column) -> list[tuple[Column, str]]:
    """What is tried on a line, in order: the spaced form, the short one, then both without spaces and U+200B."""
    bare = X.without_space(F.regexp_replace(raw, "\u200b", ""))
    return [(raw, X.ROC_DATE), (raw, _SHORT), (bare, X.ROC_DATE), (bare, _SHORT)]


def _may_be_date(raw: Column) -> Column:
    out = raw.contains("中")
    for c in "華民國年月日":
        out = out & raw.contains(c)
    return out


def date_count(jfull: Column) -> Column:
    """How many lines of a text have a date: the number of rows of extract_dates."""
    pattern = F.when(jfull.contains("\r\n"), F.lit("\r\n")).otherwise(F.lit("\n"))
    dated = F.filter(F.filter(F.split(jfull, pattern, -1), _may_be_date), lambda x: _any(c.rlike(p) for c, p in _tries(x)))
    return F.size(dated).cast("long")


def _any(flags) -> Column:
    out = F.lit(False)
    for f in flags:
        out = out | f
    return out


def extract_dates(docs: DataFrame) -> DataFrame:
    """doc_id, idx0, year, month, day, full_match, original_line, cleaned_line: one date a line at most.

    The spaced form is tried on the line, then the short form; then both on the line without spaces and U+200B."""
    lines = date_lines(docs).where(_may_be_date(F.col("raw")))
    cleaned = X.without_space(F.regexp_replace("raw", "\u200b", ""))
    lines = lines.withColumn("cleaned_line", cleaned)
    tries = [("raw", X.ROC_DATE), ("raw", _SHORT), ("cleaned_line", X.ROC_DATE), ("cleaned_line", _SHORT)]
    found = F.lit(None).cast("array<string>")
    for column, pattern in reversed(tries):
        groups = F.array(*[F.regexp_extract(column, pattern, k) for k in (1, 2, 3)])
        found = F.when(F.col(column).rlike(pattern), groups).otherwise(found)
    lines = lines.withColumn("d", found).where("d IS NOT NULL")
    year, month, day = (F.col("d")[k] for k in range(3))
    full = F.concat(F.lit("中華民國"), year, F.lit("年"), month, F.lit("月"), day, F.lit("日"))
    return lines.select("doc_id", "idx0", year.alias("year"), month.alias("month"), day.alias("day"), full.alias("full_match"), F.col("raw").alias("original_line"), "cleaned_line")
