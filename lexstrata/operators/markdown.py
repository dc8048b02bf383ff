"""Line chunks as Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.symbols import MAX_LEVELS
from .rag import in_order, up_to



def sanitize_lines(lines: Column) -> Column:
    """Stripped lines, without empty ones."""
    return F.filter(F.transform(lines, X.strip), lambda x: x != "")


def is_appendix(text: Column) -> Column:
    """A text of at most 100 characters that begins with a word for appendix, white space aside."""
    t = X.strip(text)
    return (F.length(t) <= 100) & X.without_space(t).rlike("^附[錄件圖表]")


def is_appendix_header(text: Column, in_footer: Column) -> Column:
    """An appendix heading by itself; of a table, with nothing but a number behind it."""
    return in_footer & X.strip(text).rlike(r"(?U)^(?:附[錄件圖]|附表[一二三四五六七八九十\d]*\z)")


def is_section_title(text: Column) -> Column:
    """A text of at most 20 characters that is the name of a section, white space aside."""
    t = X.strip(text)
    return (F.length(t) <= 20) & X.without_space(t).isin("主文", "事實", "理由", "事實及理由")


def is_date_title(text: Column) -> Column:
    """A text of at most 50 characters that is a date."""
    t = X.strip(text)
    return (F.length(t) <= 50) & t.rlike(r"(?Ud)^(?:中\s*華\s*民\s*國.*\d+.*年.*\d+.*月.*\d+.*日|\d{3,4}\s*年\s*\d{1,2}\s*月\s*\d{1,2}\s*日)\z")


def second_date_position(chunks: DataFrame) -> DataFrame:
    """doc_id, position of the first chunk that is or holds a date, from 0; -1 if there is none."""
    text = F.array_join("content_lines", " ")
    hit = text.rlike(r"(?Ud)中\s*華\s*民\s*國.*年.*月.*日") | (F.col("level") == -2)
    return chunks.groupBy("doc_id").agg(F.coalesce(F.min(F.when(hit, F.col("seq"))), F.lit(-1)).alias("position"))


def between_marks(chunks: DataFrame) -> Column:
    """Whether D1 or D2, in any case, stands in a chunk at most five places away."""
    flag = F.array_join("content_lines", " ").rlike("(?i)D1|D2").cast("int")
    near = [F.max(flag).over(in_order().rowsBetween(a, b)) for a, b in ((-5, -1), (1, 5))]
    return F.coalesce(F.greatest(*near), F.lit(0)) == 1


def chunk_markdown(chunks: DataFrame) -> DataFrame:
    """doc_id, seq, block (null where a chunk leaves nothing): the Markdown of each chunk, an empty line behind it.

    Numbers of a level count from the last heading or smaller level on."""
    level = F.col("level")
    clean = sanitize_lines(F.col("content_lines"))
    raw = F.filter(F.transform("content_lines", lambda x: F.regexp_replace(x, r"\n+\z", "")), lambda x: X.strip(x) != "")
    rows = chunks.withColumns({"clean": clean, "raw_lines": raw})
    rows = rows.withColumn("joined", F.array_join("clean", " "))
    joined = F.col("joined")
    shown = (level != -3) & (F.size("clean") > 0)
    heading = shown & (is_section_title(joined) | is_date_title(joined) | is_appendix(joined))
    rows = rows.withColumns({"heading": heading, "numbered": shown & ~heading & (level >= 1), "near": between_marks(rows)})
    rows = rows.withColumns({"before": F.lag("level").over(in_order()), "after": F.lead("level").over(in_order())})
    # The reset group of a row: headings and numbered rows of a smaller level so far.
    resets = [F.count_if(F.col("heading") | (F.col("numbered") & (level < lv))).over(up_to()) for lv in range(1, MAX_LEVELS + 1)]
    # Judgments have MAX_LEVELS levels at most. Results of other origin may have more: there a row counts in the list of those
    # before it, which is gathered in such documents only.
    deepest = F.max("level").over(Window.partitionBy("doc_id"))
    earlier = F.collect_list(F.when(F.col("deepest") > MAX_LEVELS, F.struct("heading", "numbered", "level"))).over(up_to())
    rows = rows.withColumn("deepest", deepest).withColumn("earlier", earlier)
    deep = F.when(level > MAX_LEVELS, F.size(F.filter("earlier", lambda x: x["heading"] | (x["numbered"] & (x["level"] < level)))))
    group = F.coalesce(*[F.when(level == lv, c) for lv, c in enumerate(resets, 1)], deep, F.lit(0))
    rows = rows.withColumn("reset", group)
    number = F.row_number().over(Window.partitionBy("doc_id", "level", "reset", "numbered").orderBy("seq"))
    rows = rows.withColumn("number", number)
    first, rest = F.col("clean")[0], F.slice("clean", 2, 1_000_000)
    lines_of = lambda *cs: F.concat(*[c if isinstance(c, Column) else F.array(F.lit(c)) for c in cs])
    one = lambda c: F.array(c)
    beside = (F.col("before") == -3) | (F.col("after") == -3)
    keeps_lines = is_appendix(joined) | F.coalesce(beside, F.lit(False))
    block = (
        F.when((level == -3) & (F.size("raw_lines") > 0), lines_of(F.col("raw_lines"), ""))
        .when(~shown, F.lit(None).cast("array<string>"))
        .when(F.col("heading") & is_appendix(joined) & (F.size("clean") > 1), lines_of(one(F.concat(F.lit("## "), first)), "", rest, ""))
        .when(F.col("heading"), lines_of(one(F.concat(F.lit("## "), joined)), ""))
        .when(level == 0, lines_of(one(joined), ""))
        .when(level >= 1, lines_of(one(F.concat(F.repeat(F.lit("    "), (level - 1).cast("int")), F.col("number").cast("string"), F.lit(". "), joined)), ""))
        .when((level == -1) & F.col("near"), F.lit(None).cast("array<string>"))
        .when((level == -1) & keeps_lines, lines_of(F.col("raw_lines"), ""))
        .when(level == -1, lines_of(one(joined), ""))
        .when(level == -2, lines_of(one(F.concat(F.lit("*"), joined, F.lit("*"))), ""))
    )
    return rows.select("doc_id", "seq", block.alias("block"))


def to_markdown(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """doc_id, markdown. files: doc_id, file_name, learning_region. Documents without chunks have no row."""
    blocks = chunk_markdown(chunks).groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("block").isNotNull(), F.struct("seq", "block")))), lambda x: x["block"])).alias("lines"))
    head = F.array(F.concat(F.lit("# "), F.coalesce("file_name", F.lit(""))), F.concat(F.lit("- learning_region: "), "learning_region"), F.lit(""))
    lines = F.transform(F.concat(head, "lines"), X.rstrip)
    text = F.concat(X.strip(F.array_join(lines, "\n")), F.lit("\n"))
    return blocks.join(files, "doc_id").select("doc_id", text.alias("markdown"))
