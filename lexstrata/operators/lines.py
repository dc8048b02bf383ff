"""Documents to lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


# Windows need a session, and are therefore made when they are used.
def by_doc() -> WindowSpec:
    return Window.partitionBy("doc_id")


def in_order() -> WindowSpec:
    return by_doc().orderBy("idx0")


def running() -> WindowSpec:
    """All lines so far."""
    return in_order().rowsBetween(Window.unboundedPreceding, 0)


def split_lines(docs: DataFrame, pattern: str) -> DataFrame:
    """doc_id, idx0 (from 0), raw. Null texts have no lines, an empty text has one empty line."""
    # Outer, though no text has no lines: for an inner one Spark would split once more for a filter on the size.
    parts = F.posexplode_outer(F.split("jfull", pattern, -1))
    return docs.where(F.col("jfull").isNotNull()).select("doc_id", parts.alias("idx0", "raw")).withColumn("idx0", F.col("idx0").cast("long"))


def crlf_lines(docs: DataFrame) -> DataFrame:
    r"""Lines parted by \r\n only: what the section machine reads."""
    return split_lines(docs, "\r\n")


def lf_lines(docs: DataFrame) -> DataFrame:
    r"""Lines parted by \n, a residual \r kept: what detection and chunking read."""
    return split_lines(docs, "\n")


def first_where(flag: Column) -> Column:
    """The first line of the document with flag."""
    return F.min(F.when(flag, F.col("idx0"))).over(by_doc())


def last_where(flag: Column) -> Column:
    return F.max(F.when(flag, F.col("idx0"))).over(by_doc())


def lines_with_before(docs: DataFrame) -> DataFrame:
    r"""doc_id, idx0, raw and proper: whether the line before ends with \r, or there is none. Each line is zipped with what
    the one before it has, so that no order of lines is needed."""
    rows = docs.where(F.col("jfull").isNotNull()).select("doc_id", F.split("jfull", "\n", -1).alias("raw"))
    proper = F.transform("raw", lambda x, i: (i == 0) | F.element_at("raw", F.greatest(i, F.lit(1))).endswith("\r"))
    rows = rows.select("doc_id", F.posexplode_outer(F.arrays_zip("raw", proper.alias("proper"))).alias("idx0", "x"))
    return rows.select("doc_id", F.col("idx0").cast("long").alias("idx0"), "x.raw", "x.proper")
