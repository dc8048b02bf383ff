"""Text functions that follow Unicode where Spark's own are ASCII."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U)\s and U+001C to U+001F together are the white space that str.strip and \s know in Python.
WS = r"\s\x1c-\x1f"
# (?U): Unicode digits and white space; (?d): only \n ends a line, so that . matches \r.
ROC_DATE = r"(?U)中\s*華\s*民\s*國\s*(\d+)\s*年\s*(\d+)\s*月\s*(\d+)\s*日"


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, rf"(?U)^[{WS}]+|[{WS}]+\z", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)[{WS}]+\z", "")


def without_space(c: Column) -> Column:
    """Without any Unicode white space."""
    return F.regexp_replace(c, rf"(?U)[{WS}]+", "")


def without_blanks(c: Column) -> Column:
    """Without spaces, ideographic spaces and tabs only."""
    return F.translate(c, " 　\t", "")


def without_breaks(c: Column) -> Column:
    return F.translate(c, "\r\n", "")


def breaks_to_newline(c: Column) -> Column:
    r"""\r\n and \r as \n."""
    return F.regexp_replace(c, "\r\n?", "\n")


def is_roc_date(c: Column) -> Column:
    """Whether a full date of the Republic-of-China calendar stands in the line."""
    return c.rlike(ROC_DATE)


def shorten(c: Column, size: int = 50, always: bool = False) -> Column:
    """The first size characters and an ellipsis; only if the text is longer, unless always."""
    cut = F.concat(F.left(c, F.lit(size)), F.lit("..."))
    return cut if always else F.when(F.length(c) > size, cut).otherwise(c)


def upper_median(values: Column) -> Column:
    """The upper middle of an array of values; null if it is empty."""
    return F.try_element_at(F.sort_array(values), F.floor(F.size(values) / 2).cast("int") + 1)
