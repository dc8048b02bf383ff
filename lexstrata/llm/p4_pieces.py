"""Problem 4: cutting items over a size limit at natural boundaries, with an overlap.

Method: a text becomes tokens, and prefix sums of their sizes give each token its offset. The offsets behind tokens that
end a line, a sentence or a clause are the sorted boundary arrays. A binary search finds the last boundary under the
limit, the next piece begins the overlap before it, and where there is no boundary, a hard cut falls behind the last
token that fits: a word, a line break or a character with its combining marks stays whole if it isn't itself too long.

Items at or under the limit are one piece and never leave the JVM. A piece, its overlap included, has at most
``limit`` characters (code points), and piece k begins with the last ``overlap`` characters of piece k - 1. Line ends
are taken before sentence ends, and these before clause ends, if the piece then holds at least half the limit;
otherwise the last boundary of any kind. Null and empty items give one row whose piece is the item itself.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import code_points, read

LIMIT, OVERLAP = 512, 64
PIECES = "item_table string, field_name string, row_id long, piece int, start int, size int, text string"
# A token: an end of a line, of a sentence or of a clause (closing quotes and brackets stay with what they close), a
# word of letters and digits, or a character with its combining marks.
LINE, SENTENCE, CLAUSE, OTHER, CLOSE, WORD, MARK, STOP, BLANK = range(1, 10)
_KINDS = {LINE: "\n\r\x0b\x0c\x85\u2028\u2029", SENTENCE: "。！？!?…", CLAUSE: "；;，,、：:", CLOSE: "」』”’）)]", STOP: "."}


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The kind of each character of the basic plane."""
    table = np.full(65536, OTHER, np.uint8)
    for cp in range(65536):
        ch = chr(cp)
        table[cp] = MARK if unicodedata.combining(ch) or 0xFE00 <= cp <= 0xFE0F else WORD if ch.isascii() and (ch.isalnum() or ch == "_") else BLANK if ch.isspace() else OTHER
    for kind, chars in _KINDS.items():
        table[[ord(c) for c in chars]] = kind
    return table


def offsets(text: str) -> tuple[list[int], list[list[int]]]:
    """The offset behind each token, and those behind the ends of lines, of sentences and of clauses, sorted; a weaker kind
    includes the stronger ones."""
    cps = code_points(text)
    kind = _classes()[np.minimum(cps, 0xFFFF)]
    after = np.concatenate([kind[1:], [OTHER]]).astype(np.uint8)
    # A full stop ends a sentence before white space only.
    stop = (kind == STOP) & np.isin(after, (BLANK, LINE)) & (np.arange(cps.size) < cps.size - 1)
    # What the closing marks close.
    at = np.maximum.accumulate(np.where(kind == CLOSE, 0, np.arange(cps.size)))
    base = np.where(stop, SENTENCE, kind)[at]
    base[np.isin(base, (CLOSE, STOP, WORD, MARK, BLANK)) | (kind == CLOSE) & (base == LINE)] = OTHER
    glued = (after == MARK) & (kind != LINE)
    glued |= (kind == after) & np.isin(kind, (SENTENCE, CLAUSE, WORD))
    glued |= (after == CLOSE) & np.isin(base, (SENTENCE, CLAUSE))
    glued[:-1] |= (cps[:-1] == 13) & (cps[1:] == 10)
    glued[-1] = False
    last = np.flatnonzero(~glued)
    sizes = np.diff(last, prepend=-1)
    ends = np.cumsum(sizes)  # prefix sums of the tokens' sizes
    return ends.tolist(), [ends[base[last] <= k].tolist() for k in (LINE, SENTENCE, CLAUSE)]


def _last(sorted_offsets: list[int], top: int, least: int) -> int:
    """The last offset up to top that is least or more, or 0."""
    at = bisect_right(sorted_offsets, top) - 1
    return sorted_offsets[at] if at >= 0 and sorted_offsets[at] >= least else 0


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of each piece of text."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    size = len(text)
    if size <= limit:
        return [(0, size)]
    ends, kinds = offsets(text)
    out, start = [], 0
    while size - start > limit:
        top, least = start + limit, start + overlap + 1
        half = max(start + limit // 2, least)
        tries = [*((kind, half) for kind in kinds), *((kind, least) for kind in kinds), (ends, least)]
        end = next((e for sorted_offsets, low in tries if (e := _last(sorted_offsets, top, low))), top)
        while end == top > least and unicodedata.combining(text[end]):  # a word longer than the limit
            end = top = top - 1
        out.append((start, end))
        start = end - overlap
    return [*out, (start, size)]


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_table, field_name, row_id, text of the three kinds of items."""
    rag, lines = read(spark, sf_dir, "rag_chunks"), read(spark, sf_dir, "line_chunks")
    fields = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in ("content", "full_text")])
    rag = rag.select(F.lit("rag_chunks").alias("item_table"), "row_id", F.explode(fields).alias("f")).select("item_table", "f.field_name", "row_id", "f.text")
    # Null elements stand for empty lines, so that no line's place is lost.
    joined = F.when(F.col("content_lines").isNotNull(), F.array_join("content_lines", "\n", ""))
    lines = lines.select(F.lit("line_chunks").alias("item_table"), F.lit("content_lines").alias("field_name"), "row_id", joined.alias("text"))
    return rag.unionByName(lines)


def pieces(items: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row for each piece of each item."""

    def cut_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for table, field, row_id, text in zip(pdf["item_table"], pdf["field_name"], pdf["row_id"], pdf["text"]):
                rows += [(table, field, row_id, k, a, b - a, text[a:b]) for k, (a, b) in enumerate(cut(text, limit, overlap))]
            yield pd.DataFrame(rows, columns=["item_table", "field_name", "row_id", "piece", "start", "size", "text"])

    long = F.coalesce(F.length("text") > limit, F.lit(False))
    short = items.where(~long).select("item_table", "field_name", F.col("row_id").cast("long"), F.lit(0).alias("piece"), F.lit(0).alias("start"), F.coalesce(F.length("text"), F.lit(0)).alias("size"), "text")
    return short.unionByName(items.where(long).mapInPandas(cut_batches, PIECES))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items longer than the limit: those that were cut, each by its second piece."""
    return pieces(items(spark, sf_dir)).where("piece = 1").select("item_table", "field_name", "row_id")


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all items."""
    return pieces(items(spark, sf_dir))
