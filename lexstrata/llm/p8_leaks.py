"""Problem 8: passages of evaluation items that stand in training documents.

Method: prefix-filtered set join. A run of RUN characters in common means that a window of RUN characters of the item
stands in the document, with all its shingles of GRAM characters. Full containment needs one shingle a window: the
rarest one over all documents. Only these prefix shingles are joined. The place of one in the item and in the document
aligns the two, and the characters within RUN to the left and right of it are compared for an exact run.

* Items are a table like the documents: nothing of them is collected. Two passes over the documents are made whatever the
  number of items, one for document frequencies and one for the join; documents are never shuffled.
* In both passes a bitmap of the wanted shingles (at most 2 ** MOST_BITS bits) drops nearly all shingles where they are
  read. A full bitmap drops less, but what is joined is exact.
* What the join exchanges are hits, each with its surroundings of at most 2 * RUN + GRAM characters. A shingle may stand
  in a third of all documents: its hits are spread over SALTS tasks.
* Items and documents of under RUN cleaned characters can share no such run. Null and empty ones have none.

Texts are compared cleaned: without white space and punctuation, lower-cased.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _bmp_tables, clean_points, clean_python, code_points, materialize, read, window_hashes

RUN, GRAM = 40, 8
MOST_BITS, SALTS = 28, 8
# What the tables of the basic plane can't clean.
_SPECIAL = re.compile("[İΣ\U00010000-\U0010ffff]")


def _slices(texts: pd.Series, ids: pd.Series, chars: int = 400_000) -> Iterator[tuple[list, list]]:
    some, own, n = [], [], 0
    for rid, text in zip(ids, texts):
        if text is None or len(text) < RUN:
            continue
        some.append(clean_python(text) if _SPECIAL.search(text) else text)
        own.append(rid)
        n += len(text)
        if n >= chars:
            yield own, some
            some, own, n = [], [], 0
    if some:
        yield own, some


def _clean_slice(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cleaned code points of all texts, end to end, and the index of the text of each."""
    cps = code_points("".join(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    keep, low = _bmp_tables()
    basic = np.minimum(cps, 0xFFFF)  # characters beyond the basic plane are clean already
    stay = keep[basic] | (cps > 0xFFFF)
    cps, owner, basic = cps[stay], owner[stay], basic[stay]
    return np.where(cps > 0xFFFF, cps, low[basic]), owner


def _grams(cps: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles that lie in one text, and where they begin."""
    h = window_hashes(cps, GRAM)
    at = np.flatnonzero(owner[: h.size] == owner[GRAM - 1 :]) if h.size else np.empty(0, np.int64)
    return h[at], at


def _text(cps: np.ndarray) -> str:
    return cps.tobytes().decode("utf-32-le", "surrogatepass")


def item_grams(items: DataFrame) -> DataFrame:
    """item_id, row (of the item's text), place, h, before, behind: every shingle of every item (item_id, text), with the
    RUN characters before it and those from its begin on."""

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for item, text in zip(pdf["item_id"], pdf["text"]):
                cps = clean_points(text)
                if cps.size < RUN:
                    continue
                h = window_hashes(cps, GRAM).view(np.int64)
                clean = _text(cps)
                at = range(h.size)
                row = xxhash.xxh64_intdigest(clean.encode("utf-8", "surrogatepass")) - 2**63
                yield pd.DataFrame({"item_id": item, "row": row, "place": np.arange(h.size), "h": h, "before": [clean[max(0, i - RUN) : i] for i in at], "behind": [clean[i : i + RUN + GRAM] for i in at]})

    return items.where(F.length("text") >= RUN).select("item_id", "text").mapInPandas(grams, "item_id long, row long, place long, h long, before string, behind string")


def bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap of the column h, as bytes: two bits a hash among 256 or more a hash, at most 2 ** MOST_BITS in all."""
    n = hashes.count()
    bits = min(MOST_BITS, max(16, math.ceil(math.log2(256 * n + 1))))
    slots = hashes.select(F.explode(F.expr(f"array(h & {(1 << bits) - 1}L, shiftrightunsigned(h, 32) & {(1 << bits) - 1}L)")).alias("slot"))
    bytes_ = slots.groupBy(F.expr("shiftright(slot, 3)").alias("at")).agg(F.expr("bit_or(shiftleft(1, cast(slot & 7L as int)))").alias("bits")).toPandas()  # at most 2 ** MOST_BITS / 8 rows
    out = np.zeros((1 << bits) // 8, np.uint8)
    out[bytes_["at"].to_numpy(np.int64)] = bytes_["bits"].to_numpy(np.uint8)
    return out


def _marked(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The indices of the hashes whose bits are set."""
    mask = np.uint64(bits.size * 8 - 1)
    at = np.arange(h.size)
    for shift in (0, 32):
        slot = ((h[at] >> np.uint64(shift)) & mask).astype(np.int64)
        at = at[((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1) == 1]
    return at


def document_frequencies(docs: DataFrame, bits) -> DataFrame:
    """h, df: in how many documents (id, text) each marked hash stands. Tasks add up what they read, a bounded number at a time."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = bits.value
        kept: list[np.ndarray] = []
        size = 0

        def out() -> pd.DataFrame:
            h, n = np.unique(np.concatenate(kept), return_counts=True)
            return pd.DataFrame({"h": h.view(np.int64), "df": n})

        for pdf in batches:
            for _, texts in _slices(pdf["text"], pdf["id"]):
                cps, owner = _clean_slice(texts)
                h, at = _grams(cps, owner)
                found = _marked(marks, h)
                order = np.lexsort((h[found], owner[at[found]]))
                h, of = h[found][order], owner[at[found]][order]
                new = np.ones(h.size, bool)
                new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
                kept.append(h[new])
                size += h.size
                if size > 2_000_000:
                    yield out()
                    kept, size = [], 0
        if kept:
            yield out()

    return docs.select("id", "text").mapInPandas(count, "h long, df long").groupBy("h").agg(F.sum("df").alias("df"))


def prefixes(grams: DataFrame, df: DataFrame) -> DataFrame:
    """h, item_id, before, behind of the shingles that are the rarest one of a window of RUN characters of their item.

    Shingles that no document has come first, and are left out where a window has one: no document holds that window."""

    def rarest(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        order = np.empty(len(pdf), np.int64)
        order[np.lexsort((pdf["h"], pdf["df"]))] = np.arange(len(pdf))
        windows = np.lib.stride_tricks.sliding_window_view(order, RUN - GRAM + 1)
        chosen = pdf.iloc[np.unique(windows.argmin(axis=1) + np.arange(windows.shape[0]))]
        return chosen[chosen["df"] > 0][["h", "item_id", "before", "behind"]]

    ranked = grams.join(df, "h", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    return ranked.groupBy("item_id", "row").applyInPandas(rarest, "h long, item_id long, before string, behind string")


def hits(docs: DataFrame, bits) -> DataFrame:
    """h, id, before, behind: the marked shingles of the documents."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = bits.value
        for pdf in batches:
            for ids, texts in _slices(pdf["text"], pdf["id"]):
                cps, owner = _clean_slice(texts)
                h, at = _grams(cps, owner)
                found = _marked(marks, h)
                if not found.size:
                    continue
                begin = np.searchsorted(owner, np.arange(len(texts) + 1))
                rows = []
                for k, i in zip(h[found].view(np.int64).tolist(), at[found].tolist()):
                    doc = int(owner[i])
                    low, high = max(int(begin[doc]), i - RUN), min(int(begin[doc + 1]), i + RUN + GRAM)
                    rows.append((k, ids[doc], _text(cps[low:i]), _text(cps[i:high])))
                yield pd.DataFrame(rows, columns=["h", "id", "doc_before", "doc_behind"]).astype({"h": "int64", "id": "int64"})

    return docs.select("id", "text").mapInPandas(find, "h long, id long, doc_before string, doc_behind string")


@F.pandas_udf(T.IntegerType())
def _run(before: pd.Series, behind: pd.Series, doc_before: pd.Series, doc_behind: pd.Series) -> pd.Series:
    """The length of the run of equal characters around two aligned places."""
    same = os.path.commonprefix
    rows = zip(before, behind, doc_before, doc_behind)
    return pd.Series([len(same([a[::-1], c[::-1]])) + len(same([b, d])) for a, b, c, d in rows], dtype="int32")


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """id, item_id: the documents (id, text) that have a run of RUN characters in common with an item (item_id, text)."""
    sc = docs.sparkSession.sparkContext
    grams = materialize(item_grams(items), "p8-grams")
    df = document_frequencies(docs, sc.broadcast(bitmap(grams.select("h").distinct())))
    # A table of its own: Spark broadcasts it if its files are small, and joins by an exchange of both sides if not.
    wanted = materialize(prefixes(grams, df), "p8-prefixes")
    found = hits(docs, sc.broadcast(bitmap(wanted.select("h").distinct()))).withColumn("salt", F.pmod(F.hash("id"), F.lit(SALTS)))
    wanted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = found.join(wanted, ["h", "salt"])
    return both.where(_run("before", "behind", "doc_before", "doc_behind") >= RUN).select("id", "item_id").distinct()


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each item that leaked into it."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("id"), "text")
    items = read(spark, sf_dir, "eval_items").select(F.col("item_id").cast("long").alias("item_id"), F.col("item_text").alias("text"))
    return leaks(docs, items).withColumnRenamed("id", "doc_id")


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item that leaked, with the number of documents it leaked into."""
    items = read(spark, sf_dir, "eval_items").select("item_id", "split", "source")
    counts = p8_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_docs"))
    return items.join(counts, "item_id").select("item_id", "split", "source", "n_docs")
