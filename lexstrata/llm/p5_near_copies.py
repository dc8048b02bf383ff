"""Problem 5: records that share most of their content but differ by small edits, insertions or moved lines.

Method: odd sketches. Each text (white space removed) is the set of its 5-character windows, sampled by k MinHash values;
the bands of these values find candidates, and the values are also folded into a parity bitmap. The population count of
the XOR of two bitmaps estimates a high similarity precisely and drops most candidates; the exact Jaccard similarity
decides the rest.

* Identical texts are one class, and only a class's first text is banded and compared.
* The k values come from one pass that fills k bins, in rounds until every bin has a value: about windows + k log k
  steps a text, unbiased for short and long texts alike.
* Bands of ``rows`` values find a pair of similarity 0.6 with probability 1 - (1 - 0.6 ** 4) ** 64 = 0.99986, and the
  bitmaps keep it with 0.99999: at least 0.9998 together.
* Band buckets over ``hot_rows`` are cut in blocks that meet pairwise in different tasks. Texts are read again only for
  the pairs that the bitmaps leave over.

Null and blank texts have no partner. Texts under 5 characters are compared for identity only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, code_points, materialize, mix64, not_blank, read, window_hashes

WIDTH, THRESHOLD = 5, 0.6
K, ROWS, BITS = 256, 4, 512
BLANKS = rf"(?U)[{SPACE}]+"
_ROUND = 0xA0761D6478BD642F


def windows(text: str, width: int = WIDTH) -> np.ndarray:
    """Hashes of the set of windows, sorted."""
    return np.unique(window_hashes(code_points(text), width))


def minhash(items: np.ndarray, k: int = K) -> np.ndarray:
    """k MinHash values of a set of hashes: bins filled by the least value of the first round that reaches them."""
    out = np.zeros(k, np.uint64)
    empty = np.ones(k, bool)
    shift = np.uint64(64 - int(math.log2(k)))
    for r in range(2 * k):
        h = mix64(items + np.uint64((r + 1) * _ROUND % 2**64))
        if r < k:
            h.sort()
            bins = (h >> shift).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
            at, least = bins[first], h[first]
            new = empty[at]
            out[at[new]], empty[at[new]] = least[new], False
        elif empty[r - k]:
            out[r - k], empty[r - k] = h.min(), False
        if not empty.any():
            break
    return out


def bands(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key a band, different for equal values in different bands."""
    table = values.reshape(-1, rows)
    key = np.arange(table.shape[0], dtype=np.uint64)
    for c in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + table[:, c])
    return key.astype(np.int64)


def odd_sketch(values: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The parity bitmap of (bin, value), in 64-bit words."""
    h = mix64(values + np.arange(values.size, dtype=np.uint64) * np.uint64(_ROUND)) % np.uint64(bits)
    odd = np.bincount(h.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def estimate(xor_count: int, k: int = K, bits: int = BITS) -> float:
    """Similarity by the number of differing bits."""
    return 1 + bits / (4 * k) * math.log(max(1e-9, 1 - 2 * xor_count / bits))


def sketches(texts: DataFrame) -> DataFrame:
    """id, h1, h2 (of the text), keys (of the bands), odd (the bitmap). texts: id, text without white space."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rid, text in zip(pdf["id"], pdf["text"]):
                h = xxhash.xxh3_128_intdigest(text.encode("utf-8", "surrogatepass"))
                w = windows(text)
                values = minhash(w) if w.size else None
                keys, odd = ([], []) if values is None else (bands(values), odd_sketch(values))
                rows.append((rid, (h >> 64) - 2**63, (h & (2**64 - 1)) - 2**63, keys, odd))
            yield pd.DataFrame(rows, columns=["id", "h1", "h2", "keys", "odd"])

    return texts.mapInPandas(sketch, "id long, h1 long, h2 long, keys array<long>, odd array<long>")


def most_apart(least: float, k: int = K, bits: int = BITS) -> int:
    """The largest XOR count of two bitmaps that estimates a similarity of least or more."""
    return math.floor(bits / 2 * (1 - math.exp((least - 1) * 4 * k / bits)))


def candidates(first: DataFrame, least: float, hot_rows: int = 5_000) -> DataFrame:
    """a, b (a < b) that share a band and whose bitmaps estimate least or more. first: id, keys, odd."""
    rows = first.select("id", F.explode("keys").alias("key"))
    # In a bucket over hot_rows, rows get a block each, and meet the rows of every block in another task.
    big = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(big.select("key", F.ceil(F.col("n") / hot_rows).cast("int").alias("blocks")), "key")
    own = F.pmod(F.hash("id"), F.col("blocks"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    a = rows.select("key", F.col("id").alias("a"), own.alias("x"), every.alias("y"))
    b = rows.select("key", F.col("id").alias("b"), own.alias("y"), every.alias("x"))
    pairs = a.join(b, ["key", "x", "y"]).where("a < b").select("a", "b").distinct()
    odd = first.select("id", "odd")
    pairs = pairs.join(odd.toDF("a", "odd_a"), "a").join(odd.toDF("b", "odd_b"), "b")
    apart = F.aggregate(F.zip_with("odd_a", "odd_b", lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int")), F.lit(0), lambda s, x: s + x)
    return pairs.where(apart <= most_apart(least)).select("a", "b")


@F.pandas_udf(T.DoubleType())
def _jaccard(left: pd.Series, right: pd.Series) -> pd.Series:
    seen: dict[str, np.ndarray] = {}

    def get(text: str) -> np.ndarray:
        if text not in seen:
            if len(seen) > 64:
                seen.clear()
            seen[text] = windows(text)
        return seen[text]

    out = []
    for a, b in zip(left, right):
        x, y = get(a), get(b)
        both = np.intersect1d(x, y, assume_unique=True).size
        out.append(both / max(1, x.size + y.size - both))
    return pd.Series(out, dtype="float64")


def near_copies(texts: DataFrame, t: float = THRESHOLD, margin: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """Classes (id, cid: the smallest id with the same text) and links between classes (a, b, jaccard).

    texts: id, text without white space. margin: how far under t an estimate may be; over 4 standard deviations of the
    XOR count, those of parity and of MinHash taken together."""
    texts = texts.select("id", "text")
    rows = materialize(sketches(texts), "p5-sketches")
    least = rows.groupBy("h1", "h2").agg(F.min("id").alias("cid"))
    classes = materialize(rows.select("id", "h1", "h2").join(least, ["h1", "h2"]).select("id", "cid"), "p5-classes")
    first = rows.join(least.select(F.col("cid").alias("id")), "id", "left_semi")
    pairs = materialize(candidates(first, t - margin), "p5-candidates")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = texts.join(needed, "id", "left_semi")
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    links = both.select("a", "b", _jaccard("text_a", "text_b").alias("jaccard")).where(F.col("jaccard") >= t)
    return classes, materialize(links, "p5-links")


def components(nodes: DataFrame, edges: DataFrame, name: str = "p5") -> DataFrame:
    """id, group_id (the smallest id that it is linked with, over any number of links).

    nodes: id; edges: a, b. Large-star and small-star rounds, each a table in the shared folder; no task sees more than
    one node's links as rows, and nothing but a count reaches the driver."""
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, f"{name}-edges")
    before = None
    while True:
        # Large star: the larger neighbours of a node are linked with its smallest neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: the smaller neighbours of a node, and itself, are linked with the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(small, f"{name}-edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.groupBy("u").agg(F.min("v").alias("group_id"))
    return nodes.join(roots.withColumnRenamed("u", "id"), "id", "left").select("id", F.coalesce("group_id", "id").alias("group_id"))


def judgment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "judgments").where(not_blank(F.col("jfull")))
    return rows.select(F.col("doc_id").cast("long").alias("id"), F.regexp_replace("jfull", BLANKS, "").alias("text"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of judgments with a similarity of THRESHOLD or more, identical ones included."""
    classes, links = near_copies(judgment_texts(spark, sf_dir))
    x, y = classes.toDF("x", "a"), classes.toDF("y", "b")
    across = links.select("a", "b").join(x, "a").join(y, "b").select("x", "y")
    within = x.join(classes.toDF("y", "a"), "a").where("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each judgment that isn't blank, with its class, its group and its class's number of links."""
    classes, links = near_copies(judgment_texts(spark, sf_dir))
    groups = components(classes.select(F.col("cid").alias("id")).distinct(), links)
    degree = links.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("n_links"))
    rows = classes.join(groups.toDF("cid", "group_id"), "cid").join(degree, "cid", "left")
    return rows.select(F.col("id").alias("doc_id"), F.col("cid").alias("class_id"), "group_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
