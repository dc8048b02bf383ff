"""Problem 2: the same or nearly the same lines in the train split and in the others.

Method: weighted cosine join with inverted lists. A line is the unit vector of the set of its 2-character windows. A
Jaccard similarity of t or more means a cosine of 2t / (1 + t) or more, so that the cosine join loses no pair.

* Lines with one cleaned text are one class; classes, not lines, are joined.
* Terms are ordered by rarity in the whole table. Document frequencies, and for each split the largest weight of a
  term, stand in arrays of fixed size, hashed: collisions make a bound looser, never wrong, and the arrays don't grow.
* Only the rare head of a vector is listed, until the norm of the rest, or the rest times the largest weights in the
  other split, is under the cosine: a pair that shares no listed term can't reach it.
* A term with over ``cap`` vectors makes no list of its own: its lists are those of two terms together, the first two
  that a pair shares, and then of three. For that the head is longer by what one or two terms can add to the product.
  So lists stay short however many lines a closed vocabulary is spread over. Lists over ``cap`` of three terms are cut
  in blocks that meet pairwise in different tasks.
* Postings carry size, position and a 128-bit parity signature. Within a list, sorted by size, a vector meets only the
  slice of sizes that its position allows; the XOR of two signatures is a lower bound of the symmetric difference.
* What is left gets its exact dot product, and its exact Jaccard similarity.

All weights of a vector are equal: only with set weights does a cosine follow from the Jaccard similarity asked for.
Null, blank and short lines (under 12 cleaned characters) have no partner; a null split belongs to neither side.
Repeated lines are one class and come back as lines; a class with very many lines is salted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cleaned, code_points, hot_keys, materialize, mix64, read, salt_map

SLOTS = 1 << 19
NONE = 1 << 30  # the size where no vector has the term
LEVELS = 3
CAP = 5_000
THRESHOLD = 0.7
POSTINGS = "shard long, key long, cid long, side int, size int, pos int, sig1 long, sig2 long"
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def terms_of(text: str) -> np.ndarray:
    """The set of 2-character windows, each as one exact 64-bit number, sorted."""
    cps = code_points(text).astype(np.int64)
    return np.unique((cps[:-1] << 21) | cps[1:])


def _slots(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys) & np.uint64(SLOTS - 1)).astype(np.int64)


def batch_terms(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all texts (each of two characters or more), sorted by text and term, and the index of the text of each."""
    cps = code_points("".join(texts)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    inside = owner[1:] == owner[:-1]
    terms, owner = ((cps[:-1] << 21) | cps[1:])[inside], owner[1:][inside]
    order = np.lexsort((terms, owner))
    terms, owner = terms[order], owner[order]
    new = np.ones(terms.size, bool)
    new[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    return terms[new], owner[new]


def with_class_hashes(lines: DataFrame, min_chars: int) -> DataFrame:
    """line_id, split, source, t (in train), text (cleaned), h1 and h2 of it: the lines that can have a partner."""
    rows = lines.where(F.col("split").isNotNull()).select(F.col("line_id").cast("long").alias("line_id"), "split", "source", (F.trim(F.lower("split")) == "train").alias("t"), cleaned(F.col("line_text")).alias("text"))
    return rows.where(F.length("text") >= min_chars).withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("second"), "text")})


def line_classes(lines: DataFrame, min_chars: int) -> DataFrame:
    """cid, text, h1, h2, n, in_train, in_eval: one row for each distinct cleaned text; cid is its smallest line_id."""
    rows = with_class_hashes(lines, min_chars)
    return rows.groupBy("text", "h1", "h2").agg(F.min("line_id").alias("cid"), F.count("*").alias("n"), F.bool_or("t").alias("in_train"), F.bool_or(~F.col("t")).alias("in_eval"))


def _summed(rows: DataFrame, *aggregates) -> pd.DataFrame:
    return rows.groupBy("slot").agg(*aggregates).toPandas()  # at most SLOTS rows


def term_bounds(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Document frequency, and per split the smallest vector size (so the largest weight), of each slot."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(SLOTS, np.int64)
        least = np.full((2, SLOTS), NONE, np.int64)
        for pdf in batches:
            terms, owner = batch_terms(pdf["text"])
            s = _slots(terms)
            size = np.bincount(owner, minlength=len(pdf))[owner]
            df += np.bincount(s, minlength=SLOTS)
            for side, there in ((0, pdf["in_train"]), (1, pdf["in_eval"])):
                on = there.to_numpy(bool)[owner]
                np.minimum.at(least[side], s[on], size[on])
        used = np.flatnonzero(df)
        yield pd.DataFrame({"slot": used, "df": df[used], "m0": least[0, used], "m1": least[1, used]})

    rows = _summed(classes.mapInPandas(count, "slot long, df long, m0 long, m1 long"), F.sum("df"), F.min("m0"), F.min("m1"))
    df = np.zeros(SLOTS, np.int64)
    least = np.full((2, SLOTS), NONE, np.int64)
    at = rows["slot"].to_numpy(np.int64)
    df[at] = rows.iloc[:, 1]
    least[0, at], least[1, at] = rows.iloc[:, 2], rows.iloc[:, 3]
    return df, least


class _Vectors:
    """The vectors of a batch of classes: terms by rarity within each, with what bounds the product of those behind."""

    def __init__(self, texts: pd.Series, df: np.ndarray) -> None:
        terms, owner = batch_terms(texts)
        slots = _slots(terms)
        order = np.lexsort((terms, df[slots], owner))
        self.terms, self.owner, self.slots = terms[order], owner[order], slots[order]
        self.sizes = np.bincount(owner, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.pos = np.arange(self.terms.size) - self.first[self.owner]
        self.n = self.sizes[self.owner]

    def signatures(self) -> list[np.ndarray]:
        """Two words a vector: the parity of its terms by 128 hashed bits."""
        h = mix64(self.terms + np.int64(77))
        ones = np.uint64(1) << (h & np.uint64(63))
        half = (h >> np.uint64(6)) & np.uint64(1) == 1
        return [np.bitwise_xor.reduceat(np.where(x, ones, np.uint64(0)), self.first).astype(np.int64) for x in (half, ~half)]

    def reach(self, least_other: np.ndarray, cosine: float) -> np.ndarray:
        """For each term, the most terms that may stand before it in a key: 0 for one that isn't listed at all, 1 for one
        in the head, up to LEVELS where the head is longer by what the terms before can add."""
        weight = 1 / np.sqrt(np.maximum(least_other[self.slots], 1))
        weight[least_other[self.slots] == NONE] = 0.0
        share = weight / np.sqrt(self.n)
        total = np.add.reduceat(share, self.first)
        before = np.cumsum(share) - share
        rest_dot = total[self.owner] - (before - before[self.first][self.owner])
        rest = np.minimum(np.sqrt((self.n - self.pos) / self.n), rest_dot)
        most = np.maximum.reduceat(share, self.first)[self.owner]
        out = np.zeros(self.terms.size, np.int64)
        for level in range(1, LEVELS + 1):
            out[(rest + (level - 1) * most >= cosine - 1e-9) & (out == 0)] = level
        # The lowest level at which a term is listed; terms without a partner make no key.
        return np.where(weight > 0, out, 0)


def _mixed(keys: np.ndarray, terms: np.ndarray) -> np.ndarray:
    return mix64(keys.view(np.uint64) * _SPREAD + terms.view(np.uint64)).view(np.int64)


def keys_of(v: _Vectors, reach: np.ndarray, on: np.ndarray, counts: list[np.ndarray], cap: int, level: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, owner, position, number of vectors) of the keys of the vectors that are on.

    A key of one term ends there if at most cap vectors have it; otherwise it goes on with each later term, and so on.
    The position is that of the last term less the terms before it. With level, the keys of that many terms only, ended
    or not: those whose vectors are still to be counted."""
    here = on[v.owner] & (reach > 0)
    one = here & (reach == 1)
    if level == 1 or v.terms.size == 0:
        return v.terms[one], v.owner[one], v.pos[one], counts[0][v.slots[one]]
    more = one & (counts[0][v.slots] > cap) if len(counts) > 1 or level else np.zeros_like(one)
    ended = one & ~more
    out = [(v.terms[ended], v.owner[ended], v.pos[ended], counts[0][v.slots[ended]])] if level is None else []
    # What follows a hot term is hot itself. Terms stand by vector and rarity: those behind one end where its vector ends.
    hot = np.flatnonzero(here & (counts[0][v.slots] > cap)) if more.any() else np.empty(0, np.int64)
    stop = np.searchsorted(v.owner[hot], v.owner[hot], "right")
    a = np.flatnonzero(more[hot])
    a, b = _behind(a, a + 1, stop)
    key = _mixed(v.terms[hot[a]], v.terms[hot[b]])
    second = reach[hot[b]] <= 2
    if level == 2:
        key, b = key[second], hot[b[second]]
        return key, v.owner[b], v.pos[b] - 1, np.zeros(key.size, np.int64)
    n = counts[1][_slots(key)] if len(counts) > 1 else np.zeros(key.size, np.int64)
    longer = second & (n > cap) if len(counts) > 2 or level else np.zeros(key.size, bool)
    if level is None:
        at = second & ~longer
        out.append((key[at], v.owner[hot[b[at]]], v.pos[hot[b[at]]] - 1, n[at]))
    x, c = _behind(np.flatnonzero(longer), b[longer] + 1, stop)
    key, c = _mixed(key[x], v.terms[hot[c]]), hot[c]
    out.append((key, v.owner[c], v.pos[c] - 2, counts[2][_slots(key)] if len(counts) > 2 else np.zeros(key.size, np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _behind(of: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of of with each place from its start up to where its vector ends (stop, by place)."""
    times = np.maximum(stop[start - 1] - start, 0)
    at = np.repeat(start, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(of, times), at


def key_counts(classes: DataFrame, bounds, cosine: float, counts, cap: int) -> np.ndarray:
    """How many vectors have each key of one term more than those counted, by slot."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, least = bounds.value
        total = np.zeros(SLOTS, np.int64)
        for pdf in batches:
            v = _Vectors(pdf["text"], df)
            for side, there in ((0, pdf["in_train"]), (1, pdf["in_eval"])):
                key, *_ = keys_of(v, v.reach(least[1 - side], cosine), there.to_numpy(bool), counts.value, cap, len(counts.value) + 1)
                total += np.bincount(_slots(key), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"slot": used, "n": total[used]})

    rows = _summed(classes.mapInPandas(count, "slot long, n long"), F.sum("n"))
    out = np.zeros(SLOTS, np.int64)
    out[rows["slot"].to_numpy(np.int64)] = rows.iloc[:, 1]
    return out


def postings(classes: DataFrame, bounds, cosine: float, counts, cap: int, shards: int) -> DataFrame:
    """The inverted lists, each with the shard that it is met in; hot ones once for each block that they meet."""

    def lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, least = bounds.value
        for pdf in batches:
            v = _Vectors(pdf["text"], df)
            sig1, sig2 = v.signatures()
            cids = pdf["cid"].to_numpy(np.int64)
            for side, there in ((0, pdf["in_train"]), (1, pdf["in_eval"])):
                key, owner, pos, n = keys_of(v, v.reach(least[1 - side], cosine), there.to_numpy(bool), counts.value, cap)
                blocks = -(-n // cap)
                if (blocks > 1).any():
                    # Row and column of the square of blocks: the own block is fixed, the other one is every one.
                    at = np.repeat(np.arange(key.size), np.maximum(blocks, 1))
                    other = np.arange(at.size) - np.concatenate([[0], np.cumsum(np.maximum(blocks, 1))])[:-1][at]
                    key, owner, pos, blocks = key[at], owner[at], pos[at], blocks[at]
                    own = (mix64(cids[owner]) % np.maximum(blocks, 1).astype(np.uint64)).astype(np.int64)
                    square = own * blocks + other if side == 0 else other * blocks + own
                    key = np.where(blocks > 1, _mixed(key, square), key)
                shard = (mix64(key) % np.uint64(shards)).astype(np.int64)
                yield pd.DataFrame({"shard": shard, "key": key, "cid": cids[owner], "side": np.int32(side), "size": v.sizes[owner].astype(np.int32), "pos": pos.astype(np.int32), "sig1": sig1[owner], "sig2": sig2[owner]})

    return classes.mapInPandas(lists, POSTINGS)


def meet(p: pd.DataFrame, t: float, at_once: int = 2_000_000) -> pd.DataFrame:
    """train_cid, eval_cid of the pairs of a shard's postings under one key that size, position and signature leave over.

    A pair is sure to be met at the first key that it shares, before which it shares nothing: so at a position p of n
    terms it shares n - p at most, and needs share * (n + m). That bounds m for each posting by itself."""
    share = t / (1 + t)
    width = np.int64(1) << 22
    key, code = np.unique(p["key"].to_numpy(np.int64), return_inverse=True)
    side, n, pos = p["side"].to_numpy(), p["size"].to_numpy(np.int64), p["pos"].to_numpy(np.int64)
    cid = p["cid"].to_numpy(np.int64)
    sig1, sig2 = (p[c].to_numpy(np.int64).view(np.uint64) for c in ("sig1", "sig2"))
    most = np.floor((n - pos) / share - n + 1e-6).astype(np.int64)  # of the partner's size
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    b = b[np.argsort(code[b] * width + n[b], kind="stable")]
    order = code[b] * width + n[b]
    lo = np.searchsorted(order, code[a] * width + np.ceil(t * n[a] - 1e-6).astype(np.int64), "left")
    hi = np.maximum(lo, np.searchsorted(order, code[a] * width + np.minimum(most[a], width - 1), "right"))
    hi[most[a] < 0] = lo[most[a] < 0]
    ends = np.cumsum(hi - lo)
    found = [np.empty((2, 0), np.int64)]
    i = 0
    while i < a.size:
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + at_once, "right")))
        some = hi[i:j] - lo[i:j]
        x = np.repeat(a[i:j], some)
        y = b[np.arange(x.size) - np.repeat(np.cumsum(some) - some, some) + np.repeat(lo[i:j], some)]
        ok = most[y] >= n[x]
        x, y = x[ok], y[ok]
        both = n[x] + n[y]
        apart = np.bitwise_count(sig1[x] ^ sig1[y]).astype(np.int64) + np.bitwise_count(sig2[x] ^ sig2[y])
        ok = apart <= both - 2 * np.ceil(share * both - 1e-9)
        found.append(np.stack([cid[x[ok]], cid[y[ok]]]))
        i = j
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pd.DataFrame({"train_cid": pairs[0], "eval_cid": pairs[1]}, dtype="int64")


def class_pairs(classes: DataFrame, t: float = THRESHOLD, cap: int = CAP) -> DataFrame:
    """train_cid, eval_cid, cosine, jaccard of different classes, similar by t or more."""
    cosine = 2 * t / (1 + t)
    sc = classes.sparkSession.sparkContext
    df, least = term_bounds(classes)
    bounds = sc.broadcast((df, least))  # arrays of SLOTS numbers, whatever the input; so are the counts
    counts = [df]
    while counts[-1].max(initial=0) > cap and len(counts) < LEVELS:
        counts.append(key_counts(classes, bounds, cosine, sc.broadcast(counts), cap))
    # About a third of a vector's terms are listed: shards of some 100,000 postings, so that memory doesn't grow with the input.
    shards = max(16, int(df.sum()) // 300_000)
    lists = postings(classes, bounds, cosine, sc.broadcast(counts), cap, shards)
    met = lists.groupBy("shard").applyInPandas(lambda pdf: meet(pdf, t), "train_cid long, eval_cid long").where("train_cid <> eval_cid").distinct()
    text = classes.select("cid", "text")
    both = met.join(text.toDF("train_cid", "train_text"), "train_cid").join(text.toDF("eval_cid", "eval_text"), "eval_cid")
    return both.withColumn("s", _exact("train_text", "eval_text")).where((F.col("s.cosine") >= cosine - 1e-9) & (F.col("s.jaccard") >= t)).select("train_cid", "eval_cid", "s.cosine", "s.jaccard")


@F.pandas_udf(T.StructType([T.StructField("cosine", T.DoubleType()), T.StructField("jaccard", T.DoubleType())]))
def _exact(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    rows = []
    for a, b in zip(left, right):
        x, y = terms_of(a), terms_of(b)
        dot = np.intersect1d(x, y, assume_unique=True).size
        rows.append((dot / math.sqrt(x.size * y.size), dot / (x.size + y.size - dot)))
    return pd.DataFrame(rows, columns=["cosine", "jaccard"])


def overlaps(lines: DataFrame, t: float = THRESHOLD, min_chars: int = 12) -> tuple[DataFrame, DataFrame]:
    """The classes, and all pairs of them (also of a class with itself) that have a link between the splits."""
    classes = materialize(line_classes(lines, min_chars), "p2-classes")
    pairs = class_pairs(classes, t).select("train_cid", "eval_cid")
    own = classes.where("in_train AND in_eval").select(F.col("cid").alias("train_cid"), F.col("cid").alias("eval_cid"))
    return classes, materialize(pairs.unionByName(own), "p2-pairs")


def members(lines: DataFrame, classes: DataFrame, hot_rows: int = 200_000, min_chars: int = 12) -> DataFrame:
    """line_id, split, source, t, cid, salt of the lines of the classes. A class over hot_rows lines has several salts (times),
    over which its lines are spread."""
    rows = with_class_hashes(lines, min_chars).drop("text")
    salts = salt_map(classes.sparkSession, hot_keys(classes, "h1", F.col("n"), hot_rows), hot_rows)
    times = F.coalesce(F.element_at(salts, F.col("h1")), F.lit(1)) if salts is not None else F.lit(1)
    rows = rows.withColumns({"times": times, "salt": F.pmod(F.hash("line_id"), times)})
    right = classes.select("h1", "h2", "cid", F.explode(F.sequence(F.lit(0), times - 1)).alias("salt"))
    return rows.join(right, ["h1", "h2", "salt"]).select("line_id", "split", "source", "t", "cid", "times", "salt")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of lines, one in train and one not, with a similarity of THRESHOLD or more."""
    lines = read(spark, sf_dir, "labelled_lines")
    classes, pairs = overlaps(lines)
    # Only classes with a link between the splits are read again.
    ends = pairs.select(F.explode(F.array("train_cid", "eval_cid")).alias("cid")).distinct()
    rows = materialize(members(lines, classes.join(ends, "cid", "left_semi")), "p2-members")
    times = rows.groupBy("cid").agg(F.max("times").alias("times")).where("times > 1")
    for side in ("train", "eval"):
        # A pair meets every salt of its classes, a line has one.
        pairs = pairs.join(F.broadcast(times.select(F.col("cid").alias(f"{side}_cid"), F.col("times").alias("k"))), f"{side}_cid", "left")  # at most 1,000 hot classes
        pairs = pairs.withColumn(f"{side}_salt", F.explode(F.sequence(F.lit(0), F.coalesce("k", F.lit(1)) - 1))).drop("k")
    train = rows.where("t").select(F.col("cid").alias("train_cid"), F.col("salt").alias("train_salt"), F.col("line_id").alias("x"))
    other = rows.where("NOT t").select(F.col("cid").alias("eval_cid"), F.col("salt").alias("eval_salt"), F.col("line_id").alias("y"))
    joined = pairs.join(train, ["train_cid", "train_salt"]).join(other, ["eval_cid", "eval_salt"])
    return joined.select(F.least("x", "y").alias("line_id_a"), F.greatest("x", "y").alias("line_id_b"))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each split but train and each source: its lines, and those that also stand in train."""
    lines = read(spark, sf_dir, "labelled_lines")
    classes, pairs = overlaps(lines)
    hit = classes.join(pairs.select(F.col("eval_cid").alias("cid")).distinct(), "cid", "left_semi")
    overlapping = members(lines, hit).where("NOT t").groupBy("split", "source").agg(F.count("*").alias("n_overlapping"))
    all_ = lines.where("split IS NOT NULL AND trim(lower(split)) <> 'train'").groupBy("split", "source").agg(F.count("*").alias("n_lines"))
    same = F.col("a.split").eqNullSafe(F.col("o.split")) & F.col("a.source").eqNullSafe(F.col("o.source"))
    return all_.alias("a").join(overlapping.alias("o"), same, "left").select("a.split", "a.source", "n_lines", F.coalesce("n_overlapping", F.lit(0)).cast("long").alias("n_overlapping"))
