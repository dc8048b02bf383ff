"""Problem 1: records that differ only in white space, case, punctuation or the order of their fields.

Method: recursive radix partitioning on canonical bytes, then counting in a trie per bucket.

* Canonical forms (in the JVM): k1 is the cleaned text; k2, for lines made only of ``label：value`` fields, the
  sorted cleaned fields. Two records are the same if they share k1 or k2, transitively.
* The canonical bytes by which records are partitioned are a digest of the sorted characters of k1: equal for all
  members of a group whatever the order of the fields, and evenly spread.
* Every task first merges its own repeats in a trie, in one pass over the tables, and writes each text once with the ids
  that it had there. So a text that holds a third of all rows reaches its bucket as one row a task, and comes back to its
  ids as one row a task.
* Buckets are the leading digest bytes, as many as the number of rows asks for; a bucket that still has over
  ``bucket_rows`` is split by the next byte in its task, again and again. The driver holds one number.
* Within a bucket, a trie with terminal counters over (scope, k1) and one over (scope, k2) meet in a union-find.

Being the same is transitive: a line that has no fields but the cleaned text of one that has is the same as it, and so as
the lines that have its fields in another order.
Nulls, blank texts and texts under ``min_chars`` cleaned characters are in no group. Null doc_id is a scope of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, cleaned, materialize, read

STRIDE = 12
SEPARATOR = "[;；|｜]"
FIELD = rf"(?U)^[^:：]*[^:：{SPACE}][^:：]*[:：]"
PARTIAL = "rec_table string, scope long, k1 string, k2 string, h1 long, h2 long, digest string, kept_id long, n long, ids array<long>"
GROUPS = "rec_table string, h1 long, h2 long, kept_id long, n_copies long"


class CountTrie:
    """A burst trie over byte strings: edges of STRIDE bytes, unbranched tails kept whole in a leaf."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root: dict = {}

    def terminal(self, key: bytes) -> list:
        """The terminal of key, made if it is new: a list whose first item is internal and the rest is the caller's."""
        node, at = self.root, 0
        while True:
            edge = key[at : at + STRIDE]
            at += STRIDE
            slot = node.get(edge)
            if slot is None:
                leaf = [key[at:]]
                node[edge] = leaf
                return leaf
            if type(slot) is dict:
                node = slot
                continue
            tail = slot[0]
            if tail == key[at:]:
                return slot
            slot[0] = tail[STRIDE:]
            child = {tail[:STRIDE]: slot}
            node[edge] = child
            node = child


def canonical(df: DataFrame, rec_table: str, id_col: str, text_col: str, scope_col: str | None, min_chars: int) -> DataFrame:
    """rec_table, id, scope, k1, k2, h1, h2 of the records that can be in a group."""
    text = F.col(text_col)
    parts = F.filter(F.split(text, SEPARATOR), lambda p: F.length(cleaned(p)) > 0)
    is_fields = (F.size(parts) > 1) & F.forall(parts, lambda p: p.rlike(FIELD))
    k2 = F.when(text.rlike(SEPARATOR) & text.rlike("[:：]") & is_fields, F.array_join(F.array_sort(F.transform(parts, cleaned)), "\x1f"))
    scope = F.coalesce(F.col(scope_col).cast("long"), F.lit(-(2**63))) if scope_col else F.lit(0).cast("long")
    out = df.where(F.length(text) >= min_chars).select(
        F.lit(rec_table).alias("rec_table"), F.col(id_col).cast("long").alias("id"), scope.alias("scope"), cleaned(text).alias("k1"), k2.alias("k2")
    )
    out = out.where(F.length("k1") >= min_chars)
    key = [F.col("rec_table"), F.col("scope"), F.col("k1"), F.coalesce(F.col("k2"), F.lit(""))]
    return out.withColumns({"h1": F.xxhash64(*key), "h2": F.xxhash64(F.lit("second"), *reversed(key))})


def _merge_local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge the repeats within a task; flushed at a fixed number of bytes of keys and ids, so memory is bounded."""
    most = 64_000_000
    trie, found, size = CountTrie(), [], 0

    def flush() -> pd.DataFrame:
        rows = []
        for ids, (rec_table, scope, k1, k2, h1, h2) in found:
            digest = xxhash.xxh64_hexdigest("".join(sorted(k1.replace("|", "").replace("｜", ""))), seed=scope & 0xFFFFFFFF)
            rows.append((rec_table, scope, k1, k2, h1, h2, digest, min(ids), len(ids), ids))
        return pd.DataFrame(rows, columns=["rec_table", "scope", "k1", "k2", "h1", "h2", "digest", "kept_id", "n", "ids"])

    for pdf in batches:
        for row in zip(pdf["rec_table"], pdf["id"], pdf["scope"], pdf["k1"], pdf["k2"], pdf["h1"], pdf["h2"]):
            rec_table, rid, scope, k1, k2, h1, h2 = row
            key = f"{rec_table[0]}{scope}\x00{k1}\x00{k2 or ''}".encode("utf-8", "surrogatepass")
            leaf = trie.terminal(key)
            if len(leaf) == 1:
                leaf.append([rid])
                found.append((leaf[1], (rec_table, scope, k1, k2, h1, h2)))
                size += 2 * len(key) + 200
            else:
                leaf[1].append(rid)
                size += 32
            if size >= most:
                yield flush()
                trie, found, size = CountTrie(), [], 0
    if found:
        yield flush()


def _count_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Groups of one bucket: tries over k1 and k2 whose terminals hold a node each, and a union-find over the nodes."""
    firsts, seconds = CountTrie(), CountTrie()
    parent: list[int] = []

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def node(trie: CountTrie, key: str) -> int:
        leaf = trie.terminal(key.encode("utf-8", "surrogatepass"))
        if len(leaf) == 1:
            leaf.append(len(parent))
            parent.append(len(parent))
        return leaf[1]

    nodes = []
    for rec_table, scope, k1, k2 in zip(pdf["rec_table"], pdf["scope"], pdf["k1"], pdf["k2"]):
        a = node(firsts, f"{rec_table}\x00{scope}\x00{k1}")
        if k2 is not None and k2 == k2:
            parent[top(node(seconds, f"{rec_table}\x00{scope}\x00{k2}"))] = top(a)
        nodes.append(a)
    pdf = pdf.assign(group=[top(x) for x in nodes])
    sums = pdf.groupby("group").agg(kept=("kept_id", "min"), n_copies=("n", "sum"))
    pdf = pdf.drop(columns="kept_id").join(sums.rename(columns={"kept": "kept_id"}), on="group")
    return pdf[pdf["n_copies"] > 1][["rec_table", "h1", "h2", "kept_id", "n_copies"]].drop_duplicates()


def _split(pdf: pd.DataFrame, depth: int, bucket_rows: int) -> pd.DataFrame:
    """Count a bucket whose digests share depth bytes; split it by the next byte while it is over bucket_rows."""
    if len(pdf) <= bucket_rows or 2 * depth >= 16:
        return _count_bucket(pdf)
    return pd.concat([_split(part, depth + 1, bucket_rows) for _, part in pdf.groupby(pdf["digest"].str[2 * depth : 2 * depth + 2])])


def merge(records: DataFrame) -> DataFrame:
    """The records, each task's repeats in one row: a table in the shared folder."""
    return materialize(records.mapInPandas(_merge_local, PARTIAL), "p1-merged")


def format_groups(merged: DataFrame, bucket_rows: int = 20_000) -> DataFrame:
    """rec_table, h1, h2, kept_id, n_copies: the texts of all groups of two or more records. merged: of merge."""
    depth = max(0, math.ceil(math.log(max(1, merged.count() / bucket_rows), 256)))
    rows = merged.drop("ids").withColumn("bucket", F.substring("digest", 1, 2 * depth))
    return rows.groupBy("bucket").applyInPandas(lambda pdf: _split(pdf, depth, bucket_rows), GROUPS)


def members(merged: DataFrame, groups: DataFrame) -> DataFrame:
    """rec_table, kept_id, id for each record of each group, kept ones included."""
    on = ["rec_table", "h1", "h2"]
    rows = merged.select(*on, "ids").join(groups.select(*on, "kept_id"), on)
    return rows.select("rec_table", "kept_id", F.explode("ids").alias("id"))


def records(spark: SparkSession, sf_dir: str, min_chars: int = 12) -> DataFrame:
    detections = canonical(read(spark, sf_dir, "detections"), "detections", "detection_id", "line_text", "doc_id", min_chars)
    labelled = canonical(read(spark, sf_dir, "labelled_lines"), "labelled_lines", "line_id", "line_text", None, min_chars)
    return detections.unionByName(labelled)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each copy: the smallest id of its group and its own."""
    merged = merge(records(spark, sf_dir))
    rows = members(merged, materialize(format_groups(merged), "p1-groups"))
    return rows.where("id <> kept_id").select("rec_table", "kept_id", F.col("id").alias("copy_id")).distinct()


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per group, with the number of its copies (itself included)."""
    return format_groups(merge(records(spark, sf_dir))).select("rec_table", "kept_id", "n_copies").distinct()
