"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import unicodedata
import uuid
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Java's (?U)\s and Python's str.isspace differ only in U+001C to U+001F.
SPACE = r"\s\x1c-\x1f"
# Paths of the tables of this process.
_written: list[str] = []
NOT_CLEAN = rf"(?U)[\p{{P}}{SPACE}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cleaned(c: Column) -> Column:
    """Without white space and punctuation (Unicode category P), lower-cased; null stays null."""
    return F.lower(F.regexp_replace(c, NOT_CLEAN, ""))


def not_blank(c: Column) -> Column:
    return F.coalesce(c.rlike(rf"(?U)[^{SPACE}]"), F.lit(False))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one in local mode only."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    at = spark.sparkContext._jsc.sc().getCheckpointDir()
    if at.isEmpty():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexstrata-"))
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
    return str(at.get()).rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> int:
    """Delete the tables that materialize wrote in this process; their number. For when no result is read any more."""
    jvm = spark._jvm
    n = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def is_clean_char(ch: str) -> bool:
    return not (ch.isspace() or unicodedata.category(ch)[0] == "P")


@lru_cache(maxsize=1)
def _bmp_tables() -> tuple[np.ndarray, np.ndarray]:
    keep = np.zeros(65536, bool)
    low = np.arange(65536, dtype=np.uint32)
    for cp in range(65536):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        keep[cp] = is_clean_char(ch)
        one = ch.lower()
        if len(one) == 1:
            low[cp] = ord(one)
    return keep, low


def clean_python(s: str) -> str:
    return "".join(filter(is_clean_char, s)).lower()


def code_points(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def clean_points(s: str) -> np.ndarray:
    """Code points of the cleaned text; the same as clean_python, vectorized for the basic plane."""
    cps = code_points(s)
    # U+0130 lowers to two characters, a final sigma by its context, and the tables end with the basic plane.
    if cps.size and (cps.max() > 0xFFFF or (cps == 0x130).any() or (cps == 0x3A3).any()):
        return code_points(clean_python(s))
    keep, low = _bmp_tables()
    return low[cps[keep[cps]]]


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix; a bijection."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_hashes(cps: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of width code points (all in order, repeats included)."""
    n = cps.size - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    wide = cps.astype(np.uint64)
    for k in range(width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + wide[k : k + n] + np.uint64(1)
    return mix64(h)


def hot_keys(df: DataFrame, key: str, weight: Column, floor: int, share: float = 1e-3) -> dict[int, int]:
    """Keys that hold over max(floor, share of all rows) rows, with their rows: at most 1 / share keys."""
    total = df.agg(F.sum(weight).cast("long")).first()[0] or 0
    least = max(floor, int(total * share))
    rows = df.groupBy(key).agg(F.sum(weight).cast("long").alias("n")).where(F.col("n") > least).collect()
    return {r[0]: r[1] for r in rows}


def salt_map(spark: SparkSession, hot: dict[int, int], unit: int) -> Column | None:
    """For each hot key the number of salts, as a literal map; null where nothing is hot."""
    if not hot:
        return None
    return F.create_map(*[x for k, n in hot.items() for x in (F.lit(k), F.lit(min(256, n // unit + 2)))])
