"""Problem 6: texts that look the same but differ in their characters.

Method: quick-check properties mark the characters that are not in canonical form; only the segments around them, with
the base character before a combining mark, are normalized and spliced back into the unchanged text.

Canonical form: NFC; full- and half-width forms, spaces, radicals, compatibility ideographs and Cyrillic or Greek
letters with the shape of a Latin one become the ordinary character; invisible format characters and variation
selectors go. Letter case, line breaks, tabs and the amount of white space stay, and so do marker symbols such as ㈠ or Ⅰ.
A digit that numbers a line (alone at its start, before 、) is kept full-width, because only so is it a marker symbol.
Null stays null, empty stays empty.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, not_blank, read

# Letters of the same shape, and CJK radicals that have no Unicode decomposition.
LOOKALIKES = (
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿοναιρϲϳ", "ABEZHIKMNOPTYXCJovaipcj"),
    ("АВЕЅІЈКМНОРСТУХҮԌаеорсухѕіјһԁԛԝӏ", "ABESIJKMHOPCTYXYGaeopcyxsijhdqwl"),
)
RADICALS = (
    "⺀冫 ⺁厂 ⺂乛 ⺃乚 ⺄乙 ⺅亻 ⺆冂 ⺈刀 ⺉刂 ⺊卜 ⺋㔾 ⺌小 ⺍小 ⺎兀 ⺏尣 ⺐尢 ⺒巳 ⺓幺 ⺔彑 ⺖忄 ⺗心 ⺘扌 ⺙攵 ⺛旡 ⺜日 ⺝月 ⺞歺 ⺠民 ⺡氵 ⺢氺 "
    "⺣灬 ⺤爫 ⺥爫 ⺦丬 ⺧牛 ⺨犭 ⺩王 ⺫目 ⺬示 ⺭礻 ⺮竹 ⺯糹 ⺰纟 ⺱罓 ⺲罒 ⺶羊 ⺸羊 ⺹耂 ⺺聿 ⺻聿 ⺼肉 ⺽臼 ⺾艹 ⺿艹 ⻀艹 ⻁虎 ⻂衤 ⻃覀 ⻄西 ⻅见 "
    "⻆角 ⻈讠 ⻉贝 ⻋车 ⻌辶 ⻍辶 ⻎辶 ⻏邑 ⻐钅 ⻑長 ⻒镸 ⻓长 ⻔门 ⻖阝 ⻗雨 ⻘青 ⻙韦 ⻚页 ⻛风 ⻜飞 ⻝食 ⻟飠 ⻠饣 ⻢马 ⻣骨 ⻤鬼 ⻥鱼 ⻦鸟 ⻨麦 ⻩黄 "
    "⻪黾 ⻫斉 ⻬齐 ⻭歯 ⻮齿 ⻯竜 ⻰龙 ⻱龜 ⻲亀"
)
WIDE_MARKS = {"､": "、", "｡": "。", "｢": "「", "｣": "」", "･": "・", "￣": "¯"}
HEAD_DIGIT = re.compile(r"(?m)^([ \t]*)([0-9])(?=、)")


def _same_look(ch: str) -> str | None:
    """The canonical spelling of one character, or null if it is stable."""
    cp = ord(ch)
    kind = unicodedata.category(ch)
    if kind == "Cf" or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or 0x180B <= cp <= 0x180D or cp in (0x034F, 0x180F):
        return ""
    if kind == "Zs":
        return None if ch == " " else " "
    if 0xFF00 < cp < 0xFFF0:
        # NFKC, and not NFC, joins half-width voiced marks; ideographic marks are listed.
        return WIDE_MARKS.get(ch) or unicodedata.normalize("NFKC", ch)
    if 0x2F00 <= cp <= 0x2FD5 or ch in "⺟⻳":
        return unicodedata.normalize("NFKC", ch)
    if not unicodedata.is_normalized("NFC", ch):
        return unicodedata.normalize("NFC", ch)
    return None


@lru_cache(maxsize=1)
def _table() -> tuple[dict[int, str], re.Pattern]:
    """Spelling of each unstable character, and a pattern of unstable segments with their boundary context."""
    table = {ord(a): b for old, new in LOOKALIKES for a, b in zip(old, new)}
    for cp in (*range(0x370, 0x530), *range(0x1F00, 0x2000)):
        base = unicodedata.normalize("NFD", chr(cp))
        if len(base) > 1 and ord(base[0]) in table:
            table[cp] = unicodedata.normalize("NFC", table[ord(base[0])] + base[1:])
    table |= {ord(x[0]): x[1] for x in RADICALS.split()}
    marks = []
    for cp in (*range(0x80, 0x3400), *range(0xA960, 0xA980), *range(0xD7B0, 0xD800), *range(0xF900, 0x10000), *range(0x10000, 0x1F000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE01F0)):
        ch = chr(cp)
        if cp not in table and (new := _same_look(ch)) is not None:
            table[cp] = new
        if unicodedata.combining(ch) or 0x1160 <= cp <= 0x11FF or cp in (0xFF9E, 0xFF9F) or unicodedata.category(ch) == "Mc":
            marks.append(cp)

    def chars(cps: list[int]) -> str:
        out, cps = [], sorted(cps)
        while cps:
            n = 1
            while n < len(cps) and cps[n] == cps[0] + n:
                n += 1
            out.append(f"\\U{cps[0]:08x}-\\U{cps[n - 1]:08x}")
            cps = cps[n:]
        return "".join(out)

    folded = chars([cp for cp, new in table.items() if cp not in marks and new])
    gone = chars([cp for cp, new in table.items() if not new])
    mark = chars(marks)
    # A base with its marks (and invisible characters between), or a run of characters that change alone.
    return table, re.compile(rf"[^{mark}{gone}]?[{mark}{gone}]+|[{folded}](?![{mark}{gone}])")


class _Splice(dict):
    """Canonical segments by segment; those met are kept, up to a bound."""

    def __missing__(self, segment: str) -> str:
        table, _ = _table()
        new = unicodedata.normalize("NFC", unicodedata.normalize("NFC", segment.translate(table)).translate(table))
        if len(self) < 50_000:
            self[segment] = new
        return new


_SPLICE = _Splice()


def canonical(text: str) -> str:
    """The canonical form of text."""
    if not text.isascii():
        _, unstable = _table()
        get = _SPLICE.__getitem__
        text = unstable.sub(lambda m: get(m[0]), text)
    return HEAD_DIGIT.sub(lambda m: m[1] + chr(ord(m[2]) + 0xFEE0), text) if "、" in text else text


@F.pandas_udf(T.StringType())
def canonical_look(texts: pd.Series) -> pd.Series:
    """Column form of canonical."""
    return texts.map(canonical, na_action="ignore")


@F.pandas_udf(T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())]))
def _look_hash(texts: pd.Series) -> pd.DataFrame:
    """128 bits of the canonical form: what is compared, so that texts needn't be shuffled."""
    rows = []
    for text in texts:
        h = xxhash.xxh3_128_intdigest(canonical(text).encode("utf-8", "surrogatepass"))
        rows.append(((h >> 64) - 2**63, (h & (2**64 - 1)) - 2**63))
    return pd.DataFrame(rows, columns=["h1", "h2"], dtype="int64")


def looks(df: DataFrame, rec_table: str, id_col: str, text_col: str, scope: Column) -> DataFrame:
    text = F.col(text_col)
    return (
        df.where(not_blank(text))
        .select(F.lit(rec_table).alias("rec_table"), F.col(id_col).cast("long").alias("id"), scope.cast("long").alias("scope"), text.alias("text"))
        .select("rec_table", "id", "scope", _look_hash("text").alias("look"), F.xxhash64("text").alias("stored"), F.xxhash64(F.lit(1), "text").alias("stored2"))
    )


def same_look_pairs(rows: DataFrame) -> DataFrame:
    """rec_table, id_a, id_b of rows of one scope with one look that are stored differently.

    Only looks with two or more stored forms are joined; AQE splits a look that holds many rows."""
    key = ["rec_table", "scope", "look"]
    many = rows.groupBy(key).agg(F.min("stored").alias("lo"), F.max("stored").alias("hi"), F.min("stored2").alias("lo2"), F.max("stored2").alias("hi2")).where("lo <> hi OR lo2 <> hi2").select(key)
    rows = materialize(rows.join(many, key, "left_semi"), "p6-looks")
    a = rows.select(*key, F.col("id").alias("id_a"), F.col("stored").alias("sa"), F.col("stored2").alias("sa2"))
    b = rows.select(*key, F.col("id").alias("id_b"), F.col("stored").alias("sb"), F.col("stored2").alias("sb2"))
    return a.join(b, key).where("id_a < id_b AND (sa <> sb OR sa2 <> sb2)").select("rec_table", "id_a", "id_b")


def p6_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    judgments = looks(read(spark, sf_dir, "judgments"), "judgments", "doc_id", "jfull", F.lit(0))
    detections = looks(read(spark, sf_dir, "detections"), "detections", "detection_id", "line_text", F.coalesce(F.col("doc_id"), F.lit(-(2**63))))
    return judgments.unionByName(detections)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of judgments, or of detections of one judgment, that look the same and are stored differently."""
    return same_look_pairs(materialize(p6_rows(spark, sf_dir), "p6-rows"))


def p6_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of every judgment and detected line."""
    judgments = read(spark, sf_dir, "judgments").select(F.lit("judgments").alias("rec_table"), F.col("doc_id").alias("rec_id"), canonical_look("jfull").alias("text"))
    detections = read(spark, sf_dir, "detections").select(F.lit("detections").alias("rec_table"), F.col("detection_id").alias("rec_id"), canonical_look("line_text").alias("text"))
    return judgments.unionByName(detections)
