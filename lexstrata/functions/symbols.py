"""The dictionary of marker symbols: nine standard categories, and groups of private-use characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The symbols of the nine standard categories, in order.
STANDARD = {
    "中文數字": "一二三四五六七八九十",
    "大寫中文數字": "壹貳參肆伍陸柒捌玖拾",
    "天干": "甲乙丙丁戊己庚辛壬癸",
    "地支": "子丑寅卯辰巳午未申酉戌亥",
    "圍字數字": "㈠㈡㈢㈣㈤㈥㈦㈧㈨㈩",
    "帶圈數字": "⓪①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳",
    "括號數字": "⑴⑵⑶⑷⑸⑹⑺⑻⑼⑽⑾⑿⒀⒁⒂⒃⒄⒅⒆⒇",
    "全形數字": "０１２３４５６７８９",
    "羅馬數字": "ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩⅪⅫ",
}

UNGROUPED = "PUA_未分組"
# Private-use groups as disjoint ranges.
PUA_GROUPS = [
    ("PUA_半形阿拉伯數字_括弧", [(0xF4EA, 0xF4EB), (0xF4FB, 0xF4FF), (0xF6BB, 0xF6C4)]),
    ("PUA_全形阿拉伯數字_括弧", [(0xF4EF, 0xF4F4), (0xF4F9, 0xF4FA), (0xF500, 0xF501), (0xF514, 0xF520)]),
    ("PUA_小寫中文數字_括弧", [(0xF502, 0xF509)]),
    ("PUA_天干_括弧", [(0xF50A, 0xF513)]),
    ("PUA_全形阿拉伯數字_圈圈", [(0xF521, 0xF584), (0xF6B1, 0xF6BA)]),
    ("PUA_全形阿拉伯數字_句號", [(0xF585, 0xF5E8)]),
    ("全形數字", [(0xF5E9, 0xF64C)]),
    ("PUA_小寫中文數字_頓號", [(0xF64D, 0xF6B0)]),
    ("PUA_羅馬數字", [(0xF6C5, 0xF6CE)]),
]
PUA_BLOCKS = [(0xE000, 0xF8FF), (0xF0000, 0xFFFFD), (0x100000, 0x10FFFD)]
MAX_LEVELS = 18


def standard_symbols() -> dict[str, str]:
    """Category by symbol."""
    return {c: name for name, chars in STANDARD.items() for c in chars}


def symbol_table(spark: SparkSession) -> DataFrame:
    """symbol, category: 115 rows."""
    return spark.createDataFrame(sorted(standard_symbols().items()), "symbol string, category string")


def _between(cp: Column, ranges: list[tuple[int, int]]) -> Column:
    out = F.lit(False)
    for lo, hi in ranges:
        out = out | cp.between(lo, hi)
    return out


def is_pua(c: Column) -> Column:
    """Whether the first character is a private-use one."""
    return F.coalesce(_between(F.ascii(c), PUA_BLOCKS), F.lit(False))


def pua_group(c: Column) -> Column:
    """The group of a private-use character; null for others."""
    cp = F.ascii(c)
    out = F.when(~is_pua(c), F.lit(None).cast("string"))
    for name, ranges in PUA_GROUPS:
        out = out.when(_between(cp, ranges), F.lit(name))
    return out.otherwise(F.lit(UNGROUPED))


def code_name(c: Column) -> Column:
    """U+ and at least four hexadecimal digits of the first character."""
    return F.format_string("U+%04X", F.ascii(c))
