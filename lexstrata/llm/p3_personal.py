"""Problem 3: personal information inside free text.

Method: a semi-Markov conditional random field. Segments of bounded length are candidates, each with features of the whole
span (its form and size, how its characters stand in ordinary text, what is before and behind it). A segmentation's score
is the sum of its segments' weights and of a weight for each two entities that touch; text outside entities scores zero.
A dynamic program over the candidates' ends chooses boundaries and types jointly. The weights are those of the greatest
conditional likelihood (``p3_train``, by forward and backward sums over the same lattice) and stand in ``p3_weights``.

* Names: every span of two to four ideographs that begins with a surname, with or before a character strange to ordinary
  text, or behind a role; every span around the dot of a foreign name; every two or three capitalized words. No list of given
  names: what tells a name is its surname, its place, and that ordinary text has no such pairs of characters.
* Numbers, e-mails and addresses: spans around what announces them (a digit, the sign, the city), cut at each of their
  parts to the left and the right.
* Segments that can't be part of a best path (of no positive weight) are left out, which changes nothing.

Types: email, phone, id_number, address, name. Full- and half-width forms are read alike. Masked values, land lots,
account, invoice and company numbers, courts and companies have features of their own that keep them out.
Null and empty texts hold nothing; texts are read whole, in one pass each.
"""

from __future__ import annotations

import base64
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import code_points, mix64, read
from .p3_weights import KNOWN_CHARS, KNOWN_PAIRS, WEIGHTS

TYPES = ("email", "phone", "id_number", "address", "name")
PAIR_BITS = 18
_D = "[0-9０-９]"
_N = "[0-9０-９一二三四五六七八九十百零〇]+"
_A = "A-Za-zＡ-Ｚａ-ｚ"
_H = "[一-鿿]"
_AT = r"(?:[@＠]|[(（\[]at[)）\]])"
_L = "A-Za-zÀ-ÿ"

EMAIL = re.compile(rf"([{_A}0-9０-９][{_A}0-9０-９._+\-．＿＋－]{{0,63}}){_AT}([{_A}0-9０-９\-－]+(?:[.．][{_A}0-9０-９\-－]+)+)")
PHONE = re.compile(rf"[+＋]?[(（]?{_D}(?:{_D}|[-－ ()（）](?=[-－ ()（）]?{_D})){{5,22}}")
ID = re.compile(rf"[{_A}](?:{_D}{{9,10}}|[{_A}]{_D}{{8,9}})")
ADDRESS = re.compile(rf"{_H}{{2,3}}[市縣](?:{_H}{{1,3}}?[區鄉鎮市])?(?:{_H}{{1,3}}?[里村])?(?:{_N}鄰)?{_H}{{1,6}}?(?:路|街|大道)(?:{_N}段)?(?:{_N}巷)?(?:{_N}弄)?{_N}(?:[之-]{_N})?號(?:之{_N})?(?:{_N}樓)?(?:之{_N})?")
ADDRESS_EN = re.compile(r"No\. ?\d+(?:-\d+)?(?:, ?(?:Ln|Aly|Sec|Lane|Alley)\.? ?\d+)*, ?[A-Za-zÀ-ÿ' ]{2,40}?(?:Rd|St|Ave|Blvd)\.?(?:, ?[A-Za-zÀ-ÿ .]{2,30}(?:Dist|Township)\.?)?, ?[A-Za-zÀ-ÿ]{2,30} ?City")

# Roles before a name, titles behind or before one, common surnames, surnames of two characters.
ROLES = "審判長法官 法官 書記官 公訴人 被告 原告 上訴人 被上訴人 聲請人 相對人 訴訟代理人 代理人 辯護人 選任辯護人 證人 告訴人 參加人 檢察官 律師 通譯 鑑定人 抗告人 債權人 債務人 司法事務官".split()
TITLES = re.compile("律師|先生|女士|小姐|法官|檢察官|書記官")
COMMON = frozenset("陳林黃張李王吳劉蔡楊許鄭謝郭洪邱曾廖賴徐周葉蘇莊江呂何蕭羅高潘簡朱鍾彭游詹胡施沈余盧梁趙顏柯翁魏孫戴范方宋鄧杜傅侯曹薛丁卓馬阮董溫唐藍石蔣康鄒白涂尤巫韓龔嚴袁夏")
COMPOUND = frozenset("歐陽 司馬 司徒 諸葛 上官 夏侯 皇甫 尉遲 公孫 慕容 令狐 端木 東方 南宮 范姜 張簡".split())
_ROLE = re.compile(rf"(?:{'|'.join(r'[ 　]*'.join(r) for r in sorted(ROLES, key=len, reverse=True))})([ 　]*[：:][ 　]*|[ 　\t]+|)")
_FOREIGN = re.compile(rf"{_H}{{2,6}}[·‧・•]{_H}{{2,6}}")
_LATIN = re.compile(rf"(?<![{_L}@＠])[A-ZÀ-Þ][a-zà-öø-ÿ]{{1,15}}(?:[ -]?[A-ZÀ-Þ][a-zà-öø-ÿ]{{1,15}}){{1,5}}(?![{_L}@＠])")
_WORD = re.compile(r"[A-ZÀ-Þ][a-zà-öø-ÿ]+")
_LATIN_TITLES = frozenset("Mr Mrs Ms Dr Prof Judge Sir Madam Miss No Ln Aly Sec Rd St Ave Blvd Dist City".split())
_COMPANY = re.compile(r"\s?(?:商行|公司|型|City|Rd|企業|工廠|銀行)")
_CUES = {
    "phone": re.compile(r"(?:電話|TEL|Tel|tel|門號|撥打|手機|傳真|專線|聯絡|行動)[：: 　]*$|[（(]$"),
    "id_number": re.compile(r"(?:證號|字號|編號|身分證|居留證|憑|護照)[：: 　]*$|[（(]$"),
    "not": re.compile(r"(?:帳號|建號|統一編號|發票號碼|案號|序號|地號|新臺幣|代碼|[第年月])[：: 　]*$"),
    "address": re.compile(r"(?:住|設籍|居所地?在|送達|於|址|遷至|寄至|位於|座落|籍設)[：: 　]*$"),
}
_START = re.compile(r"(?:^|[\r\n。；！？：、，,.]|[^\s\w]|[甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥①-⓿⑴-⒇㈠-㈩Ⅰ-Ⅻ0-9０-９])[ 　]*$")
_WIDE = {0xFF01 + i: 0x21 + i for i in range(94)}


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    type: str
    features: tuple[str, ...]


def _digits(s: str) -> str:
    return "".join(c for c in s.translate(_WIDE) if c.isdigit())


def _around(text: str, a: int, b: int) -> tuple[str, str]:
    return text[max(0, a - 12) : a], text[b : b + 6]


def _is_digit(c: str) -> bool:
    return c.isdigit() and (c.isascii() or "０" <= c <= "９")


def _is_latin(c: str) -> bool:
    return c.isalpha() and (c.isascii() or "Ａ" <= c <= "ｚ")


def _emails(text: str) -> Iterator[Candidate]:
    for m in EMAIL.finditer(text):
        # The local part may begin behind each of its marks; the domain ends behind each of its labels.
        begins = {m.start(), *(m.start() + i + 1 for i, c in enumerate(m[1][:-1]) if c in "._+-．＿＋－" and m[1][i + 1] not in "._+-．＿＋－")}
        ends = {m.end(), *(m.start(2) + i for i, c in enumerate(m[2]) if c in ".．" and re.search("[.．]", m[2][:i]))}
        for a in begins:
            for b in ends:
                yield Candidate(a, b, "email", ("email", *(("email:later",) * (a != m.start())), *(("email:shorter",) * (b != m.end()))))


def _phones(text: str) -> Iterator[Candidate]:
    for m in PHONE.finditer(text):
        parts = [p.span() for p in re.finditer(f"{_D}+", m[0])]
        for i in range(min(3, len(parts))):
            for j in range(len(parts) - 1, max(i, len(parts) - 4) - 1, -1):
                a, b = m.start() + parts[i][0], m.start() + parts[j][1]
                a -= text[a - 1 : a] in ("+", "＋")
                # An opening bracket belongs to the number if the closing one stands within it.
                a -= text[a - 1 : a] in ("(", "（") and bool(re.search("[)）]", text[a:b]))
                yield _phone(text, a, b)


def _phone(text: str, a: int, b: int) -> Candidate:
    left, right = _around(text, a, b)
    span, digits = text[a:b].translate(_WIDE), _digits(text[a:b])
    country = span[0] == "+"
    digits = digits[3:] if country and digits.startswith("886") else digits
    national = len(digits) - digits.startswith("0")
    foreign = country and not _digits(span).startswith("886")
    size = ("foreign" if 8 <= national <= 15 else "odd") if foreign else str(national) if 6 <= national <= 10 else "odd"
    f = ["phone", f"phone:size={size}"]
    if not foreign:
        f.append(f"phone:first={'zero' if digits.startswith('0') else 'country' if country else 'other'}:{digits.lstrip('0')[:1] or '0'}")
    f += ["phone:country"] * country + ["phone:bracket"] * ("(" in span) + ["phone:parted"] * bool(re.search("[-() ]", span)) + ["phone:unclosed"] * (span.count("(") != span.count(")"))
    f += ["phone:cue"] * bool(_CUES["phone"].search(left)) + ["phone:not"] * bool(_CUES["not"].search(left))
    before = text[a - 1 : a].translate(_WIDE)
    after = text[b : b + 2].translate(_WIDE)
    latin = _is_latin(before) and not left.lower().endswith("tel")
    f += ["phone:cut_left"] * bool(re.match("[0-9+/-]", before) or latin) + ["phone:cut_right"] * bool(re.match(r"[0-9/*]|[- )][0-9]", after))
    return Candidate(a, b, "phone", tuple(f))


def _ids(text: str) -> Iterator[Candidate]:
    for m in ID.finditer(text):
        a = m.start()
        # The regular expression reads as far as it can; each shorter form is a candidate too.
        for start, end in {(a, m.end()), (a, m.end() - 1), (a + 1, m.end())}:
            span = text[start:end].translate(_WIDE).upper()
            if not re.fullmatch("[A-Z](?:[0-9]{9}|[A-Z][0-9]{8})", span):
                continue
            left, _ = _around(text, start, end)
            shape = "one" if span[1].isdigit() else "two"
            f = ["id", f"id:{shape}", f"id:{shape}:second={'usual' if span[1] in '1289ABCD' else 'other'}"]
            f += ["id:cue"] * bool(_CUES["id_number"].search(left)) + ["id:not"] * bool(_CUES["not"].search(left) and not left.rstrip("：: 　").endswith("身分證統一編號"))
            f += ["id:cut"] * bool(re.match(rf"[{_A}0-9０-９]", text[start - 1 : start]) or re.match(rf"[{_A}0-9０-９*＊]", text[end : end + 1]))
            yield Candidate(start, end, "id_number", tuple(f))


def _addresses(text: str) -> Iterator[Candidate]:
    if "市" in text or "縣" in text:
        for m in ADDRESS.finditer(text):
            house = text.rfind("號", m.start(), m.end()) + 1
            floor = text.rfind("樓", m.start(), m.end()) + 1
            for a in {m.start(), m.start() + 1} if text[m.start() + 3] in "市縣" else {m.start()}:
                for b in {m.end(), house, floor} - {0}:
                    yield _address(text, a, b, "han")
    if "No." in text:
        for m in ADDRESS_EN.finditer(text):
            yield _address(text, m.start(), m.end(), "latin")


def _address(text: str, a: int, b: int, kind: str) -> Candidate:
    left, right = _around(text, a, b)
    f = ["address", f"address:{kind}"]
    if kind == "han":
        f.append(f"address:city={2 if text[a + 2] in '市縣' else 3}")
    f += ["address:cue"] * bool(_CUES["address"].search(left)) + ["address:start"] * bool(_START.search(left))
    f += ["address:more"] * bool(re.match(rf"之?{_N}[樓號]?|樓", right)) + ["address:lot"] * right.startswith("地號")
    return Candidate(a, b, "address", tuple(f))


def _bits(text: str) -> np.ndarray:
    return np.unpackbits(np.frombuffer(base64.b64decode(text), np.uint8), bitorder="little").astype(bool)


def pair_slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (mix64((first.astype(np.uint64) << np.uint64(21)) | second.astype(np.uint64)) & np.uint64((1 << PAIR_BITS) - 1)).astype(np.int64)


class Ordinary:
    """Which ideographs, and which pairs of neighbours (hashed), ordinary text has."""

    def __init__(self, chars: np.ndarray, pairs: np.ndarray) -> None:
        self.chars, self.pairs = np.zeros(65536, bool), pairs
        self.chars[0x4E00 : 0x4E00 + chars.size] = chars


ORDINARY = Ordinary(_bits(KNOWN_CHARS), _bits(KNOWN_PAIRS))
LEFT = ("start", "role", "role_beside", "known", "unknown", "other", "strange")
RIGHT = ("line_end", "mark", "title", "known", "unknown:known", "unknown:unknown", "other", "strange")
SURNAME = ("none", "common", "strange", "compound")
SIZES = (2, 3, 4)


def _han_names(text: str, ordinary: Ordinary) -> tuple[np.ndarray, list[np.ndarray]]:
    """The spans of ideographs that may be names, as rows (start, size), and per feature the number of its value: surname,
    pairs known inside, strange characters behind the first, left, right."""
    n = len(text)
    cps = code_points(text + "\n" * 8).astype(np.int64)
    basic = np.minimum(cps, 0xFFFF)
    han = (cps >= 0x4E00) & (cps <= 0x9FFF)
    numbering = _in(basic, "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥")
    strange = han & ~ordinary.chars[basic] & ~numbering
    # known[i]: ordinary text has the pair of i and i + 1.
    known = np.zeros(cps.size, bool)
    known[:-1] = han[:-1] & han[1:] & ordinary.pairs[pair_slots(cps[:-1], cps[1:])]
    # A surname that also numbers lines is one behind a role only.
    surname = np.where(_in(basic, COMMON) & ~numbering, 1, np.where(strange, 2, 0))
    for two in COMPOUND:
        at = (cps[:-1] == ord(two[0])) & (cps[1:] == ord(two[1]))
        surname[:-1][at] = 3
    role = np.zeros(cps.size, np.int8)
    for m in _ROLE.finditer(text):
        role[m.end()] = 1 if m[1] else 2
    title = np.zeros(cps.size, bool)
    for m in TITLES.finditer(text):
        title[m.start()] = True
    line_end = _in(basic, "\r\n")
    blank = _in(basic, " 　")
    mark = _in(basic, "，。；、）)」：:,.;！？")
    # The next character that isn't a blank, for ends of lines and titles behind blanks.
    solid = np.flatnonzero(~blank)
    next_ = solid[np.minimum(np.searchsorted(solid, np.arange(cps.size)), solid.size - 1)]
    wordish = ~han & (((cps >= 0x30) & (cps <= 0x39)) | ((cps >= 0xFF10) & (cps <= 0xFF19)) | ((basic | 32) >= 0x61) & ((basic | 32) <= 0x7A) | ((cps >= 0xC0) & (cps <= 0x24F)))
    rows = []
    begin = np.flatnonzero(han[:n] & ((surname[:n] > 0) | (role[:n] > 0) | strange[1 : n + 1]))
    for size in SIZES:
        whole = np.ones(begin.size, bool)
        for k in range(1, size):
            whole &= han[begin + k]
        at = begin[whole]
        inside = sum(known[at + k].astype(np.int64) for k in range(size - 1))
        odd = sum(strange[at + k].astype(np.int64) for k in range(1, size))
        before, after = np.maximum(at - 1, 0), at + size
        left = np.where(han[before], np.where(strange[before], 6, np.where(numbering[before] & ~known[before], 0, np.where(known[before], 3, 4))), np.where(wordish[before], 5, 0))
        left = np.where(at == 0, 0, np.where(role[at] > 0, role[at], left))
        right = np.where(strange[after], 7, np.where(known[after - 1], 3, np.where(known[after], 4, 5)))
        right = np.where(han[after], right, np.where(line_end[after] | line_end[next_[after]], 0, np.where(mark[after], 1, 6)))
        right = np.where(title[after] | title[next_[after]] & blank[after], 2, right)
        rows.append(np.stack([at, np.full(at.size, size), surname[at], inside, odd, left, right]))
    table = np.concatenate(rows, axis=1) if rows else np.empty((7, 0), np.int64)
    return table[:2], list(table[2:])


def _in(basic: np.ndarray, chars) -> np.ndarray:
    table = np.zeros(65536, bool)
    table[[ord(c) for c in chars]] = True
    return table[basic]


def _han_features(size: int, surname: int, inside: int, odd: int, left: int, right: int) -> tuple[str, ...]:
    s, x, y = SURNAME[surname], LEFT[left], RIGHT[right]
    return ("name", f"name:size={size}", f"name:{s}", f"name:inside={size}/{inside}", f"name:strange={size}/{odd}", f"name:{s}<{x}", f"name:{s}>{y}", f"name:{x}<>{y}", f"name:{s}:{size}/{inside}")


@lru_cache(maxsize=8)
def _han_tables(key: int) -> tuple[np.ndarray, ...]:
    """The weights of the features above, added up where they have the same values; key: of a set of weights kept in _SETS."""
    w = _SETS[key]
    get = lambda f: w.get(f, 0.0)
    form = np.zeros((5, 4, 4, 4))
    for size in SIZES:
        for s, name in enumerate(SURNAME):
            for inside in range(4):
                for odd in range(4):
                    form[size, s, inside, odd] = sum(map(get, ("name", f"name:size={size}", f"name:{name}", f"name:inside={size}/{inside}", f"name:strange={size}/{odd}", f"name:{name}:{size}/{inside}")))
    left = np.array([[get(f"name:{s}<{x}") for x in LEFT] for s in SURNAME])
    right = np.array([[get(f"name:{s}>{y}") for y in RIGHT] for s in SURNAME])
    both = np.array([[get(f"name:{x}<>{y}") for y in RIGHT] for x in LEFT])
    return form, left, right, both


_SETS: dict[int, dict[str, float]] = {}


def _other_names(text: str, ordinary: Ordinary) -> Iterator[Candidate]:
    is_strange = lambda c: "一" <= c <= "鿿" and not ordinary.chars[ord(c)]
    for m in _FOREIGN.finditer(text):
        dot = next(i for i in range(m.start(), m.end()) if text[i] in "·‧・•")
        for a in range(max(m.start(), dot - 5), dot - 1):
            for b in range(dot + 3, min(m.end(), dot + 6) + 1):
                f = ["name:foreign", f"name:before={dot - a}", f"name:behind={b - dot - 1}"]
                f += [f"name:ordinary={min(3, sum(not is_strange(c) for c in text[a:dot] + text[dot + 1 : b]))}"]
                f += ["name:cut_left"] * bool(a and is_strange(text[a - 1])) + ["name:cut_right"] * bool(is_strange(text[b : b + 1] or " "))
                yield _placed(text, a, b, f, "foreign")
    for m in _LATIN.finditer(text):
        words = [x.span() for x in _WORD.finditer(m[0])]
        for i in range(len(words) - 1):
            for j in range(i + 1, min(i + 3, len(words))):
                a, b = m.start() + words[i][0], m.start() + words[j][1]
                some = [m[0][x:y] for x, y in words[i : j + 1]]
                f = ["name:latin", f"name:words={j - i + 1}", *(("name:title_inside",) * any(x in _LATIN_TITLES for x in some)), *(("name:company",) * bool(_COMPANY.match(text, b)))]
                f += ["name:cut_left"] * (i > 0 and m[0][slice(*words[i - 1])] not in _LATIN_TITLES) + ["name:cut_right"] * (j < len(words) - 1)
                yield _placed(text, a, b, f, "latin title" if i > 0 and m[0][slice(*words[i - 1])] in _LATIN_TITLES else "latin")


def _placed(text: str, a: int, b: int, f: list[str], kind: str) -> Candidate:
    left, right = _around(text, a, b)
    role = next((m for m in _ROLE.finditer(left) if m.end() == len(left)), None)
    f.append(f"name:{kind}<{'role' if role and role[1] else 'role_beside' if role else 'start' if _START.search(left) else 'other'}")
    end = right.lstrip(" 　")
    f.append(f"name:{kind}>{'line_end' if not end or end[0] in chr(13) + chr(10) else 'title' if TITLES.match(end) else 'mark' if re.match(r'[，。；、）)]', right) else 'other'}")
    return Candidate(a, b, "name", tuple(f))


def candidates(text: str, weights: dict[str, float] | None = None, ordinary: Ordinary | None = None) -> list[Candidate]:
    """All segments that may be entities, with the features of each; with weights, of spans of ideographs only those that can
    stand in a best path."""
    ordinary = ordinary or ORDINARY
    out = [*_emails(text), *_phones(text), *_ids(text), *_addresses(text), *_other_names(text, ordinary)]
    (at, size), (surname, inside, odd, left, right) = _han_names(text, ordinary)
    if weights is not None:
        key = id(weights)
        _SETS[key] = weights
        form, lefts, rights, both = _han_tables(key)
        score = form[size, surname, inside, odd] + lefts[surname, left] + rights[surname, right] + both[left, right]
        keep = score > -max(0.0, weights.get("touch", 0.0)) * 2
        at, size, surname, inside, odd, left, right = (x[keep] for x in (at, size, surname, inside, odd, left, right))
    for a, n, *f in zip(*(x.tolist() for x in (at, size, surname, inside, odd, left, right))):
        out.append(Candidate(a, a + n, "name", _han_features(n, *f)))
    return out


def score(c: Candidate, weights: dict[str, float]) -> float:
    return sum(weights.get(f, 0.0) for f in c.features)


def decode(some: list[Candidate], weights: dict[str, float]) -> list[Candidate]:
    """The segments without overlap whose weights, with that of those that touch, have the highest sum."""
    touch = weights.get("touch", 0.0)
    scored = sorted(((c.end, c.start, s, c) for c in some if (s := score(c, weights)) + 2 * max(0.0, touch) > 0), key=lambda x: x[:3])
    if not scored:
        return []
    ends = sorted({x[0] for x in scored})
    # For each end: the best path up to it, and the best one whose last segment ends there.
    best, closed = [0.0] * len(ends), [-math.inf] * len(ends)
    back: list[tuple[int, Candidate | None]] = [(-1, None)] * len(ends)
    closing: list[tuple[int, bool, Candidate] | None] = [None] * len(ends)
    row = 0
    for k, end in enumerate(ends):
        while row < len(scored) and scored[row][0] == end:
            _, start, s, c = scored[row]
            row += 1
            j = bisect_right(ends, start) - 1
            touches = j >= 0 and ends[j] == start
            open_ = (best[j - 1] if j > 0 else 0.0) if touches else (best[j] if j >= 0 else 0.0)
            beside = closed[j] + touch if touches else -math.inf
            if max(open_, beside) + s > closed[k]:
                closed[k], closing[k] = max(open_, beside) + s, (j, beside > open_, c)
        before = best[k - 1] if k else 0.0
        best[k] = max(before, closed[k])
    out, k, must = [], len(ends) - 1, False
    while k >= 0:
        before = best[k - 1] if k else 0.0
        if closing[k] is not None and (must or closed[k] > before):
            j, must, c = closing[k]
            out.append(c)
            k = j if must or j < 0 or ends[j] != c.start else j - 1
        else:
            k, must = k - 1, False
    return out[::-1]


def entities(text: str) -> list[Candidate]:
    return decode(candidates(text, WEIGHTS), WEIGHTS)


def batch_spans(texts: list[str], at_once: int = 200_000) -> Iterator[list[tuple[int, int, str]]]:
    """For each text the (start, end, type) of its entities, in order: texts are read many at a time, as lines of one."""
    some: list[str] = []
    size = 0
    for k, text in enumerate(texts):
        some.append(text)
        size += len(text) + 1
        if size >= at_once or k == len(texts) - 1:
            begin = np.cumsum([0, *(len(x) + 1 for x in some)]).tolist()
            found: list[list[tuple[int, int, str]]] = [[] for _ in some]
            for c in entities("\n".join(some)):
                at = bisect_right(begin, c.start) - 1
                found[at].append((c.start - begin[at], c.end - begin[at], c.type))
            yield from found
            some, size = [], 0


def batch_entities(texts: list[str], at_once: int = 200_000) -> Iterator[list[tuple[str, str]]]:
    """For each text the (type, text) of its entities."""
    for text, spans in zip(texts, batch_spans(texts, at_once)):
        yield [(kind, text[a:b]) for a, b, kind in spans]


def placeholders(text: str, spans: list[tuple[int, int, str]]) -> str:
    """text with [TYPE] in place of each span."""
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(text: str) -> str:
    """text with [TYPE] in place of each entity."""
    return placeholders(text, next(batch_spans([text])))


@F.pandas_udf(T.StringType())
def redacted(texts: pd.Series) -> pd.Series:
    """Column form of redact."""
    known = texts.fillna("").tolist()
    out = [placeholders(t, spans) for t, spans in zip(known, batch_spans(known))]
    return pd.Series(out, index=texts.index, dtype=object).where(texts.notna(), None)


def find(records: DataFrame) -> DataFrame:
    """rec_table, rec_id, pii_type, pii_text of the records (rec_table, rec_id, text), each once a record."""

    def find_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for table, rid, some in zip(pdf["rec_table"], pdf["rec_id"], batch_entities(pdf["text"].tolist())):
                rows += [(table, rid, *x) for x in sorted(set(some))]
            yield pd.DataFrame(rows, columns=["rec_table", "rec_id", "pii_type", "pii_text"]).astype({"rec_id": "int64"})

    return records.where("text <> ''").mapInPandas(find_batches, "rec_table string, rec_id long, pii_type string, pii_text string")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    judgments = read(spark, sf_dir, "judgments").select(F.lit("judgments").alias("rec_table"), F.col("doc_id").cast("long").alias("rec_id"), F.col("jfull").alias("text"))
    chunks = read(spark, sf_dir, "rag_chunks").select(F.lit("rag_chunks").alias("rec_table"), F.col("row_id").cast("long").alias("rec_id"), F.col("full_text").alias("text"))
    return judgments.unionByName(chunks)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal information of judgments and chunks."""
    return find(records(spark, sf_dir))


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgments and chunks with typed placeholders."""
    return records(spark, sf_dir).withColumn("text", redacted("text"))
