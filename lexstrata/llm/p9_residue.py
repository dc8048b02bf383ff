"""Problem 9: template residue, filler, error pages and notices that scripts are required.

Method: labelled residue exemplars are retrieved through an inverted index, and their TF-IDF containment over passage
windows decides.

* An exemplar is a set of terms: pairs of neighbouring ideographs, words, and typed terms. Whatever the name in it, an
  unfilled slot is the one term SLOT, a value that a program failed to fill in (null, NaN, #REF! as a field's value) the
  term VALUE, and the frame of a stack trace the term FRAME. Typed terms are listed, retrieved and weighed as the others.
* Term weights come from document frequencies over the whole corpus, counted in one pass.
* The inverted index lists an exemplar under its heaviest terms only: those without which its coverage can't reach the
  threshold. Of a document, only passages with a listed term are weighed.
* A passage is a sentence or line, or two short ones; for exemplars shorter than it, the windows of the exemplar's size.
  Residue is a window that covers ``COVERAGE`` of an exemplar's weight. An exemplar of one or two words must be covered and
  must also cover the passage, since its words may stand in any prose.
* Other wordings are found by all exemplars of a label together: a passage of ``POOL_TERMS`` terms or more of which they
  contain ``POOL_COVERAGE`` by weight, usual words (of over a twentieth of the most frequent one's documents) left out.
* Text in quotation marks 「」 or 『』 is reported speech and taken out first; so masked names and marks of omission
  have no exemplar. Null, empty and blank texts are no residue.

Exemplars are parameters: a corpus with other residue gets its own list.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from http import HTTPStatus

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import not_blank, read

COVERAGE, SHORT, FEW = 0.8, 60, 2
POOL_COVERAGE, POOL_TERMS, STRONG_TERMS = 0.75, 4, 2

# Labelled exemplars. Parts that vary (numbers, codes, file names) carry no terms.
EXEMPLARS: dict[str, tuple[str, ...]] = {
    "script": (
        "請啟用 JavaScript 以檢視裁判書全文", "您的瀏覽器不支援或已停用 JavaScript，部分功能無法使用", "本網頁需開啟指令碼功能方能正常顯示，請調整瀏覽器設定",
        "noscript: 請開啟瀏覽器之Script功能", "You need to enable JavaScript to run this app", "This site requires cookies and scripts", "Please turn them on and reload",
        "Please enable JavaScript to continue", "JavaScript is disabled in your browser", "請輸入驗證碼以確認您不是機器人", "Please wait while we verify that you are human",
        "Checking your browser before accessing the archive", "Please complete the captcha to continue", "請完成人機驗證",
        "Please turn on JavaScript in your browser settings and reload the page", "This page requires JavaScript to work properly", "Your browser does not support JavaScript",
        "Enable JavaScript and cookies to continue", "You must have cookies enabled to view this site", "Please disable your ad blocker", "Verify you are human", "I am not a robot",
        "請開啟 JavaScript 功能後重新載入", "此網站需要使用 Cookie，請允許後再試一次", "本站須啟用 JavaScript 才能瀏覽", "請關閉廣告阻擋程式後重新整理",
    ),
    "error": (
        "系統發生錯誤（代碼），請稍後再試", "系統忙碌中，請稍後再試", "伺服器忙碌中，請於分鐘後重新整理頁面", "您的工作階段已過期，請重新登入後再查詢", "連線逾時，請重新登入", "請重新登入",
        "查詢結果載入失敗，請重新整理", "查詢逾時，連線已中斷", "資料庫連線失敗", "請洽系統管理員", "錯誤編號：", "無此頁面！", "檢索條件有誤，請回上一頁", "查無資料，請重新查詢",
        "很抱歉，您所查詢的案件資料不存在或已移除", "很抱歉，您所查詢的網頁不存在或已移除", "很抱歉，您所查詢的裁判書不存在或已移除", "找不到您要的頁面", "網站維護中，預計小時後恢復服務", "造成不便敬請見諒",
        "回首頁｜網站導覽｜隱私權政策", "您沒有權限檢視此頁面", "ORA: timeout occurred", "Access denied. Your request was blocked", "The page you requested could not be displayed",
        "HTTP Status Internal Server Error", "HTTP Status Too Many Requests", "HTTP Status Not Found", "HTTP Status Service Unavailable", "Type: Status Report", "Gateway Timeout",
        "Bad Gateway", "Service Unavailable nginx", "Too Many Requests nginx", "Internal Server Error nginx", "Forbidden nginx", "Not Found nginx", "html head title head body", "Bad Request nginx", "Request Timeout nginx", "HTTP Status Forbidden", "HTTP Status Bad Request", "HTTP Status Bad Gateway",
        "HTTP Status Gateway Timeout", "Traceback (most recent call last)", "java lang NullPointerException", "at app View render View java", "File render py line in page", "KeyError jfull", "Page not found", "Too many requests, please try again later",
        "Sorry, we can't find the page you are looking for", "This page does not exist or has been removed", "An unexpected error occurred", "Something went wrong, please try again",
        "The server encountered an internal error and could not complete your request", "This site is under maintenance and will be back soon", "Your session has expired, please log in again",
        "You do not have permission to access this page", "The connection has timed out", "Unable to connect to the server", "Exception in thread main",
        "網站目前正在維護中，請稍後再來", "系統維護中，暫停服務", "您要找的頁面不存在", "發生未預期的錯誤", "無法連線到伺服器", "您沒有權限存取此資源", "網頁無法顯示，請返回上一頁",
    ),
    "filler": (
        "請在此輸入內容", "內容建置中", "本段文字僅供排版測試", "正式上線後將由實際內容取代", "標題文字標題文字", "此處為範例文字", "這裡放說明", "測試測試", "範例段落", "敬請期待", "此處填寫內容", "文字文字文字",
        "Sample paragraph for layout only", "Placeholder heading", "Replace this text before publishing", "asdf asdf qwer asdf", "Your text goes here", "Insert text here",
        "待補", "待補，請勿引用", "內容待補", "請輸入文字", "Your content here", "Content coming soon", "This is placeholder text", "Lorem text to be replaced", "Write your text here", "TODO write content",
    ),
    "template": ("SLOT", "VALUE"),
    "trace": ("FRAME",),
    "latin": ("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua",),
}
# The syntaxes of unfilled slots.
SLOTS = re.compile(
    "|".join((
        r"\$\{[^{}\n]{1,200}\}", r"\$!\{?[A-Za-z_][\w.]*\}?", r"\{\{[^{}\n]{1,200}\}\}", r"\{%[^%\n]{1,200}%\}", r"#\{[^{}\n]{1,200}\}", r"<%=?[^%\n]{1,200}%>", r"\{\d{1,2}\}", r"\{[A-Za-z_][\w.]{1,40}\}",
        r"(?<!%)%[A-Z][A-Z_]{2,}%", r"@@\w+@@", r"__[A-Z][A-Z_]*?[A-Z]__", r"\[\[[^\[\]\n]{1,40}\]\]", r"\[INSERT [^\]\n]{1,80}\]", r"\[(?i:your|enter|insert|add|type) [^\]\n]{1,80}\]", r"«[^«»\n]{1,40}»",
        r"【請[填輸][^】\n]{0,40}】", r"（此處[填輸][^）\n]{0,40}）", r"<[一-鿿]{2,12}>", r"<[A-Z]+(?:_[A-Z]+)+>",
    ))
)
# What programs write for a value that they don't have.
_VALUE = r"(?:\(null\)|null|NULL|None|NaN|undefined|nil|#REF!|#N/A|#VALUE!|#NAME\?|#DIV/0!|\[object Object\]|TBD)"
_ANY_VALUE = re.compile(_VALUE)
VALUES = re.compile(rf"(?m)(?:(?<=[：:＝=年月])|^)[ \t　]*{_VALUE}(?:[ \t　]+{_VALUE})*[ \t　\r]*(?=$|[年月日，。；,;])")
# Frames of stack traces.
FRAMES = re.compile(r"(?m)^\s*at [\w.$<>]+\([\w.]+:\d+\)|^\s*File \"[^\"\n]{1,200}\", line \d+")
QUOTED = re.compile("「[^「」]*」|『[^『』]*』")
PASSAGE = re.compile(r"[\r\n。！？!?]+|(?<=[a-z])\.\s")
# Typed terms are noncharacters, which no text holds once they are taken out.
SLOT, VALUE, FRAME = "\ufdd0", "\ufdd1", "\ufdd2"
TYPED = {"SLOT": SLOT, "VALUE": VALUE, "FRAME": FRAME}
_TAKEN = re.compile(f"[{SLOT}{VALUE}{FRAME}]")
TERM = re.compile(f"[a-zà-ÿ]+|[一-鿿]+|[{SLOT}{VALUE}{FRAME}]")
_PLAIN = re.compile(r"[{}<%@$_\[«【（]")


def typed(text: str) -> str:
    """Lower-cased, with one character in place of each slot, missing value and stack frame."""
    text = _TAKEN.sub(" ", text)
    if _ANY_VALUE.search(text):
        text = VALUES.sub(f" {VALUE} ", text)
    if _PLAIN.search(text):
        text = SLOTS.sub(f" {SLOT} ", text)
    return (FRAMES.sub(f" {FRAME} ", text) if " at " in text or "\nat " in text or "line " in text or text.startswith("at ") else text).lower()


def terms(text: str) -> list[str]:
    """Terms of typed text in order."""
    out = []
    for run in TERM.findall(text):
        out += [run[i : i + 2] for i in range(len(run) - 1)] if "一" <= run[0] <= "鿿" and len(run) > 1 else [run]
    return out


def own_text(text: str) -> str:
    """Without what is quoted."""
    if "「" in text or "『" in text:
        before = None
        while before != text:
            before, text = text, QUOTED.sub(" ", text)
    return text


@dataclass(frozen=True)
class Exemplar:
    label: str
    terms: frozenset[str]
    length: int

    @property
    def whole(self) -> bool:
        """Whether it must also cover the passage."""
        return len(self.terms) <= FEW and not self.terms & set(TYPED.values())


def exemplars(texts: dict[str, tuple[str, ...]] = EXEMPLARS) -> list[Exemplar]:
    """The exemplars of the texts, by sentence; names of typed terms stand for these. Status lines of HTTP come by rule."""
    statuses = tuple(f"{head}{s.phrase}" for s in HTTPStatus if s >= 400 and " " in s.phrase for head in ("", "HTTP Status "))
    out = {}
    for label, some in [*texts.items(), ("error", statuses)]:
        for text in some:
            for part in PASSAGE.split(TYPED.get(text, text.lower())):
                if t := terms(part):
                    out.setdefault(frozenset(t), Exemplar(label, frozenset(t), len(t)))
    return list(out.values())


class Index:
    """Exemplars under their heaviest terms; terms of documents are found by one automaton."""

    def __init__(self, some: list[Exemplar], idf: dict[str, float], usual: float) -> None:
        self.exemplars, self.idf, self.usual = some, idf, usual
        self.totals = [sum(idf[t] for t in e.terms) for e in some]
        self.listed: dict[str, list[int]] = defaultdict(list)
        for k, e in enumerate(some):
            rest = self.totals[k]
            least = COVERAGE * rest
            for t in sorted(e.terms, key=lambda t: (-idf[t], t)):
                if rest < least - 1e-9:
                    break
                self.listed[t].append(k)
                rest -= idf[t]
        # Terms of a label, and those of them that are rare beside the most usual word of their script.
        self.pools: dict[str, set[str]] = defaultdict(set)
        for e in some:
            self.pools[e.label] |= e.terms
        least = {kind: min((w for t, w in idf.items() if (t >= "一") == kind), default=0.0) for kind in (False, True)}
        self.strong = {t for t, w in idf.items() if w >= least[t >= "一"] + math.log(20)}
        self.automaton = ahocorasick.Automaton()
        for t in self.strong | set(self.listed):
            self.automaton.add_word(t, t)
        self.automaton.make_automaton()

    def _weight(self, there: list[str] | set[str]) -> float:
        return sum(self.idf.get(t, self.usual) for t in there)

    def weigh(self, passage: str) -> tuple[str, float] | None:
        """The label and coverage of the exemplars that passage (typed) is residue of, if any."""
        there = terms(passage)
        have = set(there)
        for k in sorted({k for t in have for k in self.listed.get(t, ())}):
            e, total = self.exemplars[k], self.totals[k]
            if self._weight(e.terms & have) < COVERAGE * total or e.whole and self._weight(e.terms & have) < COVERAGE * self._weight(have):
                continue
            if (score := self._best_window(there, e)) >= COVERAGE * total:
                return e.label, score / total
        # Usual words speak neither for nor against residue.
        telling = [t for t in there if t in self.strong or t not in self.idf]
        if len(there) >= POOL_TERMS and len(self.strong & have) >= STRONG_TERMS:
            whole = self._weight(telling)
            for label, pool in self.pools.items():
                known = [t for t in telling if t in pool]
                if len(set(known)) >= STRONG_TERMS and (score := self._weight(known) / whole) >= POOL_COVERAGE:
                    return label, score
        return None

    def _best_window(self, there: list[str], e: Exemplar) -> float:
        """The greatest weight of distinct terms of e in a window of half as many terms again as e has."""
        at = [i for i, t in enumerate(there) if t in e.terms]
        width, best = e.length * 3 // 2 + 2, 0.0
        for x, i in enumerate(at):
            best = max(best, sum(self.idf[t] for t in {there[j] for j in at[x:] if j < i + width}))
        return best

    def residue(self, text: str) -> tuple[str, float] | None:
        text = typed(own_text(text))
        if next(self.automaton.iter(text), None) is None:
            return None
        before, before_listed = "", False
        for passage in PASSAGE.split(text):
            listed = next(self.automaton.iter(passage), None) is not None
            if listed and (found := self.weigh(passage)):
                return found
            # Notices are often broken over two short lines.
            short = len(passage) < SHORT
            if before and short and (listed or before_listed) and (found := self.weigh(f"{before} {passage}")):
                return found
            if passage.strip():
                before, before_listed = (passage, listed) if short else ("", False)
        return None


def term_idf(docs: DataFrame, some: list[Exemplar]) -> tuple[dict[str, float], float]:
    """Inverse document frequencies of the exemplars' terms, and the weight of a term that one document in 100 has."""
    words = sorted({t for e in some for t in e.terms})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for k, t in enumerate(words):
            automaton.add_word(t, k)
        automaton.make_automaton()
        total = np.zeros(len(words) + 1, np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                total[list({k for _, k in automaton.iter(typed(text))})] += 1
            total[-1] += len(pdf)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"k": used, "n": total[used]})

    rows = docs.where(not_blank(F.col("text"))).select("text").mapInPandas(count, "k long, n long").groupBy("k").agg(F.sum("n")).collect()  # as many as terms
    df = dict(map(tuple, rows))
    n = df.get(len(words), 0)
    return {t: math.log((n + 1) / (df.get(k, 0) + 1)) + 0.1 for k, t in enumerate(words)}, math.log(100)


def residue(docs: DataFrame, texts: dict[str, tuple[str, ...]] = EXEMPLARS) -> DataFrame:
    """id, label, coverage of the documents (id, text) that hold residue."""
    some = exemplars(texts)
    docs = docs.where(not_blank(F.col("text")))
    idf, usual = term_idf(docs, some)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(some, idf, usual)
        for pdf in batches:
            rows = [(rid, *hit) for rid, text in zip(pdf["id"], pdf["text"]) if (hit := index.residue(text))]
            yield pd.DataFrame(rows, columns=["id", "label", "coverage"]).astype({"id": "int64", "coverage": "float64"})

    return docs.select("id", "text").mapInPandas(find, "id long, label string, coverage double")


def without_residue(docs: DataFrame, texts: dict[str, tuple[str, ...]] = EXEMPLARS) -> DataFrame:
    """The documents (id, text) that hold no residue, null and blank ones included: dropped where they are read."""
    some = exemplars(texts)
    docs = docs.select("id", "text")
    idf, usual = term_idf(docs, some)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(some, idf, usual)
        for pdf in batches:
            yield pdf[[not t or index.residue(t) is None for t in pdf["text"]]]

    return docs.mapInPandas(keep, "id long, text string")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("id"), "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold residue."""
    return residue(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"))


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without residue."""
    return without_residue(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
