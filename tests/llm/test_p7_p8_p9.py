"""Problems 7, 8 and 9: against the tokenizer's own library, brute force, written-out cases."""

import os
import random

import numpy as np
import pytest

from lexstrata.llm import p7_encode as p7
from lexstrata.llm import p8_leaks as p8
from lexstrata.llm import p9_residue as p9
from lexstrata.llm.common import clean_python

HAVE = os.path.exists(os.path.join(p7.TOKENIZERS, p7.RANKS))
TEXTS = ["", " ", "主文\r\n原告之訴駁回。", "it's we'll 'RE  x\n\n y", "a" * 3000, "é" * 50, "カタカナ漢字ーの魔 裏覚醒龍喚士", "<|endoftext|>一", "\U0001f469‍⚖️ 甲", "123４５６ 一二Ⅻ㈠", "한국어 テスト", " 商行 Ostdra型", "\x00�"]


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    if not HAVE:
        pytest.skip("no tokenizer files")
    t = tokenizers.Tokenizer.from_file(os.path.join(p7.TOKENIZERS, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture
def mapped(tmp_path):
    """A lexicon of words, in a file of its own."""

    def make(words, ranks):
        path = tmp_path / f"lexicon-{len(list(tmp_path.iterdir()))}"
        path.write_bytes(p7.compile_lexicon(words, ranks))
        return p7.Lexicon(str(path))

    return make


def test_p7_random_texts(library, mapped):
    rng = random.Random(4)
    alphabet = "ab 1'tsé一二三龍喚士裏覚醒金年，。\n　カタの\U0001f469\U00020000ñ"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    ranks = p7.load_ranks(os.path.join(p7.TOKENIZERS, p7.RANKS))
    words = ["一", "二三", " the", "金年", "ab", "abc"]
    for encoder in (p7.Encoder(ranks), p7.Encoder(ranks, mapped([w.encode() for w in words], ranks))):
        assert [np.frombuffer(encoder.encode(t), np.int32).tolist() for t in texts] == library(texts)


def test_p7_lexicon(mapped):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"abc": 301}
    words = [b"ab", b"abc", b"b", b"bc", b"xbc", b"ybc"]
    lexicon = mapped(words, ranks)
    assert {w: lexicon.get(w) for w in words} == {w: p7.merge(w, ranks) for w in words}
    assert lexicon.get(b"a") is None and lexicon.get(b"abcd") is None and lexicon.get(b"") is None
    assert mapped([], ranks).get(b"a") is None
    many = [f"{i:05d}ing".encode() for i in range(2000)]
    lexicon = mapped(many, ranks)
    assert all(lexicon.get(w) == p7.merge(w, ranks) for w in many)
    assert lexicon.first[-1] < 3000  # suffixes are shared


@pytest.mark.skipif(not HAVE, reason="no tokenizer files")
def test_p7_ids(spark, tables, library):
    texts = [*TEXTS, None, "長文" * 300_000]
    d = tables(documents=[{"doc_id": i, "text": t} for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["ids"] for r in p7.p7_ids(spark, d).collect()}
    # A zero character passes through Parquet unchanged.
    assert got == dict(enumerate(library([t or "" for t in texts])))
    assert p7.p7_ids(spark, tables()).count() == 0


def brute_leaks(docs, items, run=40):
    items = {i: clean_python(x) for i, x in items.items() if x}
    out = []
    for d, t in docs.items():
        t = clean_python(t or "")
        out += [(d, i) for i, x in items.items() if any(x[k : k + run] in t for k in range(len(x) - run + 1))]
    return sorted(out)


def test_p8_equals_brute_force(spark, tables, collect, monkeypatch):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("甲乙丙丁戊己庚辛壬癸子丑AbＣ") for _ in range(n))
    items = {i: word(rng.choice([20, 39, 40, 41, 90, 200])) for i in range(12)} | {50: None, 51: "", 52: " ，"}
    items[53] = items[3] = word(100)
    docs = {}
    for d in range(80):
        x = items[rng.choice(list(range(12)))]
        a = rng.randrange(len(x))
        piece = x[a : a + rng.choice([38, 39, 40, 41, 60])]
        docs[d] = word(rng.randint(0, 90)) + rng.choice(["", "，", "\n"]).join(piece) + word(rng.randint(0, 90))
    docs |= {900: None, 901: "", 902: "İΣ\U00020000" + items[3].swapcase(), 903: items[3] * 3, 904: word(100_000)}
    d = tables(documents=[{"doc_id": i, "text": t} for i, t in docs.items()], eval_items=[{"item_id": i, "item_text": t, "split": "test"} for i, t in items.items()])
    want = brute_leaks(docs, items)
    assert len(want) > 20 and (903, 53) in want
    assert collect(p8.p8_found(spark, d)) == want
    frames = spark.createDataFrame(list(docs.items()), "id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert collect(p8.leaks(*frames)) == want
    # The same with bitmaps that are full, and where nothing is small enough to be broadcast.
    monkeypatch.setattr(p8, "MOST_BITS", 6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    assert collect(p8.leaks(*frames)) == want
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["n_docs"] for r in p8.p8_items(spark, d).collect()) == len(want)


@pytest.mark.parametrize("given", [{}, {"documents": [{"doc_id": 1, "text": "x"}]}, {"eval_items": [{"item_id": 1, "item_text": "甲" * 50}]}])
def test_p8_without_rows(spark, tables, collect, given):
    assert collect(p8.p8_found(spark, tables(**given))) == []


RESIDUE = [
    "案號：null\n聲請人：null", "裁判日期：NaN年NaN月NaN日", "主文：#REF!", "TBD TBD TBD", "被上訴人提出漁網${judge}，報酬", "<法院名稱>年度字第號", "原告　[[金額]]", "the%JUDGE% lacquered invoice", "{{ plaintiff }}年度", "支票{0}，故",
    "【請填入金額】", "（此處填寫案號）", "[INSERT DOCKET HERE]", "«案號»", "__AMOUNT__", "@@CLERK@@", "$!amount", "請啟用 JavaScript 以檢視裁判書全文。\n返回查詢", "You need to enable JavaScript to run this app.",
    "系統發生錯誤（代碼 504），請稍後再試。", "您的工作階段已過期，請重新登入後再查詢。[c308bd]", "504 Gateway Timeout\nnginx", "503 Service Unavailable\nnginx", "<html><head><title>429 Too Many Requests</title></head><body><h1>Too Many Requests</h1></body></html>", "Access denied. Your request was blocked (8db0e6).", "Traceback (most recent call last):\n  File \"render.py\"",
    "標題文字標題文字…信函", "理由 Lorem ipsum Tempor labore et consectetur lorem eiusmod amet.", "此處為範例文字，敬請期待。", "真實內容。\n很抱歉，您所查詢的裁判書不存在或已移除。",
]
CLEAN = [
    "原告稱畫面顯示「系統發生錯誤，請稍後再試」字樣，應予駁回。", "證人稱看到「{{ name }}」與『undefined』。", "被告甲○○於審理中（略）", "〔附圖略〕", "（以下空白）原告", "None of the parties appeared.", "圖面錯誤，應予補正。",
    "The sealed manuscript worth 27992 crowns.", "<|endoftext|>主文", "1 < 2 及 3 > 2", "100%的股份", "", " ", "原告請求被告給付新臺幣5003093元。",
]


def test_p9_cases(spark, tables, collect):
    # Enough ordinary documents for the weights of terms to mean something.
    usual = [f"原告第{i}次向被告請求給付，被告則以書面拒絕，證人於驗證程序中到場。The broker quietly surveyed the parcel." for i in range(200)]
    docs = [*RESIDUE, *CLEAN, *usual, None]
    d = tables(documents=[{"doc_id": i, "text": t} for i, t in enumerate(docs)])
    found = {r[0] for r in p9.p9_found(spark, d).collect()}
    assert [t for i, t in enumerate(RESIDUE) if i not in found] == []
    assert [docs[i] for i in found if i >= len(RESIDUE)] == []
    assert p9.p9_clean(spark, d).count() == len(docs) - len(RESIDUE)


# None of these stands among the exemplars.
UNSEEN = [
    "404 Not Found", "We could not find that page.", "Please switch on JavaScript in your browser settings to view this page.", "此網站正在維護", "[Your Name Here]", "<YOUR_NAME>", "{name}", "TODO: write content",
    "請開啟您的 JavaScript 功能後再試一次", "待補。信函\n待補。問卷", "待補…待補…待補…", "Sorry, the page you requested does not exist.", "An internal error occurred. Please try again later.", "Your browser must have JavaScript enabled to continue.",
    "系統發生未預期的錯誤，請重新整理後再試", "您的瀏覽器未啟用 JavaScript，請開啟後重新整理頁面", "your session has timed out, please log in again", "    at com.shop.Cart.add(Cart.java:88)", "{{ " + "x" * 150 + " }}", "頁面不存在或已移除",
]
USUAL = [
    "待補正之鋼材新臺幣一百元", "The page was torn from the ledger and could not be restored by the clerk.", "The server brought the wine, and the court adjourned.", "本院網站之公告，原告於期限內未提出書狀。", "The error of law was not found to be material by the tribunal.",
    "被告請求查詢其帳戶，銀行以系統維護為由拒絕，故原告主張被告違約。", "His name {n} was not read.",
]


def test_p9_unseen_wordings(spark, tables):
    usual = [f"原告第{i}次向被告請求給付，被告則以書面拒絕，證人於驗證程序中到場。The broker quietly surveyed the parcel, and it was not to be sold by him or to us, as if you and I could have that of this." for i in range(400)]
    docs = [*UNSEEN, *USUAL, *usual]
    d = tables(documents=[{"doc_id": i, "text": t} for i, t in enumerate(docs)])
    found = {r[0] for r in p9.p9_found(spark, d).collect()}
    missed = [t for i, t in enumerate(UNSEEN) if i not in found]
    assert len(missed) <= len(UNSEEN) // 10, missed
    assert [docs[i] for i in found if i >= len(UNSEEN)] == []


def test_p9_clean_needs_no_shuffle(spark, tables):
    d = tables(documents=[{"doc_id": 1, "text": None}, {"doc_id": 2, "text": ""}, {"doc_id": 3, "text": "{{ x }}"}, {"doc_id": 4, "text": "\ufdd0原告"}])
    clean = p9.p9_clean(spark, d)
    assert sorted(r[0] for r in clean.collect()) == [1, 2, 4]
    assert "Exchange" not in clean._jdf.queryExecution().executedPlan().toString()


def test_p9_empty(spark, tables, collect):
    assert collect(p9.p9_found(spark, tables())) == []


def test_p9_own_text():
    assert "錯誤" not in p9.own_text("稱「畫面『錯誤』」字樣") and p9.own_text("無引號") == "無引號"
    assert "錯誤" in p9.own_text("未閉合「錯誤")
