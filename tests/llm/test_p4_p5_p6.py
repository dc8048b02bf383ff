"""Problems 4, 5 and 6: invariants, brute force, written-out cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexstrata.llm import p4_pieces as p4
from lexstrata.llm import p5_near_copies as p5
from lexstrata.llm import p6_same_look as p6


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="甲乙，。；\n\r ab.", max_size=400), st.integers(3, 60), st.integers(0, 20))
def test_p4_invariants(text, limit, overlap):
    overlap = min(overlap, limit - 1)
    spans = p4.cut(text, limit, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(b - a <= limit for a, b in spans)
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < c <= b and b < d and b - c == overlap
    back = text[: spans[0][1]] + "".join(text[prev[1] : cur[1]] for prev, cur in zip(spans, spans[1:]))
    assert back == text


def test_p4_prefers_strong_boundaries():
    text = "甲" * 300 + "。\n" + "乙" * 150 + "，" + "丙" * 300
    assert p4.cut(text)[0] == (0, 302)
    text = "甲" * 100 + "\n" + "乙" * 350 + "，" + "丙" * 300
    assert p4.cut(text)[0] == (0, 452)
    assert p4.cut("甲" * 1000)[:2] == [(0, 512), (448, 960)]
    assert p4.cut("\n" * 513)[0] == (0, 512)


def naive_cut(text, limit, overlap):
    """The rule read off the docstring, character by character."""
    close, out, start = "」』”’）)]", [], 0

    def kind(e):
        k = e
        while k and text[k - 1] in close:
            k -= 1
        if e < len(text) and k and text[k - 1] in "。！？!?…；;，,、：:" and text[e] in close:
            return 9
        last, after = text[e - 1], text[e : e + 1]
        if last in "\n\r":
            return 9 if last == "\r" and after == "\n" else 1
        for n, marks in ((2, "。！？!?…"), (3, "；;，,、：:")):
            if k and text[k - 1] in marks:
                return 9 if k == e and after and after in marks else n
        return 9

    def inside(e):
        """Whether e parts marks from what closes them, or from each other."""
        k = e
        while k and text[k - 1] in close:
            k -= 1
        sets = ("。！？!?…", "；;，,、：:")
        return e < len(text) and k > 0 and any(text[k - 1] in s and (text[e] in close or k == e and text[e] in s) for s in sets)

    while len(text) - start > limit:
        top, least = start + limit, start + overlap + 1
        found = None
        for low in (max(start + limit // 2, least), least):
            for most in (1, 2, 3):
                if found is None:
                    found = next((e for e in range(top, low - 1, -1) if kind(e) <= most), None)
        if found is None:  # the last end of a token
            found = next((e for e in range(top, least - 1, -1) if not inside(e)), top)
        out.append((start, found))
        start = out[-1][1] - overlap
    return [*out, (start, len(text))]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="甲乙丙丁，。；」\n", max_size=300), st.integers(10, 60), st.integers(0, 9))
def test_p4_equals_the_naive_rule(text, limit, overlap):
    assert p4.cut(text, limit, overlap) == naive_cut(text, limit, overlap)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n，。", max_size=40), st.integers(450, 2000))
def test_p4_each_piece_repeats_the_last_of_the_one_before(head, n):
    text = head + "x" * n
    spans = p4.cut(text)
    assert all(text[c:d].startswith(text[max(a, b - 64) : b]) and b - c == 64 for (a, b), (c, d) in zip(spans, spans[1:]))


def test_p4_words_stay_whole():
    text = "甲" * 505 + "judgment" + "乙" * 100
    assert p4.cut(text)[0] == (0, 505)


def test_p4_overlap_after_a_short_heading():
    spans = p4.cut("標題\n" + "甲" * 1000)
    assert spans[0] == (0, 512) and all(b - c == 64 for (_, b), (c, _) in zip(spans, spans[1:]))


def test_p4_never_parts_marks():
    text = "a" * 511 + "e\u0301" + "b" * 100
    assert p4.cut(text)[0] == (0, 511)
    assert p4.cut("a" * 511 + "\r\n" + "b" * 100)[0] == (0, 511)


def test_p4_found(spark, tables, collect):
    d = tables(
        rag_chunks=[{"row_id": 1, "content": "甲" * 513, "full_text": "甲" * 512}, {"row_id": 2, "content": None, "full_text": ""}, {"row_id": 3, "content": "\U00020000" * 512, "full_text": "長" * 100_000}],
        line_chunks=[{"row_id": 1, "content_lines": ["x" * 300 + "\r", "y" * 211]}, {"row_id": 2, "content_lines": ["x" * 300 + "\r", "y" * 210]}, {"row_id": 3, "content_lines": []}, {"row_id": 4, "content_lines": None}, {"row_id": 5, "content_lines": ["x" * 600, None]}],
    )
    assert collect(p4.p4_found(spark, d)) == [("line_chunks", "content_lines", 1), ("line_chunks", "content_lines", 5), ("rag_chunks", "content", 1), ("rag_chunks", "full_text", 3)]
    pieces = p4.p4_pieces(spark, d)
    assert pieces.where("size > 512").count() == 0
    assert pieces.where("piece = 0").count() == 11
    assert collect(p4.p4_found(spark, tables())) == []


def judgment(rng, words, n):
    return "".join(rng.choice(words) for _ in range(n))


def brute(texts, t=0.6):
    sets = {}
    for i, x in texts.items():
        x = "".join((x or "").split())
        if x:
            sets[i] = (x, {x[k : k + 5] for k in range(len(x) - 4)})
    out = []
    for i in sets:
        for j in sets:
            if i < j:
                (x, a), (y, b) = sets[i], sets[j]
                if x == y or (a | b and len(a & b) / len(a | b) >= t):
                    out.append((i, j))
    return sorted(out)


def test_p5_equals_brute_force(spark, tables, collect):
    rng = random.Random(8)
    words = [a + b + c for a in "原被證人法官" for b in "於向以經由" for c in "甲乙丙丁戊己"]
    texts = {}
    for i in range(1, 25):
        base = [rng.choice(words) for _ in range(rng.choice([4, 30, 300]))]
        texts[i * 10] = "".join(base)
        for k in range(1, rng.randint(2, 6)):
            x = list(base)
            for _ in range(int(len(x) * rng.choice([0, 0.02, 0.1, 0.2]))):
                x[rng.randrange(len(x))] = rng.choice(words)
            cut = rng.randrange(len(x))
            texts[i * 10 + k] = " ".join(x[cut:] + x[:cut]) if rng.random() < 0.5 else "\r\n".join(x)
    texts |= {900: None, 901: "", 902: " \r\n", 903: "甲乙", 904: "甲 乙", 905: "甲丙"}
    d = tables(judgments=[{"doc_id": i, "jfull": x} for i, x in texts.items()])
    want = brute(texts)
    got = collect(p5.p5_found(spark, d))
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want) and (903, 904) in got and len(want) > 30
    rows = {r["doc_id"]: r for r in p5.p5_groups(spark, d).collect()}
    assert set(rows) == {i for i, x in texts.items() if x and x.strip()}
    assert all(rows[a]["group_id"] == rows[b]["group_id"] for a, b in got)
    assert rows[904]["class_id"] == 903 and rows[903]["n_links"] == 0


def test_p5_recall_at_the_threshold():
    """Exact, for MinHash values that agree independently: d of k differ, and 2d throws make the bits odd."""
    import inspect
    import math

    margin = inspect.signature(p5.near_copies).parameters["margin"].default
    most = math.floor(p5.BITS / 2 * (1 - math.exp((p5.THRESHOLD - margin - 1) * 4 * p5.K / p5.BITS)))
    odd, over = np.zeros(p5.BITS + 1), []
    odd[0], up = 1.0, np.arange(p5.BITS + 1) / p5.BITS
    for _ in range(2 * p5.K + 1):
        over.append(odd[most + 1 :].sum())
        odd = np.append(0, (odd * (1 - up))[:-1]) + np.append((odd * up)[1:], 0)
    t = p5.THRESHOLD
    lost = sum(math.comb(p5.K, d) * (1 - t) ** d * t ** (p5.K - d) * over[2 * d] for d in range(p5.K + 1))
    assert lost + (1 - t**p5.ROWS) ** (p5.K // p5.ROWS) < 2e-4, lost
    assert most == p5.most_apart(t - margin)


def test_p5_blocks_of_big_buckets(spark):
    first = p5.sketches(spark.createDataFrame([(i, "同一判決全文內容" * 20 + f"尾{i:03d}") for i in range(40)], "id long, text string"))
    want = [(i, j) for i in range(40) for j in range(i + 1, 40)]
    assert sorted(map(tuple, p5.candidates(first, 0.4, hot_rows=7).collect())) == want


def test_p5_components_of_a_path(spark):
    n = 40
    nodes = spark.createDataFrame([(i,) for i in range(n + 2)], "id long")
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(n - 1)], "a long, b long, jaccard double")
    got = {r["id"]: r["group_id"] for r in p5.components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(n)) and got[n] == n and got[n + 1] == n + 1
    assert p5.components(nodes, edges.limit(0)).where("id <> group_id").count() == 0


def test_p5_estimates():
    rng = np.random.default_rng(1)
    for share in (0.6, 0.75, 0.9):
        errors = []
        for _ in range(20):
            n = 2000
            both = int(n * 2 * share / (1 + share))
            pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
            a, b = pool[:n], np.concatenate([pool[:both], pool[n : 2 * n - both]])
            x, y = (p5.odd_sketch(p5.minhash(s)) for s in (a, b))
            errors.append(p5.estimate(int(np.bitwise_count((x ^ y).view(np.uint64)).sum())) - share)
        assert abs(np.mean(errors)) < 0.05 and max(map(abs, errors)) < 0.2


SAME = [
    ("ＡＢＣ１２３，：", "ABC123,:"), ("a\u00a0b", "a b"), ("a\u3000b", "a b"), ("a\u2009b\u202fc", "a b c"), ("a\u200bb\ufeffc\u2060d\u00ad", "abcd"), ("e\u0301", "\u00e9"), ("e\u200b\u0301", "\u00e9"),
    ("\u2f08\u2f47\uf90a\uf98e", "人日金年"), ("\u0410\u0412\u0415\u03bf\u03c1", "ABEop"), ("\u03bf\u0301", "\u00f3"), ("\u03cc", "\u00f3"), ("\u2ea0", "民"), ("葛\ufe00", "葛"), ("\uff71\uff9e", "ア\u3099"),
    ("\uff64\uff61", "、。"), ("\u0041\u030a", "\u00c5"), ("\u212b", "\u00c5"), ("a\u0323\u0302", "a\u0302\u0323"),
]
APART = [("㈠", "(一)"), ("Ⅰ", "I"), ("①", "1"), ("A", "a"), ("a b", "ab"), ("ab ", "ab"), ("a\r\nb", "a\nb"), ("a\tb", "a b"), ("a  b", "a b"), ("\u00e9", "e"), ("⑴", "(1)")]


@pytest.mark.parametrize("a, b", SAME)
def test_p6_same_look(a, b):
    assert p6.canonical(a) == p6.canonical(b)


@pytest.mark.parametrize("a, b", APART)
def test_p6_apart(a, b):
    assert p6.canonical(a) != p6.canonical(b)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ae\u00e9\u0301\u0323\u200bＡ\u0410\uf90a\u2f08㈠Ⅰ１、 \u3000\n一\U0002f800\u03cc", max_size=40))
def test_p6_idempotent(text):
    once = p6.canonical(text)
    assert p6.canonical(once) == once


def test_p6_markers_survive():
    assert p6.canonical("１、甲 １２３") == "１、甲 123" == p6.canonical("1、甲 123")
    assert p6.canonical("㈠、⑴Ⅻ①、") == "㈠、⑴Ⅻ①、"


def test_p6_found(spark, tables, collect):
    d = tables(
        judgments=[{"doc_id": 1, "jfull": "主文Ａ"}, {"doc_id": 2, "jfull": "主文A"}, {"doc_id": 3, "jfull": "主文A"}, {"doc_id": 4, "jfull": None}, {"doc_id": 5, "jfull": "　"}, {"doc_id": 6, "jfull": " "}, {"doc_id": 7, "jfull": ""}],
        detections=[{"detection_id": i, "doc_id": doc, "line_text": t} for i, (doc, t) in enumerate([(1, "甲 乙"), (1, "甲　乙"), (2, "甲 乙"), (1, None), (1, "")])],
    )
    assert collect(p6.p6_found(spark, d)) == [("detections", 0, 1), ("judgments", 1, 2), ("judgments", 1, 3)]
    assert collect(p6.p6_found(spark, tables())) == []
