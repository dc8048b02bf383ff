"""Problem 3: written-out texts, held-out judgments, placeholders."""

import re

import pytest
from helpers import DATA

from lexstrata.llm import p3_personal as p3

CASES = [
    ("被告　緱璦熹\r\n　　住霧坪縣塢嵐里２１鄰鶴濤街７４０號２１樓之５\r\n", [("name", "緱璦熹"), ("address", "霧坪縣塢嵐里２１鄰鶴濤街７４０號２１樓之５")]),
    ("訴訟代理人：朵薇‧帛雷娜", [("name", "朵薇‧帛雷娜")]),
    ("子芮蘇·蘇雷薇從未聲明分割後之補償金", [("name", "芮蘇·蘇雷薇")]),
    ("VornubTesloklok隨即塗銷受潮之溝渠，Vornub Dramukost 商行鑑價。", [("name", "VornubTesloklok")]),
    ("其信箱kel+lok@dra.nub.test所收，附檔寄至mir+dac(at)mir-yel.example後，ｙｅｌ＠ｐｒｉ－ｖｏｒ．ｏｒｇ", [("email", "kel+lok@dra.nub.test"), ("email", "mir+dac(at)mir-yel.example"), ("email", "ｙｅｌ＠ｐｒｉ－ｖｏｒ．ｏｒｇ")]),
    ("電話：06-1439437，（+886-993-884-234），撥打0995 412 011詢問，持用門號（０８）１６１８６７７，TEL0990018149", [("phone", "06-1439437"), ("phone", "+886-993-884-234"), ("phone", "0995 412 011"), ("phone", "（０８）１６１８６７７"), ("phone", "0990018149")]),
    ("身分證字號Ｇ２５４６４９１６４遭冒用，居留證號AB12345678，發票號碼BX20027423，證號C12345****", [("id_number", "Ｇ２５４６４９１６４"), ("id_number", "AB12345678")]),
    ("送達No. 152, Ln. 32, Vorhov Rd., Kelsol City遭退回", [("address", "No. 152, Ln. 32, Vorhov Rd., Kelsol City")]),
    ("No.152,Ln.32,VorhovRd.,KelsolCity之房屋", [("address", "No.152,Ln.32,VorhovRd.,KelsolCity")]),
    ("杉潭縣溪霧段801地號土地，帳號142799012775，統一編號53203713，新臺幣7,299,325元，專線0800（空號）", []),
    ("帳號0912345678901，建號078060041，序號 091234567890", []),
    ("worth 67287 crowns.YelhovMirmirsol嗣後延展漏列之訂金", [("name", "YelhovMirmirsol")]),
    ("被告甲○○，霧坪地方法院，Primirost公司，MUKBEL型土地", []),
    ("", []),
]


@pytest.mark.parametrize("text, want", CASES)
def test_cases(text, want):
    assert [(c.type, text[c.start : c.end]) for c in p3.entities(text)] == want


PROBES = [
    ("原告 王小明", "王小明"), ("被告陳大文於昨日到庭。", "陳大文"), ("證人林美華證稱屬實。", "林美華"), ("Mr John Smith lives at 12 Main St.", "John Smith"), ("上訴人：林志豪", "林志豪"), ("證人張美玲證稱：當日在場。", "張美玲"),
    ("選任辯護人　黃國華律師", "黃國華"), ("聲請人　周建平\r\n相對人　吳淑芬", "周建平"), ("書記官　蔡佳慧", "蔡佳慧"),
]


@pytest.mark.parametrize("text, name", PROBES)
def test_ordinary_names(text, name):
    """Names that share no character with those of the sample that the weights were trained on."""
    assert ("name", name) in [(c.type, text[c.start : c.end]) for c in p3.entities(text)]


def test_names_of_unseen_characters(duck):
    """Judgments with their names replaced by common surnames and given names of other characters: at least 0.9 are found."""
    import random

    from lexstrata.llm import p3_train

    rng, found, want = random.Random(3), 0, 0
    surnames = "陳林黃張李王吳劉蔡楊許鄭謝郭洪邱"
    given = "琪瑋晴皓蓁瑜璇霖翊瑩筠儒睿綺禎鈺"
    for (text,) in duck.execute("SELECT jfull FROM judgments WHERE jfull IS NOT NULL").fetchall():
        for old in p3_train.names_of(text):
            if re.fullmatch("[一-鿿]{3}", old):
                new = rng.choice(surnames) + rng.choice(given) + rng.choice(given)
                text = text.replace(old, new)
                want += text.count(new)
                found += sum(text[c.start : c.end] == new for c in p3.entities(text))
    assert want > 30 and found >= 0.9 * want, (found, want)


def test_likelihood_is_that_of_all_segmentations():
    """The forward and backward sums against every set of segments without overlap."""
    import itertools
    import math
    import random

    from lexstrata.llm.p3_train import likelihood

    rng = random.Random(4)
    for _ in range(60):
        spans = sorted({(a, a + rng.randint(1, 4)) for a in [rng.randint(0, 8) for _ in range(6)]}, key=lambda x: (x[1], x[0]))
        scores, touch = [rng.uniform(-2, 2) for _ in spans], rng.uniform(-1, 1)
        z, mass, pairs = 0.0, [0.0] * len(spans), 0.0
        for n in range(len(spans) + 1):
            for some in itertools.combinations(range(len(spans)), n):
                if all(spans[i][1] <= spans[j][0] or spans[j][1] <= spans[i][0] for i, j in itertools.combinations(some, 2)):
                    beside = sum(spans[i][1] == spans[j][0] for i in some for j in some)
                    w = math.exp(sum(scores[i] for i in some) + touch * beside)
                    z, pairs = z + w, pairs + w * beside
                    for i in some:
                        mass[i] += w
        got, prob, expected = likelihood(spans, scores, touch)
        assert abs(got - math.log(z)) < 1e-9 and abs(expected - pairs / z) < 1e-9
        assert all(abs(p - m / z) < 1e-9 for p, m in zip(prob, mass))


def test_batches_are_the_same_as_texts():
    texts = [t for t, _ in CASES]
    want = [[(c.type, t[c.start : c.end]) for c in p3.entities(t)] for t in texts]
    assert list(p3.batch_entities(texts)) == want and list(p3.batch_entities(texts, at_once=30)) == want


def test_redaction_keeps_the_rest():
    assert p3.redact("被告　緱璦熹\r\n電話：06-1439437。") == "被告　[NAME]\r\n電話：[PHONE]。"
    assert p3.redact("沒有個人資料的文字。") == "沒有個人資料的文字。"


def test_decoding_is_optimal():
    """The program against all subsets without overlap."""
    import itertools
    import random

    rng = random.Random(2)
    for _ in range(200):
        some = [p3.Candidate(a, a + rng.randint(1, 6), "name", (f"w{i}",)) for i in range(7) for a in [rng.randint(0, 12)]]
        weights = {f"w{i}": rng.uniform(-1, 3) for i in range(7)} | {"touch": rng.uniform(-2, 1)}

        def score(cs, weights=weights):
            return sum(weights[c.features[0]] for c in cs) + weights["touch"] * sum(x.end == y.start for x in cs for y in cs)

        best = 0.0
        for n in range(8):
            for cs in itertools.combinations(some, n):
                if all(x.end <= y.start or y.end <= x.start for x, y in itertools.combinations(cs, 2)):
                    best = max(best, score(cs))
        got = p3.decode(some, weights)
        assert abs(score(got) - best) < 1e-9 and got == sorted(got, key=lambda c: c.start)


def test_long_text_and_repeats():
    text = "緱璦熹逐一主張。" * 20_000
    assert len(p3.entities(text)) == 20_000


def test_p3_found(spark, tables, collect):
    d = tables(
        judgments=[{"doc_id": 1, "jfull": "被告　緱璦熹\r\n證人：緱璦熹"}, {"doc_id": 2}, {"doc_id": 3, "jfull": ""}, {"doc_id": 4, "jfull": " "}],
        rag_chunks=[{"row_id": 9, "full_text": "電話：06-1439437"}, {"row_id": 10}],
    )
    assert collect(p3.p3_found(spark, d)) == [("judgments", 1, "name", "緱璦熹"), ("rag_chunks", 9, "phone", "06-1439437")]
    got = {(r[0], r[1]): r[2] for r in p3.p3_redacted(spark, d).collect()}
    assert got["judgments", 1] == "被告　[NAME]\r\n證人：[NAME]" and got["judgments", 2] is None and got["judgments", 3] == ""
    assert collect(p3.p3_found(spark, tables())) == []


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_held_out_names(duck):
    """Names behind roles in documents that training didn't see: nearly all are found, and nothing but names."""
    role = re.compile(r"(?m)^[ 　]*(?:被[ 　]*告|原[ 　]*告|證[ 　]*人|上訴人|公訴人|聲請人|訴訟代理人)(?:[：:][ 　]*|[ 　]+)([^\s○：，。]{2,8})\r?$")
    found = want = 0
    for (text,) in duck.execute("SELECT jfull FROM judgments WHERE jfull IS NOT NULL").fetchall():
        names = {text[c.start : c.end] for c in p3.entities(text) if c.type == "name"}
        for n in role.findall(text):
            want += 1
            found += n in names
    assert want > 10 and found >= 0.95 * want
