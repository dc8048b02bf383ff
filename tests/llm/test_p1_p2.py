"""Problems 1 and 2, on small tables and against brute force."""

import random
from collections import defaultdict

import pytest

from lexstrata.llm import p1_format_copies as p1
from lexstrata.llm import p2_cross_split as p2
from lexstrata.llm.common import clean_points, clean_python, code_points

LINE = "原告於民國一百年間向被告借款新臺幣壹萬元。"
FIELDS = "案號：100年度訴字第1號；股別：信股；備註：Abc收據、乙"


def lines(*texts, start=1):
    return [{"line_id": i, "line_text": t} for i, t in enumerate(texts, start)]


def test_trie_counts_and_splits():
    trie = p1.CountTrie()
    keys = [b"", b"a", b"a" * 30, b"a" * 31, b"a" * 12, b"a" * 24, b"ab", b"a" * 30]
    for k in keys:
        leaf = trie.terminal(k)
        leaf[1:] = [leaf[1] + 1 if len(leaf) > 1 else 1]
    assert {k: trie.terminal(k)[1] for k in keys} == {k: keys.count(k) for k in keys}


def test_trie_equals_a_dict():
    rng = random.Random(1)
    trie, want = p1.CountTrie(), defaultdict(int)
    for _ in range(3000):
        k = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40)))
        want[k] += 1
        leaf = trie.terminal(k)
        leaf[1:] = [leaf[1] + 1 if len(leaf) > 1 else 1]
    assert all(trie.terminal(k)[1] == n for k, n in want.items())


def test_p1_formats(spark, tables, collect):
    d = tables(
        labelled_lines=lines(LINE, LINE.replace("，", "") + " ", "原告於民國一百年間,向被告借款　新臺幣壹萬元", FIELDS, "股別：信股|備註：ABC收據，乙 ｜案號：100年度訴字第1號", FIELDS.replace("；", "").replace("：", ""), "短句", "短句", None, None, "", "", " "),
        detections=[{"detection_id": 1, "doc_id": 1, "line_text": LINE}, {"detection_id": 2, "doc_id": 2, "line_text": LINE}, {"detection_id": 3, "doc_id": 2, "line_text": LINE + "！"}],
    )
    assert collect(p1.p1_found(spark, d)) == [("detections", 2, 3), ("labelled_lines", 1, 2), ("labelled_lines", 1, 3), ("labelled_lines", 4, 5), ("labelled_lines", 4, 6)]
    assert collect(p1.p1_groups(spark, d)) == [("detections", 2, 2), ("labelled_lines", 1, 3), ("labelled_lines", 4, 3)]


def test_p1_look_alikes_stay_apart(spark, tables, collect):
    d = tables(labelled_lines=lines(LINE, LINE.replace("於", "於​")))
    assert collect(p1.p1_found(spark, d)) == []


def test_p1_buckets_split_and_hot_text(spark, tables, collect):
    """A third of all rows is one text; buckets over 20 rows are split."""
    d = tables(labelled_lines=lines(*([LINE] * 200), *[f"{LINE}{i:04d}" for i in range(200)], *[f"{LINE} {i:04d}。" for i in range(200)]))
    merged = p1.merge(p1.records(spark, d))
    assert merged.count() < 600
    for bucket_rows in (1, 20):
        groups = p1.format_groups(merged, bucket_rows=bucket_rows)
        got = collect(p1.members(merged, groups).where("id <> kept_id").select("kept_id", "id"))
        assert got == sorted([(1, i) for i in range(2, 201)] + [(201 + i, 401 + i) for i in range(200)])
    # A bucket may also be split within its task.
    assert p1._split(merged.toPandas(), 0, 20).drop_duplicates().shape[0] == p1._count_bucket(merged.toPandas()).shape[0]
    got = collect(p1.p1_found(spark, d).select("kept_id", "copy_id"))
    assert got == sorted([(1, i) for i in range(2, 201)] + [(201 + i, 401 + i) for i in range(200)])


@pytest.mark.parametrize("f", [p1.p1_found, p1.p1_groups, p2.p2_found, p2.p2_report])
def test_empty_tables(spark, tables, collect, f):
    assert collect(f(spark, tables())) == []


def test_clean_is_the_same_everywhere(spark):
    from pyspark.sql import functions as F

    from lexstrata.llm.common import cleaned

    texts = ["Ａ b，C。", "İstanbul ΟΔΟΣ", "\U0001f469‍⚖️ x—y", "　\x1f a b", "一|二｜三", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(cleaned(F.col("t"))).collect()] == [clean_python(t) for t in texts]
    assert all((clean_points(t) == code_points(clean_python(t))).all() for t in texts)


def brute_pairs(rows, t=0.7):
    sets = [(i, s == "train", {c[k : k + 2] for k in range(len(c) - 1)}) for i, x, s in rows if x and s and len(c := clean_python(x)) >= 12]
    return sorted((min(i, j), max(i, j)) for k, (i, a, x) in enumerate(sets) for j, b, y in sets[:k] if a != b and len(x & y) >= t * len(x | y))


def test_p2_equals_brute_force(spark, tables, collect):
    rng = random.Random(5)
    words = [a + b for a in "原被告證人法官書記" for b in "甲乙丙丁戊己庚辛"]
    base = ["".join(rng.choice(words) for _ in range(rng.randint(5, 30))) for _ in range(60)]
    rows = []
    for i in range(1, 400):
        x = list(rng.choice(base))
        for _ in range(rng.randint(0, 5)):
            x[rng.randrange(len(x))] = rng.choice("春夏秋冬")
        rows.append((i, "".join(x), rng.choice(["train", "train", "test", "validation", None])))
    rows += [(1000, None, "test"), (1001, "", "train"), (1002, "短句", "train"), (1003, "短句", "test")]
    d = tables(labelled_lines=[{"line_id": i, "line_text": x, "split": s, "source": "q"} for i, x, s in rows])
    want = brute_pairs(rows)
    assert len(want) > 50
    assert collect(p2.p2_found(spark, d)) == want
    # The same with lists of two and three terms, and those cut in blocks.
    classes = p2.line_classes(spark.read.parquet(f"{d}/labelled_lines.parquet"), 12)
    pairs = collect(p2.class_pairs(classes).select("train_cid", "eval_cid"))
    for cap in (1, 5, 20, 60):
        assert collect(p2.class_pairs(classes, cap=cap).select("train_cid", "eval_cid")) == pairs


def test_p2_hot_texts_are_salted(spark, tables, collect):
    """A third of all lines is one text, in both splits."""
    rows = [(i, LINE, "train" if i % 2 else "test") for i in range(60)] + [(100 + i, f"{LINE}{i:05d}另有其他不同的內容", "train") for i in range(120)]
    d = tables(labelled_lines=[{"line_id": i, "line_text": x, "split": s, "source": "q"} for i, x, s in rows])
    lines = spark.read.parquet(f"{d}/labelled_lines.parquet")
    got = p2.members(lines, p2.line_classes(lines, 12), hot_rows=10)
    assert got.where("cid = 0").select("salt").distinct().count() > 2
    assert collect(got.select("line_id")) == [(i,) for i, *_ in rows]
    assert collect(p2.p2_found(spark, d)) == brute_pairs(rows)


def test_p2_report(spark, tables, collect):
    rows = [("train", LINE), ("test", LINE + "！"), ("test", "完全不同的一行文字內容在此處"), ("validation", None), (None, LINE)]
    d = tables(labelled_lines=[{"line_id": i, "line_text": x, "split": s, "source": "q"} for i, (s, x) in enumerate(rows)])
    assert collect(p2.p2_report(spark, d)) == [("test", "q", 2, 1), ("validation", "q", 1, 0)]


def test_tables_in_the_shared_folder_are_dropped(spark):
    from pathlib import Path

    from lexstrata.llm.common import drop_tables, materialize, shared_dir

    drop_tables(spark)
    assert materialize(spark.range(5), "x").count() == 5
    there = lambda: [p for p in Path(shared_dir(spark).removeprefix("file:")).glob("x-*")]
    assert len(there()) == 1 and drop_tables(spark) == 1 and there() == [] and drop_tables(spark) == 0
