"""Written-out cases of sections, dates, detection, chunks, retrieval chunks and Markdown. ⏎ is CR LF, □ an ideographic space."""

import itertools
import random

import pytest

from lexstrata.functions import symbols as S
from lexstrata.operators import chunks as C
from lexstrata.operators import detect as D
from lexstrata.operators import markdown as M
from lexstrata.operators import rag as R
from lexstrata.operators import sections as P
from lexstrata.operators import structure as L
from lexstrata.plans.pipeline import Analysis

PLAIN = "法院判決⏎主□文⏎被告無罪。⏎事□實⏎一、甲事⏎㈠細節⏎二、乙事⏎理□由⏎一、論述⏎中□華□民□國□114□年□1□月□2□日"


def text(s):
    return s.replace("⏎", "\r\n").replace("□", "　")


@pytest.fixture(scope="module")
def docs(spark):
    def make(*texts):
        return spark.createDataFrame([(i, f"f{i}.json", text(t) if t is not None else None) for i, t in enumerate(texts)], "doc_id long, file_name string, jfull string")

    return make


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_symbol_dictionary():
    table = S.standard_symbols()
    assert len(table) == 115
    assert table["參"] == "大寫中文數字" and table["⓪"] == "帶圈數字" and table["Ⅻ"] == "羅馬數字" and table["９"] == "全形數字"


@pytest.mark.parametrize(
    "cp, group",
    [(0xF57F, "PUA_全形阿拉伯數字_圈圈"), (0xF585, "PUA_全形阿拉伯數字_句號"), (0xF5E9, "全形數字"), (0xF64D, "PUA_小寫中文數字_頓號"), (0xF6C5, "PUA_羅馬數字"), (0xE000, S.UNGROUPED), (0xF0001, S.UNGROUPED), (0x4E00, None)],
)
def test_private_use_groups(spark, cp, group):
    df = spark.createDataFrame([(chr(cp),)], "c string")
    assert df.select(S.pua_group(df.c)).first()[0] == group


def test_sections_plain(docs):
    got = sorted(rows(P.split_sections(docs(PLAIN)), "section", "pos", "line"))
    assert [x[0] for x in got] == ["facts"] * 4 + ["footer", "header", "main_text", "main_text", "reasons", "reasons"]
    assert ("main_text", 1, "被告無罪。") in got


def test_sections_combined_are_copied_to_facts(docs):
    got = rows(P.section_stats(docs("主文⏎事實及理由⏎一、甲")), "n_facts", "n_reasons", "n_facts_and_reasons")
    assert got == [(2, 0, 2)]


def test_prose_switches_section(docs):
    got = rows(P.section_stats(docs("事實及理由⏎本件事實如下⏎乙")), "n_facts_and_reasons", "n_facts")
    assert got == [(1, 2)]


def test_newline_only_text_is_one_section_line(docs):
    d = docs("主文\n一、甲\n理由", "理由\n一、甲")
    got = dict((r["doc_id"], (r["learning_region"], r["learn_start"])) for r in L.file_structure(d).collect())
    assert got == {0: ("全文", 0), 1: ("R-D", None)}
    assert rows(Analysis(d).rules.where("doc_id = 1"), "doc_id") == []


def test_dates(docs):
    got = rows(P.extract_dates(docs("中華民國１１４年１月２日⏎中​華民國114年3月4日⏎民國99年1月1日⏎中華日報說民國100年5月6日")), "year", "month", "day")
    assert sorted(got) == [("100", "5", "6"), ("114", "3", "4"), ("１１４", "１", "２")]


def test_detection_methods(docs):
    d = docs("一、甲⏎、乙⏎丙⏎　⏎Ⅰ丁⏎戊己⏎庚⏎是")
    got = rows(D.detect(d).orderBy("line_number"), "method_used", "symbol_category", "final_prediction")
    assert got == [
        ("soft_rule_only", "中文數字", True), ("ultra_strict_pua", "PUA_羅馬數字", True), ("rule_rejected", None, False), ("empty_line", None, False), ("soft_rule_only", "羅馬數字", True),
        ("soft_rule_only", "天干", True), ("soft_rule_only", "天干", True), ("rule_rejected", None, False),
    ]


def test_scorer_sees_only_soft_candidates(spark, docs):
    from pyspark.sql import functions as F

    d = docs("一、甲⏎、乙⏎二、丙丙丙丙⏎丁1")
    scorer = lambda c: F.assert_true(c.rlike("^[一二丁]"), F.lit("not a candidate")).cast("double").isNull().cast("double") * F.when(F.length(c) > 3, 0.9).otherwise(0.1)
    got = rows(D.detect(d, scorer).orderBy("line_number"), "method_used", "bert_score", "final_prediction")
    assert got == [("soft_rule_bert", 0.1, False), ("ultra_strict_pua", 1.0, True), ("soft_rule_bert", 0.9, True), ("soft_rule_bert", 0.1, False)]


def test_ultra_strict_needs_a_carriage_return_before(docs):
    assert [r[0] for r in rows(D.ultra_strict(docs("一、甲\n二、乙⏎三、丙")).orderBy("line_number"), "symbol")] == ["一", "三"]


def test_levels_by_first_appearance(docs):
    got = rows(D.hierarchy_levels(D.detect(docs("㈠甲⏎一、乙⏎㈡丙⏎Ⅰ丁"))).orderBy("level"), "symbol_category", "level", "count")
    assert got == [("圍字數字", 1, 2), ("中文數字", 2, 1), ("羅馬數字", 3, 1)]


def test_unlearned_category_has_two_levels(docs):
    a = Analysis(docs("Ⅰ前言⏎主文⏎理由⏎一、甲⏎Ⅱ後"))
    assert rows(a.rules.orderBy("assigned_level"), "symbol_category", "assigned_level") == [("中文數字", 1), ("羅馬數字", 2)]
    a = Analysis(docs("主文⏎Ⅰ前言⏎理由⏎一、甲"))
    assert rows(a.levels.orderBy("assigned_level"), "symbol_category", "assigned_level", "is_learned") == [("中文數字", 1, True), ("羅馬數字", 2, False)]
    assert rows(a.chunks.where("leveling_symbol = 'Ⅰ'"), "level") == [(1,)]


def chunk_ids(a):
    return [r[0] for r in rows(a.chunks.orderBy("seq"), "chunk_id")]


def test_chunks_plain(docs):
    assert chunk_ids(Analysis(docs(PLAIN))) == ["header", "main_text_1", "content_2_2", "facts_3", "level_1_4", "level_1_5", "level_1_6", "reasons_7", "level_1_8", "date_9"]


def test_tail_stands_twice(docs):
    a = Analysis(docs("主文⏎句句⏎中華民國1年2月3日⏎尾"))
    assert chunk_ids(a) == ["main_text_0", "content_1_1", "date_2", "content_3_3", "footer"]


def test_signature_and_early_date(docs):
    a = Analysis(docs("主文⏎中華民國1年2月3日⏎法官⏎中華民國1年2月4日"))
    assert chunk_ids(a) == ["main_text_0", "date_1", "signature", "date_3"]
    a = Analysis(docs("中華民國1年2月3日⏎題⏎主文⏎句⏎中華民國1年2月4日"))
    assert chunk_ids(a) == ["header", "main_text_2", "date_4"]


def test_appendix(docs):
    a = Analysis(docs("主文⏎中華民國1年2月3日⏎附表一⏎項目⏎一、略⏎附表二⏎總計⏎理由⏎後"))
    assert chunk_ids(a) == ["main_text_0", "date_1", "appendix_2", "content_3_3", "appendix_5", "content_6_6"]


def test_dated_symbol_line_gives_two_chunks(docs):
    assert chunk_ids(Analysis(docs("主文⏎一、中華民國1年2月3日起"))) == ["main_text_0", "date_1", "level_1_1"]


def test_rag_titles_and_locations(docs):
    got = rows(Analysis(docs(PLAIN)).rag.orderBy("seq"), "chunk_type", "title", "location", "parent_titles")
    assert ("hierarchical_section", "㈠細節", "F", [text("事□實")]) in got
    assert got[0][:3] == ("header", "HEADER", "H") and got[-1][:3] == ("date", "DATE", "D1")


def test_rag_content_belongs_to_symbol(docs):
    got = rows(Analysis(docs("主文⏎一、甲⏎內容 一⏎內容二⏎㈠乙")).rag.orderBy("seq"), "chunk_id", "end_line", "full_text", "content")
    assert got[1] == ("level_1_1", 4, "一、甲內容一內容二", "內容 一\n\n內容二\n")


def stack_ancestors(levels):
    out, stack = [], []
    for seq, lv in enumerate(levels):
        if lv >= 0:
            while stack and stack[-1][0] >= lv:
                stack.pop()
            out.append([s for _, s in stack])
            stack.append((lv, seq))
        else:
            out.append([s for _, s in stack])
    return out


def test_ancestors_equal_a_stack(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    seqs = [[rng.choice([-3, -2, -1, 0, 1, 2, 3, 4]) for _ in range(rng.randint(1, 14))] for _ in range(300)]
    data = [(d, s, lv) for d, seq in enumerate(seqs) for s, lv in enumerate(seq)]
    df = R.with_ancestors(spark.createDataFrame(data, "doc_id long, seq long, level long"), F.lit("t"))
    got = {(r[0], r[1]): [a["seq"] for a in r[2]] for r in df.select("doc_id", "seq", "ancestors").collect()}
    for d, seq in enumerate(seqs):
        assert [got[d, s] for s in range(len(seq))] == stack_ancestors(seq)


def test_markdown_numbering(spark):
    chunks = [(1, "一、甲"), (2, "㈠乙"), (2, "㈡丙"), (3, "⑴丁"), (1, "二、戊"), (-2, "中華民國114年1月2日"), (2, "㈢己")]
    df = spark.createDataFrame([(1, i, lv, "leveling_symbol" if lv > 0 else "date", [t + "\r"]) for i, (lv, t) in enumerate(chunks)], "doc_id long, seq long, level long, chunk_type string, content_lines array<string>")
    files = spark.createDataFrame([(1, "a.json", "全文")], "doc_id long, file_name string, learning_region string")
    got = M.to_markdown(df, files).first()["markdown"].split("\n")
    assert got == ["# a.json", "- learning_region: 全文", "", "1. 一、甲", "", "    1. ㈠乙", "", "    2. ㈡丙", "", "        1. ⑴丁", "", "2. 二、戊", "", "## 中華民國114年1月2日", "", "    1. ㈢己", ""]


def test_content_near_marks_is_left_out(spark):
    df = spark.createDataFrame([(1, 0, -1, "content", ["甲"]), (1, 1, -1, "content", ["見 d1 項"])], "doc_id long, seq long, level long, chunk_type string, content_lines array<string>")
    assert rows(M.chunk_markdown(df).orderBy("seq"), "block") == [(None,), (["見 d1 項", ""],)]


def test_nulls_empties_and_empty_tables(docs, spark):
    a = Analysis(docs(None, "", "　", "\r\n\r\n"))
    assert {r[0] for r in rows(a.found, "method_used")} == {"empty_line"}
    assert sorted({r[0] for r in rows(a.chunks, "doc_id")}) == [1, 2, 3]
    empty = Analysis(docs("甲").limit(0))
    for frame in (empty.found, empty.rules, empty.chunks, empty.rag, empty.tree, empty.markdown, empty.processing_stats, empty.payload):
        assert frame.count() == 0


def test_extra_columns_do_not_clash(docs):
    from pyspark.sql import functions as F

    names = ["idx0", "raw", "label", "section", "symbol", "category", "level", "seq", "marker", "n", "text", "count", "anchors"]
    d = docs(PLAIN).withColumns({c: F.lit("x") for c in names})
    assert chunk_ids(Analysis(d)) == chunk_ids(Analysis(docs(PLAIN)))
    assert rows(P.section_stats(d), "n_facts") == [(4,)]


def test_repeated_documents_do_not_mix(docs):
    a = Analysis(docs(*itertools.repeat(PLAIN, 3)))
    assert a.chunks.groupBy("doc_id").count().select("count").distinct().count() == 1


def test_very_long_document(docs):
    n = 3_000
    a = Analysis(docs("主文⏎" + "⏎".join(f"一、第{i}點⏎內容" for i in range(n))))
    assert a.chunks.count() == 2 * n + 1
