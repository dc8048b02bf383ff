"""Random documents of tricky lines: the operators against the SQL, which is written apart from them."""

import random

import pytest
from helpers import same_rows

from lexstrata.functions.symbols import standard_symbols
from lexstrata.plans import registry

LINES = [
    "主文", "主　文", " 主 文", "事實", "理由", "事實及理由", "事　實　及　理　由", "事實與理由", "一、甲", "㈠乙", "Ⅰ丙", "１、丁", "、戊", "", "己", "甲庚", "一、中華民國1年2月3日起", "中　華　民　國　114　年　1　月　2　日",
    "中華民國１１４年１月２日", "附表一", "附 件", "本文事實", "內容", "", "　　", "[甲", "D1 項", "書記官", "總計　 3", "附錄" + "長" * 120,
]
NAMES = [
    "jdg_t1_sections", "jdg_t2_dates", "jdg_t3_structure", "jdg_a13_rules", "jdg_j4_category_levels", "jdg_a14_hierarchy", "jdg_p4_special_markers", "jdg_t4_line_chunks", "jdg_a15_level_content", "jdg_t5_rag_chunks",
    "jdg_t6_machine_tree", "jdg_t7_markdown", "jdg_p9_ultra_strict", "jdg_a10_doc_stats", "jdg_a19_processing_stats", "jdg_a12_batch_totals", "jdg_k2_machine_payload", "jdg_p21_summaries", "jdg_a14_coverage", "jdg_w2_previous_line", "jdg_w1_carry_forward", "jdg_t1_section_stats",
]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    import duckdb

    rng = random.Random(11)
    rows = []
    for i in range(250):
        sep = rng.choice(["\r\n", "\r\n", "\r\n", "\n"])
        lines = [rng.choice(LINES) for _ in range(rng.randint(0, 16))]
        text = "".join(x + (sep if rng.random() < 0.97 else "\n") for x in lines)
        rows.append((i, f"A,{i},易,{i},20250101,1.json", "A", None, None if rng.random() < 0.02 else text, None))
    d = str(tmp_path_factory.mktemp("random"))
    spark.createDataFrame(rows, "doc_id long, file_name string, court string, jid string, jfull string, ingested_at timestamp").write.parquet(f"{d}/judgments.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW judgments AS SELECT * FROM '{d}/judgments.parquet/*.parquet'")
    con.execute("CREATE TABLE symbol_dim (symbol VARCHAR, category VARCHAR)")
    con.executemany("INSERT INTO symbol_dim VALUES (?, ?)", list(standard_symbols().items()))
    return d, con


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, corpus, name):
    d, con = corpus
    same_rows(registry.QUERIES[name](spark, d), con.execute(registry.ORACLE[name]))


def test_lines_are_not_exchanged(spark, corpus):
    """Sections, strict markers, previous lines and document statistics are maps; an analysis exchanges documents once."""
    import re

    d, _ = corpus
    for name in ("jdg_t1_sections", "jdg_p9_ultra_strict", "jdg_w2_previous_line", "jdg_a10_doc_stats", "jdg_t1_section_stats", "jdg_p12_detect"):
        plan = registry.QUERIES[name](spark, d)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Window" not in plan, name
    for name in ("jdg_t4_line_chunks", "jdg_t5_rag_chunks", "jdg_a13_rules"):
        rows = registry.QUERIES[name](spark, d)
        plan = rows._jdf.queryExecution().executedPlan()
        exchanges = re.findall(r"Exchange hashpartitioning\(doc_id#\d+L, \d+\), REPARTITION_BY_COL", plan.toString())
        scans = {re.sub(r"#\d+L?", "", x) for x in re.findall(r"FileScan parquet \[[^]]*\]", plan.toString())}
        assert exchanges and len(scans) == 1, name  # all of one form: Spark runs the first and reuses it
