"""Readers, writers, reports, streaming, models."""

import json

import pytest

from lexstrata.operators import evaluate as E
from lexstrata.operators import stats as A
from lexstrata.plans import pipeline, reports
from lexstrata.sources import readers, writers
from lexstrata.streaming import judgment_stream

TEXT = "法院判決\r\n主文\r\n一、甲\r\n內容\r\n中華民國114年1月2日"


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    (d / "sub").mkdir(parents=True)
    (d / "sub" / "no.json").write_text("{}", encoding="utf-8")
    for name, data in {"A,111,易,1,20250113,1.json": {"JFULL": TEXT, "JID": "A"}, "B,112,訴,2,20250113,1.json": {"JFULL": TEXT}, "C.json": {"JID": "x"}, "D.json": {"JFULL": None}}.items():
        (d / name).write_text(json.dumps(data, ensure_ascii=False), encoding="utf-8")
    (d / "E.json").write_text("{broken", encoding="utf-8")
    (d / "F.txt").write_text("no", encoding="utf-8")
    return d


def test_judgment_files(spark, folder):
    rows = {r["file_name"]: r for r in readers.judgment_files(spark, str(folder)).collect()}
    assert sorted(rows) == ["A,111,易,1,20250113,1.json", "B,112,訴,2,20250113,1.json", "C.json", "D.json", "E.json"]
    assert rows["C.json"]["error"] == "No JFULL field found"
    assert rows["D.json"]["error"].startswith("Error processing") and rows["E.json"]["error"].startswith("Error processing")
    assert rows["B,112,訴,2,20250113,1.json"]["jid"] == "Unknown" and rows["A,111,易,1,20250113,1.json"]["jfull"] == TEXT
    assert readers.judgment_files(spark, str(folder), max_files=2).count() == 2


def test_process_directory(spark, folder, tmp_path):
    out = tmp_path / "out"
    pipeline.process_directory(spark, str(folder), str(out))
    docs = [json.loads(x) for p in (out / "machine").glob("*.json") for x in p.read_text(encoding="utf-8").splitlines()]
    assert len(docs) == 2 and docs[0]["processing_stats"]["rag_chunks_count"] == len(docs[0]["rag_chunks"])
    assert len(list((out / "markdown").glob("*.md"))) == 2
    report = "".join(p.read_text(encoding="utf-8") for p in (out / "report").glob("*.txt"))
    assert "## Regions" in report and "No JFULL field found" in report


def test_all_errors_are_reported(spark, folder, tmp_path):
    for i in range(60):
        (folder / f"bad{i}.json").write_text("{broken", encoding="utf-8")
    out = tmp_path / "out"
    pipeline.process_directory(spark, str(folder), str(out))
    report = "".join(p.read_text(encoding="utf-8") for p in (out / "report").glob("*.txt"))
    assert "| Error processing | 62 |" in report and "| No JFULL field found | 1 |" in report
    rows = {r["file_name"]: r["error"] for r in spark.read.json(str(out / "errors")).collect()}
    assert len(rows) == 63 and rows["bad7.json"] == "Error processing: not a JSON object" and rows["D.json"] == "Error processing: JFULL is null"


def test_tables_are_written_whole(spark):
    assert writers.table_text("T", spark.range(60).orderBy("id")).endswith("| 59 |\n")


def test_machine_results_round_trip(spark, folder, tmp_path):
    out = tmp_path / "m"
    out.mkdir()
    chunk = {"chunk_id": "s", "chunk_type": "hierarchical_section", "level": 1, "start_line": 3, "end_line": 4, "title": "一、甲", "content": "x\ny"}
    (out / "a.json").write_text(json.dumps([{"filename": "a", "learning_region": "全文", "rag_chunks": [chunk, {"content": "z"}]}], ensure_ascii=False), encoding="utf-8")
    (out / "b.json").write_text("[]", encoding="utf-8")
    (out / "c.json").write_text(json.dumps({"filename": "c", "line_based_chunks": [{"level": 2, "content_lines": ["q"]}]}), encoding="utf-8")
    rows = sorted((r["filename"], r["seq"], r["level"], r["chunk_type"], r["content_lines"], r["error"]) for r in readers.machine_results(spark, str(out)).fillna(-9, ["seq"]).collect())
    assert ("a", 0, 1, "hierarchical_section", ["一、甲", "x", "y"], None) in rows and ("a", 1, -1, "content", ["z"], None) in rows
    assert ("c", 0, 2, "content", ["q"], None) in rows and any(r[0] == "b.json" and r[5] == "no chunks" for r in rows)


def test_labelled_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text('line_text,sentiment\n"一、甲\n乙",Positive\n丙,Negative\n', encoding="utf-8")
    assert [tuple(r) for r in readers.labelled_csv(spark, str(tmp_path / "x.csv")).collect()] == [("一、甲\n乙", "Positive"), ("丙", "Negative")]


def test_class_files_and_corpus_report(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", TEXT), (2, "b", None), (3, "c", "")], "doc_id long, file_name string, jfull string")
    stats = A.doc_stats(docs)
    assert {r["doc_id"]: r["symbol"] for r in stats.collect()} == {1: "MD1", 2: "ERROR", 3: "N"}
    writers.write_by_class(stats, str(tmp_path / "c"))
    assert sorted(p.name for p in (tmp_path / "c").glob("symbol=*")) == ["symbol=ERROR", "symbol=MD1", "symbol=N"]
    assert "## Classes" in reports.corpus_report(docs)


def test_corpus_report_lists_years_and_courts_in_full(spark):
    docs = spark.createDataFrame([(i, f"court{i % 40:02},{60 + i % 35},type{i % 12:02},1,20250113,1.json", TEXT) for i in range(840)], "doc_id long, file_name string, jfull string")
    report = reports.corpus_report(docs)
    assert all(f"| court{i:02} | 21 |" in report for i in range(40)) and all(f"| {60 + i} | 24 |" in report for i in range(35))
    assert all((f"| type{i:02} | 70 |" in report) == (i < 10) for i in range(12))
    assert "## Case types left out\n\n| types |\n| --- |\n| 2 |\n" in report


def test_upper_median(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(v, 1) for v in (1, 2, 3, 4)] + [(9, 0)], "v long, c long")
    assert df.agg(A.histogram_median(F.col("v"), F.col("c"))).first()[0] == 3


def test_metrics_with_ties_and_nothing(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.9), (1.0, 0.0, 0.5), (0.0, 1.0, 0.5), (0.0, 0.0, 0.1)], "label double, prediction double, score double")
    m = E.metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"], m["auc"]) == (0.5, 0.5, 0.5, 0.5, 0.875)
    m = E.metrics(df.limit(0)).first()
    assert m["accuracy"] is None and m["f1"] == 0.0 and m["auc"] is None


def test_stream(spark, tmp_path):
    src = tmp_path / "src"
    docs = spark.createDataFrame([(1, "a", "c", None, TEXT, None), (2, "b", "c", None, TEXT, None)], judgment_stream.SCHEMA)
    docs.write.parquet(str(src))
    judgment_stream.stream_chunks(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2 * pipeline.Analysis(docs.where("doc_id = 1")).rag.count()


def test_stream_markers(spark, tmp_path):
    import datetime as dt

    src = tmp_path / "src"
    spark.createDataFrame([(1, "a", "c", None, TEXT, dt.datetime(2024, 1, 1, 5, 30))], judgment_stream.SCHEMA).write.parquet(str(src))
    stream = judgment_stream.stream_markers(spark.readStream.schema(judgment_stream.SCHEMA).parquet(str(src)))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("markers").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r["category"], r["count"]) for r in spark.table("markers").collect()] == [("中文數字", 1)]


def test_reports(spark):
    docs = spark.createDataFrame([(1, "a", TEXT), (2, "b", "主文\r\n\uf6c5、甲")], "doc_id long, file_name string, jfull string")
    a = pipeline.Analysis(docs)
    from lexstrata.operators import detect as D

    assert "soft_rule_only" in reports.detection_report(a.found)
    assert "U+F6C5" in reports.ultra_strict_report(D.ultra_strict(docs))
    assert "## Totals" in reports.batch_report(a.found) and "| H |" in reports.location_report(a.rag)
    empty = pipeline.Analysis(docs.limit(0))
    assert reports.detection_report(empty.found) and reports.batch_report(empty.found)


def test_save_detections(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", TEXT)], "doc_id long, file_name string, jfull string")
    reports.save_detections(pipeline.Analysis(docs).found, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d" / "detections")).count() == 5
    assert spark.read.json(str(tmp_path / "d" / "hierarchy")).count() == 1


def test_comparison_is_saved_and_loaded(spark, tmp_path):
    rows = [(i, f"alpha beta {'good' if i % 2 else 'bad'} word{i % 7}", float(i % 2)) for i in range(200)]
    c = E.compare(spark.createDataFrame(rows, "line_id long, text string, label double"), ("Logistic Regression", "Linear SVM"))
    assert "Logistic Regression" in reports.save_comparison(c, str(tmp_path))
    model = readers.model(str(tmp_path / "models" / "Linear_SVM"))
    assert model.transform(spark.createDataFrame([(1, "alpha good", 1.0)], "line_id long, text string, label double")).first()["prediction"] == 1.0
    with pytest.raises(Exception):
        readers.model(str(tmp_path / "missing"))


def test_comparison_fits_on_all_training_lines(spark):
    rows = spark.range(26_000).selectExpr("id AS line_id", "concat('alpha w', id % 50) AS text", "CAST(id % 3 = 0 AS DOUBLE) AS label")
    *_, idf, _, model = E.compare(rows, ("Logistic Regression",)).models["Logistic Regression"].stages
    n = E.stratified_split(rows, "label", "line_id").where("is_train").count()
    assert n > 20_000 and idf.numDocs == n and model.summary.predictions.count() == n


def test_classifiers_have_the_sizes_of_the_reference(spark):
    m = E.classifiers()
    forest = m["Random Forest"]
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (100, 10)
    assert m["Logistic Regression"].getMaxIter() == m["Linear SVM"].getMaxIter() == 1000


def test_batch_scorer(spark):
    from pyspark.sql import functions as F

    from lexstrata.functions.scorer import batch_scorer
    from lexstrata.operators import detect as D

    def load():
        def model(texts):
            assert len(texts) <= 3
            return [min(1.0, len(t) / 10) for t in texts]

        return model

    df = spark.createDataFrame([(None,), ("ab",)] + [("x" * i,) for i in range(9)], "t string")
    got = [r[0] for r in df.select(batch_scorer(load, 3)(F.col("t"))).collect()]
    assert got == [None, 0.2] + [i / 10 for i in range(9)]
    docs = spark.createDataFrame([(1, "a", "一、甲乙丙丁戊\n二、\n文")], "doc_id long, file_name string, jfull string")
    rows = D.detect(docs, batch_scorer(load, 3)).orderBy("line_number").collect()
    assert [(r["method_used"], r["final_prediction"]) for r in rows] == [("soft_rule_bert", True), ("soft_rule_bert", False), ("rule_rejected", False)]
    assert pipeline.Analysis(docs, batch_scorer(load, 3)).chunks.count() == 2


def test_machine_files_become_markdown(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a.json", "主文\r\n一、甲\r\n內容")], "doc_id long, file_name string, jfull string")
    writers.write_machine_files(pipeline.Analysis(docs).payload, str(tmp_path / "m"))
    assert [p.name for p in (tmp_path / "m").iterdir()] == ["a_machine.json"]
    rows = pipeline.markdown_of_machine_results(spark, str(tmp_path / "m")).collect()
    assert [tuple(r) for r in rows] == [("a.json", "# a.json\n- learning_region: 全文\n\n## 主文\n\n1. 一、甲 內容\n")]


def test_split_is_exact_and_reproducible(spark):
    rows = spark.createDataFrame([(i, float(i % 3 == 0)) for i in range(1001)] + [(5000 + i, None) for i in range(7)], "k long, label double")
    a = E.stratified_split(rows, "label", "k")
    counts = {(r[0], r[1]): r[2] for r in a.groupBy("label", "is_train").count().collect()}
    assert counts == {(1.0, True): 268, (1.0, False): 66, (0.0, True): 534, (0.0, False): 133, (None, True): 6, (None, False): 1}
    b = E.stratified_split(rows.repartition(7), "label", "k")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert a.columns == ["k", "label", "is_train"] and E.stratified_split(rows.limit(0), "label", "k").count() == 0
    # Many rows in the bucket where the share ends.
    few = E.stratified_split(rows, "label", "k", share=0.5)
    assert few.where("is_train AND label = 1").count() == 167


def test_auc_of_many_scores(spark):
    import random

    rng = random.Random(9)
    data = [(float(rng.random() < 0.4), rng.choice([rng.gauss(0, 1), round(rng.gauss(0, 1), 1)])) for _ in range(3000)]
    df = spark.createDataFrame([(y, 0.0, s) for y, s in data], "label double, prediction double, score double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(E.metrics(df).first()["auc"] - want) < 1e-9


def test_runs_and_their_outputs(spark, folder, tmp_path):
    """Every run of the command line leaves what it says, over a folder with unusable files."""
    read = lambda p: spark.read.json(str(tmp_path / p))
    for run in ("analyse", "detect", "strict", "corpus", "sections", "locations"):
        assert pipeline.main([run, str(folder), str(tmp_path / run)]) == 0
    assert pipeline.main(["analyse", str(folder), str(tmp_path / "lines"), "--json-lines", "--no-report"]) == 0
    assert {"file_name", "markdown"} <= set(read("lines/markdown").columns)
    good = read("sections/results").count()
    counts = read("sections/statistics").first()
    assert counts["success"] == good > 0 and counts["failed"] == read("detect/errors").count() > 0
    assert read("detect/results").count() == read("corpus/raw_data").count() == read("analyse/details").count() == good
    assert read("detect/stats").first()["files"] == good
    assert read("corpus/class_summary").agg({"count": "sum"}).first()[0] == good
    assert "## Errors" in spark.read.text(str(tmp_path / "corpus/report")).toPandas().value.str.cat(sep="\n")
    assert spark.read.text(str(tmp_path / "analyse/details_text")).where("value LIKE '## %'").count() == good
    assert (tmp_path / "strict/report").exists() and (tmp_path / "locations").exists()


def test_class_report_and_scorer(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (None, 1.0)], "label double, prediction double")
    got = {r["label"]: r for r in E.class_report(rows).collect()}
    assert got[1.0]["precision"] == 1.0 and got[1.0]["recall"] == 0.5 and got[0.0]["support"] == 2 and abs(got[0.0]["precision"] - 2 / 3) < 1e-9
    assert E.class_report(rows.where("false")).count() == 0
    texts = spark.createDataFrame([("一", 1.0), ("二", 0.0), (None, 1.0)], "text string, label double")
    row = E.evaluate_scorer(texts, lambda c: F.when(c == "一", 0.9).otherwise(0.1)).first()
    assert row["accuracy"] == 1.0 and row["tp"] == 1 and row["tn"] == 1


def test_deep_levels_are_numbered(spark):
    """Levels over those that judgments have, as results of other origin may hold."""
    from lexstrata.operators import markdown as M

    rows = [(1, i, lv, "leveling_symbol", [t]) for i, (lv, t) in enumerate([(1, "a"), (30, "b"), (30, "c"), (25, "d"), (30, "e"), (1, "f"), (30, "g")])]
    chunks = spark.createDataFrame(rows, "doc_id long, seq long, level long, chunk_type string, content_lines array<string>")
    got = [r["block"][0].strip() for r in M.chunk_markdown(chunks).orderBy("seq").collect()]
    assert got == ["1. a", "1. b", "2. c", "1. d", "1. e", "2. f", "1. g"]
