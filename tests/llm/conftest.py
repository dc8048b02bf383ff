import pytest

SCHEMAS = {
    "judgments": "doc_id long, file_name string, court string, jid string, jfull string, ingested_at timestamp",
    "detections": "detection_id long, doc_id long, court string, run_no int, line_number int, line_text string, detected_symbol string, symbol_category string, rule_based_score double, bert_score double, final_prediction boolean, method_used string, detected_at timestamp",
    "labelled_lines": "line_id long, line_text string, sentiment string, split string, source string, labelled_at timestamp",
    "rag_chunks": "row_id long, doc_id long, chunk_id string, chunk_type string, level int, start_line int, end_line int, title string, leveling_symbol string, content string, full_text string, hierarchy_path array<int>, parent_titles array<string>, location string, ingested_at timestamp",
    "line_chunks": "row_id long, doc_id long, seq int, level int, start_line int, end_line int, chunk_type string, content_lines array<string>, leveling_symbol string, chunk_id string, ingested_at timestamp",
    "documents": "doc_id long, text string, lang string, source string, n_chars long, published_at timestamp, ingested_at timestamp",
    "eval_items": "item_id long, item_text string, split string, source string",
}
# Names that the operators use for columns of their own.
CLASHING = ["id", "text", "scope", "k1", "k2", "h1", "h2", "n", "cid", "t", "hit", "look", "stored", "keys", "odd", "kept_id", "copy_id", "key", "item_table", "rec_table", "rec_id", "ids", "term", "a", "b", "label", "n_links"]


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables, given as lists of dicts, to a folder: all with extra columns of clashing names. Others are empty."""

    def make(**given):
        from pyspark.sql import functions as F

        for name, schema in SCHEMAS.items():
            cols = [c.strip().split(" ")[0] for c in schema.split(", ")]
            rows = [tuple(r.get(c) for c in cols) for r in given.get(name, [])]
            df = spark.createDataFrame(rows, schema)
            df.withColumns({c: F.lit("x") for c in CLASHING if c not in cols}).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make


@pytest.fixture
def collect():
    return lambda df: sorted(map(tuple, df.collect()))
