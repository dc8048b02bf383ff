"""Special markers and line chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .lines import first_where, last_where, lf_lines, running
from .structure import level_of, rule_maps

APPENDIX = ("附錄", "附件", "附圖", "附表")


def mark_lines(lines: DataFrame) -> DataFrame:
    """Add is_date and marker to lines (doc_id, idx0, raw): main_text, facts, reasons, facts_and_reasons by the whole line; appendix by
    its first two characters, behind the document's last date; null otherwise. A date line can have a marker too."""
    text = X.strip(F.col("raw"))
    lines = lines.withColumns({"bare": X.without_blanks(text), "is_date": X.is_roc_date(text)}).withColumn("last_date", last_where(F.col("is_date")))
    marker = (
        F.when(F.col("bare") == "主文", "main_text")
        .when(F.col("bare") == "事實", "facts")
        .when(F.col("bare") == "理由", "reasons")
        .when(F.col("bare").isin("事實及理由", "事實和理由", "事實與理由"), "facts_and_reasons")
        .when((F.col("idx0") > F.col("last_date")) & F.left("bare", F.lit(2)).isin(*APPENDIX), "appendix")
    )
    return lines.withColumn("marker", marker).drop("bare", "last_date")


def special_markers(docs: DataFrame) -> DataFrame:
    """doc_id, marker_type, idx0: markers and dates."""
    rows = mark_lines(lf_lines(docs))
    kinds = F.array_compact(F.array(F.col("marker"), F.when(F.col("is_date"), F.lit("dates"))))
    return rows.select("doc_id", F.explode(kinds).alias("marker_type"), "idx0")


def line_chunks(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """doc_id, seq, level, start_line, end_line (from 0), chunk_type, content_lines, leveling_symbol, chunk_id.

    lines: of detect_lines. Each line is put in every chunk that it belongs to, in one pass over the document, as (branch,
    group); a chunk is a group. The branches: header, first date, signature, last date, heading, symbol, content,
    appendix, appendix content, footer. Chunks are ordered by start, then branch."""
    lines = mark_lines(lines.select("doc_id", "idx0", "raw", "detected_symbol", "symbol_category", "final_prediction")).join(rule_maps(rules), "doc_id", "left")
    # A category that was not learned has level 1 here.
    lines = lines.withColumn("symbol_level", F.coalesce(level_of(F.col("symbol_category")), F.lit(1)).cast("long"))
    lines = lines.withColumn("detected_symbol", F.when(F.col("final_prediction"), F.col("detected_symbol"))).drop("rules")

    i, marker, is_date = F.col("idx0"), F.col("marker"), F.col("is_date")
    sym = F.col("detected_symbol").isNotNull()
    special = marker.isNotNull() | is_date
    lines = lines.withColumns({
        "main": first_where(marker == "main_text"), "d1": first_where(is_date), "d2": last_where(is_date), "apx": first_where(marker == "appendix"),
        "n": F.max("idx0").over(Window.partitionBy("doc_id")) + 1,
    })
    lines = lines.withColumn("nxt", first_where(marker.isNotNull() & (marker != "appendix") & (i > F.col("apx"))))
    main, d1, d2, apx, n, nxt = (F.col(c) for c in ("main", "d1", "d2", "apx", "n", "nxt"))
    cs, ce, ae = F.coalesce(main, F.lit(0)), F.coalesce(apx, n) - 1, F.coalesce(nxt, n) - 1
    inside, in_apx = i.between(cs, ce), i.between(apx, ae)
    sig = (i > d1) & (i < d2)
    plain = ~special & ~sym
    free = inside & plain & ~F.coalesce(sig, F.lit(False))
    lines = lines.withColumn("free", F.coalesce(free, F.lit(False)))
    # Islands of free lines: the index less the number of free lines so far.
    island = i - F.sum(F.col("free").cast("long")).over(running())
    apx_group = F.sum((marker == "appendix").cast("long")).over(running())
    lines = lines.withColumns({"island": island, "apx_group": apx_group})
    footer_end = F.coalesce(apx, n) - 1
    dated = d1.between(cs, ce)

    def entry(when: Column, branch: int, group: Column, level: Column | int, kind: Column | str) -> Column:
        level = level if isinstance(level, Column) else F.lit(level)
        kind = kind if isinstance(kind, Column) else F.lit(kind)
        return F.when(when, F.struct(F.lit(branch).alias("br"), group.cast("long").alias("grp"), level.cast("long").alias("level"), kind.alias("chunk_type")))

    zero = F.lit(0)
    entries = F.array_compact(
        F.array(
            entry(i < main, 0, zero, -3, "header"),
            entry((i == d1) & dated, 1, zero, -2, "date"),
            entry(sig & dated, 2, zero, -3, "signature"),
            entry((i == d2) & (d2 != d1) & d2.between(cs, ce), 3, zero, -2, "date"),
            entry(marker.isNotNull() & inside, 4, i, 0, marker),
            entry(sym & inside, 5, i, F.col("symbol_level"), "leveling_symbol"),
            entry(F.col("free"), 6, F.col("island"), -1, "content"),
            entry((marker == "appendix") & in_apx, 7, i, 0, "appendix"),
            entry(in_apx & plain, 8, F.col("apx_group"), -1, "content"),
            entry((i > d2) & (i <= footer_end) & plain, 9, zero, -3, "footer"),
        )
    )
    rows = lines.select("doc_id", "idx0", "raw", "detected_symbol", (d2 + 1).alias("after"), footer_end.alias("footer_end"), F.explode(entries).alias("e"))
    footer = F.col("br") == 9
    chunks = rows.groupBy("doc_id", F.col("e.br").alias("br"), F.col("e.grp").alias("grp"), F.col("e.level").alias("level"), F.col("e.chunk_type").alias("chunk_type")).agg(
        F.min("idx0").alias("lo"), F.max("idx0").alias("hi"), F.transform(F.array_sort(F.collect_list(F.struct("idx0", "raw"))), lambda x: x["raw"]).alias("content_lines"),
        F.min("after").alias("after"), F.min("footer_end").alias("footer_end"), F.min("detected_symbol").alias("symbol"),
    )
    start, end = F.when(footer, F.col("after")).otherwise(F.col("lo")), F.when(footer, F.col("footer_end")).otherwise(F.col("hi"))
    chunks = chunks.withColumns({"start_line": start, "end_line": end})
    name = (
        F.when(F.col("br").isin(0, 2, 9), F.col("chunk_type"))
        .when(F.col("chunk_type") == "content", F.concat_ws("_", "chunk_type", "start_line", "end_line"))
        .when(F.col("br") == 5, F.concat_ws("_", F.lit("level"), "level", "start_line"))
        .otherwise(F.concat_ws("_", "chunk_type", "start_line"))
    )
    seq = F.row_number().over(Window.partitionBy("doc_id").orderBy("start_line", "br")) - 1
    symbol = F.when(F.col("br") == 5, F.col("symbol"))
    return chunks.select("doc_id", seq.cast("long").alias("seq"), "level", "start_line", "end_line", "chunk_type", "content_lines", symbol.alias("leveling_symbol"), name.alias("chunk_id"))


def level_content(chunks: DataFrame) -> DataFrame:
    """doc_id, level_key, content, n_lines: the lines of all chunks of a level, each chunk headed by [type:start-end].
    Lines that begin with [ are not counted."""
    head = F.concat(F.lit("["), "chunk_type", F.lit(":"), F.col("start_line") + 1, F.lit("-"), F.col("end_line") + 1, F.lit("]"))
    rows = chunks.select("doc_id", F.concat(F.lit("Lv_"), "level").alias("level_key"), "seq", F.concat(F.array(head), "content_lines").alias("lines"))
    out = rows.groupBy("doc_id", "level_key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("seq", "lines"))), lambda x: x["lines"])).alias("content"))
    return out.withColumn("n_lines", F.size(F.filter("content", lambda x: ~x.startswith("["))).cast("long"))


def chunk_types(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("level", "chunk_type").agg(F.count("*").alias("count"))
