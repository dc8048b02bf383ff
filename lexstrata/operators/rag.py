"""Retrieval chunks with their ancestors, the chunk tree, and location statistics. Chunks are rows of line_chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.symbols import MAX_LEVELS

# Words of an outermost title, in order, and the place they stand for.
TITLE_WORDS = (
    (("附表", "附錄", "附件"), "A"),
    (("事實及理由", "事實和理由", "事實與理由"), "S"),
    (("事實", "事　實"), "F"),
    (("理由", "理　由"), "R"),
    (("主文", "主　文"), "M"),
)
SPECIAL = ("header", "footer", "signature", "date")


def in_order() -> WindowSpec:
    return Window.partitionBy("doc_id").orderBy("seq")


def before() -> WindowSpec:
    return in_order().rowsBetween(Window.unboundedPreceding, -1)


def up_to() -> WindowSpec:
    return in_order().rowsBetween(Window.unboundedPreceding, 0)


def with_ancestors(chunks: DataFrame, title: Column) -> DataFrame:
    """Add ancestors: an array of (level, seq, title), outermost first, of the open chunks of level 0 or more.

    Without a stack: the last chunk of each level is an ancestor of a later one if it is deeper in the text than the
    last chunk of every smaller level, and its level is smaller. Levels are bounded by the number of categories, so
    that this is one window pass. For rows below level 0, all open chunks count."""
    node = F.struct(F.col("level").alias("level"), F.col("seq").alias("seq"), title.alias("title"))
    last = [F.last(F.when(F.col("level") == lv, node), True).over(before()) for lv in range(MAX_LEVELS + 1)]
    rows = chunks.withColumns({f"_a{lv}": c for lv, c in enumerate(last)})
    open_ = []
    newest: Column = F.lit(-1).cast("long")
    for lv in range(MAX_LEVELS + 1):
        a = F.col(f"_a{lv}")
        is_open = (a["seq"] > newest) & ((F.col("level") < 0) | (F.col("level") > lv))
        open_.append(F.when(is_open, a))
        newest = F.greatest(newest, F.coalesce(a["seq"], F.lit(-1)))
    rows = rows.withColumn("ancestors", F.array_compact(F.array(*open_)))
    return rows.drop(*[f"_a{lv}" for lv in range(MAX_LEVELS + 1)])


def chunk_title(level: Column, lines: Column, kind: Column) -> Column:
    """Of a heading, its first line with breaks as newlines, stripped; of a symbol, its first line without breaks."""
    first = F.try_element_at(lines, F.lit(1))
    heading = F.coalesce(X.strip(X.breaks_to_newline(first)), kind)
    symbol = F.coalesce(X.strip(X.without_breaks(first)), F.concat(F.lit("Level "), level))
    return F.when(level == 0, heading).when(level >= 1, symbol)


def location(kind: Column, titles: Column, dates_before: Column) -> Column:
    """The place in the judgment, by the chunk's type or else by its outermost ancestor."""
    direct = {"header": "H", "footer": "H", "signature": "SIG", "appendix": "A", "main_text": "M", "facts": "F", "reasons": "R", "facts_and_reasons": "S"}
    out = F.when(kind == "date", F.when(dates_before == 0, "D1").otherwise("D2"))
    for name, place in direct.items():
        out = out.when(kind == name, place)
    first = F.try_element_at(titles, F.lit(1))
    for words, place in TITLE_WORDS:
        has = F.lit(False)
        for w in words:
            has = has | first.contains(w)
        out = out.when(has, place)
    return out.otherwise("O")


def rag_chunks(chunks: DataFrame) -> DataFrame:
    """doc_id, chunk_id, chunk_type, level, start_line, end_line (from 1), title, leveling_symbol, content, full_text,
    hierarchy_path, parent_titles, location.

    Content belongs to the last chunk that is no content, if that begins a level; otherwise it stands alone."""
    kind, level, seq = F.col("chunk_type"), F.col("level"), F.col("seq")
    rows = with_ancestors(chunks, chunk_title(level, F.col("content_lines"), kind))
    is_content = (level == -1) & (kind == "content")
    rows = rows.withColumn("opener", F.last(F.when(~is_content, F.struct(seq.alias("seq"), kind.alias("kind"))), True).over(up_to()))
    owned = is_content & F.coalesce(F.col("opener.kind") == "leveling_symbol", F.lit(False))
    dates = F.coalesce(F.sum((kind == "date").cast("long")).over(before()), F.lit(0))
    text = F.array_join(F.transform("content_lines", X.breaks_to_newline), "\n")
    rows = rows.withColumns({"owner": F.when(owned, F.col("opener.seq")).otherwise(seq), "is_content": is_content, "text": text, "dates": dates})
    # One row per owner: the symbol or special chunk itself, with the content that it owns in order.
    own = F.struct("level", "chunk_type", "chunk_id", "start_line", "end_line", "content_lines", "leveling_symbol", "ancestors", "text", "dates")
    part = F.when(F.col("owner") != seq, F.struct("seq", "text", "end_line"))
    out = rows.groupBy("doc_id", "owner").agg(F.first(F.when(F.col("owner") == seq, own), True).alias("c"), F.array_sort(F.collect_list(part)).alias("parts"))
    out = out.select("doc_id", F.col("owner").alias("seq"), "c.*", "parts")
    section, special = kind == "leveling_symbol", kind.isin(*SPECIAL)
    # The first text that isn't empty begins the content: empty ones before it leave no line.
    texts = F.transform("parts", lambda p: p["text"])
    content = F.aggregate(texts, F.lit(""), lambda acc, x: F.when(acc == "", x).otherwise(F.concat(acc, F.lit("\n"), x)))
    title = F.when(special, F.upper(kind)).when(level == -1, "Content").otherwise(chunk_title(level, F.col("content_lines"), kind))
    full = (
        F.when(section, X.without_space(F.concat(title, F.array_join(texts, ""))))
        .when(special, F.col("text"))
        .when(level == 0, X.without_space(F.col("text")))
        .otherwise(X.without_breaks(F.col("text")))
    )
    no_path = special | (level == 0)
    path = F.when(no_path, F.array().cast("array<long>")).otherwise(F.transform("ancestors", lambda a: a["level"]))
    titles = F.when(no_path, F.array().cast("array<string>")).otherwise(F.transform("ancestors", lambda a: a["title"]))
    out = out.withColumns({"hierarchy_path": path, "parent_titles": titles})
    last_end = F.coalesce(F.try_element_at("parts", F.lit(-1))["end_line"], F.col("end_line"))
    new_kind = F.when(section, "hierarchical_section").when((level == -1) & (kind == "content"), "orphan_content").otherwise(kind)
    return out.select(
        "doc_id", "seq", "chunk_id", new_kind.alias("chunk_type"), "level", (F.col("start_line") + 1).alias("start_line"), (last_end + 1).alias("end_line"), title.alias("title"), "leveling_symbol",
        F.when(section, content).otherwise(F.col("text")).alias("content"), full.alias("full_text"), "hierarchy_path", "parent_titles", location(new_kind, F.col("parent_titles"), F.col("dates")).alias("location"),
    )


def machine_tree(chunks: DataFrame) -> DataFrame:
    """doc_id, node_id, parent_id, depth, ordinal, level, chunk_type, start_line, end_line, content_lines.

    Chunks of level 0 or more nest; content is appended to the innermost open node of level 1 or more, extending its end,
    or is a root; other chunks are roots. Spark has no recursive type: the tree is a table of parents."""
    level, seq = F.col("level"), F.col("seq")
    rows = with_ancestors(chunks, F.lit(""))
    host = F.try_element_at(F.filter("ancestors", lambda a: a["level"] >= 1), F.lit(-1))["seq"]
    node = F.when(level == -1, F.coalesce(host, seq)).otherwise(seq)
    parent = F.when(level >= 0, F.try_element_at("ancestors", F.lit(-1))["seq"])
    depth = F.when(level >= 0, F.size("ancestors")).otherwise(0)
    rows = rows.withColumns({"node_id": node, "parent_id": parent, "depth": depth.cast("long")})
    own = F.struct("parent_id", "depth", "level", "chunk_type", "chunk_id", "leveling_symbol", "start_line")
    parts = F.array_sort(F.collect_list(F.struct("seq", "content_lines")))
    out = rows.groupBy("doc_id", "node_id").agg(F.first(F.when(F.col("node_id") == seq, own), True).alias("c"), F.max("end_line").alias("end_line"), F.flatten(F.transform(parts, lambda p: p["content_lines"])).alias("content_lines"))
    ordinal = F.row_number().over(Window.partitionBy("doc_id", "c.parent_id").orderBy("node_id"))
    return out.select(
        "doc_id", "node_id", "c.parent_id", "c.depth", ordinal.cast("long").alias("ordinal"), "c.level", "c.chunk_type", "c.chunk_id", "c.leveling_symbol",
        (F.col("c.start_line") + 1).alias("start_line"), (F.col("end_line") + 1).alias("end_line"), "content_lines",
    )


def location_stats(rag: DataFrame) -> DataFrame:
    """location (MISSING for null), count, percent, chunk_types."""
    out = rag.groupBy(F.coalesce("location", F.lit("MISSING")).alias("location")).agg(F.count("*").alias("count"), F.array_join(F.sort_array(F.collect_set("chunk_type")), ",").alias("chunk_types"))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))  # over one row a location
    return out.select("location", "count", (F.col("count") * 100 / total).alias("percent"), "chunk_types")
