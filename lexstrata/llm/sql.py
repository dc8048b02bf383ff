"""SQL for DuckDB of the pN_ queries that SQL can express, written apart from the operators."""

import unicodedata

from .p6_same_look import LOOKALIKES, RADICALS

# White space as Python's isspace has it; DuckDB's \s is ASCII.
_WS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_clean = lambda c: rf"lower(regexp_replace({c}, '[\p{{P}}{_WS}]', '', 'g'))"

_P1_GROUPS = rf"""
WITH r AS (
  SELECT 'detections' AS rec_table, detection_id AS id, doc_id AS scope, line_text AS t FROM detections WHERE line_text IS NOT NULL
  UNION ALL SELECT 'labelled_lines', line_id, 0, line_text FROM labelled_lines WHERE line_text IS NOT NULL
), k AS (
  SELECT rec_table, id, scope, {_clean('t')} AS k1,
    list_filter(regexp_split_to_array(t, '[;；|｜]'), lambda p: length({_clean('p')}) > 0) AS parts FROM r
), f AS (
  SELECT rec_table, id, scope, k1, CASE WHEN len(parts) > 1 AND len(list_filter(parts, lambda p: NOT regexp_matches(p, '^[^:：]*[^:：{_WS}][^:：]*[:：]'))) = 0
    THEN 'f' || array_to_string(list_sort(list_transform(parts, lambda p: {_clean('p')})), chr(31)) END AS k2
  FROM k WHERE length(k1) >= 12
), g AS (
  SELECT *, coalesce(min(k2) OVER (PARTITION BY rec_table, scope, k1), k1) AS key FROM f
), m AS (
  SELECT rec_table, id, min(id) OVER w AS kept_id, count(*) OVER w AS n_copies FROM g WINDOW w AS (PARTITION BY rec_table, scope, key)
)
"""

_P2 = rf"""
WITH l AS (
  SELECT line_id, split, source, lower(trim(split)) = 'train' AS t, {_clean('line_text')} AS c FROM labelled_lines WHERE split IS NOT NULL AND line_text IS NOT NULL
), u AS (
  SELECT DISTINCT c FROM l WHERE length(c) >= 12
), b AS (
  SELECT DISTINCT c, substr(c, i, 2) AS w FROM u, unnest(range(1, length(c))) AS x(i)
), n AS (
  SELECT c, count(*) AS n FROM b GROUP BY c
), o AS (
  SELECT x.c AS c1, y.c AS c2, count(*) AS o FROM b x JOIN b y USING (w) GROUP BY ALL
), p AS (
  SELECT c1, c2 FROM o JOIN n n1 ON c1 = n1.c JOIN n n2 ON c2 = n2.c WHERE o >= 0.7 * (n1.n + n2.n - o)
)
"""

_P5 = rf"""
WITH RECURSIVE j AS (SELECT doc_id, regexp_replace(jfull, '[{_WS}]', '', 'g') AS t FROM judgments WHERE regexp_matches(jfull, '[^{_WS}]')),
w AS (SELECT DISTINCT doc_id, substr(t, i, 5) AS w FROM j, unnest(range(1, length(t) - 3)) AS x(i)),
n AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM w x JOIN w y ON x.w = y.w AND x.doc_id < y.doc_id GROUP BY ALL),
p AS (SELECT a, b FROM o JOIN n n1 ON a = n1.doc_id JOIN n n2 ON b = n2.doc_id WHERE o >= 0.6 * (n1.n + n2.n - o) UNION SELECT x.doc_id, y.doc_id FROM j x JOIN j y ON x.t = y.t AND x.doc_id < y.doc_id),
c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS class_id FROM j),
l AS (SELECT DISTINCT x.class_id AS a, y.class_id AS b FROM p JOIN c x ON p.a = x.doc_id JOIN c y ON p.b = y.doc_id WHERE x.class_id <> y.class_id),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT class_id, class_id FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
"""

# Runs of 40 characters: every window of an item against every window of a document.
_P8 = rf"""
WITH i AS (SELECT item_id, split, source, {_clean('item_text')} AS t FROM eval_items WHERE item_text IS NOT NULL),
d AS (SELECT doc_id, {_clean('text')} AS t FROM documents WHERE text IS NOT NULL),
wi AS (SELECT DISTINCT item_id, substr(t, k, 40) AS w FROM i, unnest(range(1, length(t) - 38)) AS x(k)),
wd AS (SELECT DISTINCT doc_id, substr(t, k, 40) AS w FROM d, unnest(range(1, length(t) - 38)) AS x(k)),
f AS (SELECT DISTINCT doc_id, item_id FROM wi JOIN wd USING (w))
"""

def _one_to_one() -> tuple[str, str]:
    """Characters and what they look like, by the Unicode database: spaces, full- and half-width forms, radicals, and the
    fixed lists of shapes."""
    pairs = {chr(cp): unicodedata.normalize("NFKC", chr(cp)) for cp in (*range(0xFF01, 0xFFE3), *range(0xFFE4, 0xFFEF), *range(0x2F00, 0x2FD6))}
    pairs |= {"￣": "¯", "⺟": "母", "⻳": "龟"} | {chr(cp): " " for cp in range(0x10000) if unicodedata.category(chr(cp)) == "Zs"}
    pairs |= {a: b for old, new in LOOKALIKES for a, b in zip(old, new)} | {x[0]: x[1] for x in RADICALS.split()}
    pairs = {a: b for a, b in pairs.items() if len(b) == 1 and a != b}
    return "".join(pairs), "".join(pairs.values())


_FROM, _TO = (x.replace("'", "''") for x in _one_to_one())
_GONE = r"[\p{Cf}\x{fe00}-\x{fe0f}\x{e0100}-\x{e01ef}\x{180b}-\x{180d}\x{034f}\x{180f}]"
_P6 = rf"""
WITH r AS (
  SELECT 'judgments' AS rec_table, doc_id AS id, 0 AS scope, jfull AS t FROM judgments UNION ALL SELECT 'detections', detection_id, coalesce(doc_id, -1), line_text FROM detections
), k AS (
  SELECT *, nfc_normalize(translate(nfc_normalize(regexp_replace(t, '{_GONE}', '', 'g')), '{_FROM}', '{_TO}')) AS look FROM r WHERE regexp_matches(t, '[^{_WS}]')
)
"""

ORACLE: dict[str, str] = {
    "p1_found": _P1_GROUPS + "SELECT rec_table, kept_id, id AS copy_id FROM m WHERE id <> kept_id",
    "p1_groups": _P1_GROUPS + "SELECT DISTINCT rec_table, kept_id, n_copies FROM m WHERE n_copies > 1",
    "p2_found": _P2 + "SELECT least(a.line_id, b.line_id) AS line_id_a, greatest(a.line_id, b.line_id) AS line_id_b FROM p JOIN l a ON a.c = c1 AND a.t JOIN l b ON b.c = c2 AND NOT b.t",
    "p2_report": _P2
    + """SELECT split, source, count(*) AS n_lines, count(*) FILTER (WHERE c IN (SELECT c2 FROM p JOIN l a ON a.c = c1 AND a.t)) AS n_overlapping
FROM (SELECT split, source, lower(regexp_replace(coalesce(line_text, ''), '[\\p{P}WS]', '', 'g')) AS c FROM labelled_lines WHERE split IS NOT NULL AND lower(trim(split)) <> 'train') GROUP BY ALL""".replace("WS", _WS),
    "p4_found": """SELECT 'rag_chunks' AS item_table, 'content' AS field_name, row_id FROM rag_chunks WHERE length(content) > 512
UNION ALL SELECT 'rag_chunks', 'full_text', row_id FROM rag_chunks WHERE length(full_text) > 512
UNION ALL SELECT 'line_chunks', 'content_lines', row_id FROM line_chunks WHERE length(array_to_string(list_transform(content_lines, lambda x: coalesce(x, '')), chr(10))) > 512""",
    "p5_found": _P5 + "SELECT a AS doc_id_a, b AS doc_id_b FROM p",
    "p5_groups": _P5 + """SELECT doc_id, class_id, (SELECT min(b) FROM r WHERE r.a = c.class_id) AS group_id, (SELECT count(*) FROM e WHERE e.a = c.class_id) AS n_links FROM c""",
    "p6_found": _P6 + "SELECT x.rec_table, x.id AS id_a, y.id AS id_b FROM k x JOIN k y ON x.rec_table = y.rec_table AND x.scope = y.scope AND x.look = y.look AND x.id < y.id AND x.t <> y.t",
    "p8_found": _P8 + "SELECT doc_id, item_id FROM f",
    "p8_items": _P8 + "SELECT item_id, split, source, count(*) AS n_docs FROM f JOIN i USING (item_id) GROUP BY ALL",
}
