"""SQL for DuckDB of the core queries, written apart from the operators: other joins, other formulas."""

from __future__ import annotations

WS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_strip = lambda c: f"regexp_replace({c}, '^[{WS}]+|[{WS}]+$', '', 'g')"
_rstrip = lambda c: f"regexp_replace({c}, '[{WS}]+$', '')"
_bare = lambda c: f"regexp_replace({c}, '[{WS}]', '', 'g')"
_date = lambda c: rf"regexp_matches({c}, '{DATE}')"
DATE = rf"中[{WS}]*華[{WS}]*民[{WS}]*國[{WS}]*(\p{{Nd}}+)[{WS}]*年[{WS}]*(\p{{Nd}}+)[{WS}]*月[{WS}]*(\p{{Nd}}+)[{WS}]*日"
SHORT = r"民國(\p{Nd}+)年(\p{Nd}+)月(\p{Nd}+)日"
_flat = lambda c: f"array_to_string(list_transform({c}, lambda zz: coalesce(zz, '')), '¦')"

# Lines by CR LF, and by LF.
A = "a AS (SELECT doc_id, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS idx0 FROM (SELECT doc_id, string_split(jfull, chr(13) || chr(10)) AS l FROM judgments WHERE jfull IS NOT NULL))"
B = "b AS (SELECT doc_id, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS idx0 FROM (SELECT doc_id, string_split(jfull, chr(10)) AS l FROM judgments WHERE jfull IS NOT NULL))"

LABEL = f"""CASE WHEN contains({_bare('raw')}, '主文') THEN 'main_text' WHEN {_bare('raw')} IN ('事實及理由', '事實與理由', '事實和理由') THEN 'facts_and_reasons'
  WHEN contains({_bare('raw')}, '事實') THEN 'facts' WHEN contains({_bare('raw')}, '理由') THEN 'reasons' WHEN {_date('raw')} THEN 'footer' END"""
# The section of a line is that of the last labelled line at or before it: an as-of join.
SEC = f"""{A}, lab AS (SELECT doc_id, idx0, {LABEL} AS label FROM a),
sec0 AS (SELECT a.doc_id, a.idx0, a.raw, coalesce(l.label, 'header') AS section FROM a ASOF LEFT JOIN (SELECT * FROM lab WHERE label IS NOT NULL) l ON a.doc_id = l.doc_id AND a.idx0 >= l.idx0),
sec AS (SELECT * FROM sec0 UNION ALL SELECT doc_id, idx0, raw, 'facts' FROM sec0 WHERE section = 'facts_and_reasons' AND doc_id NOT IN (SELECT doc_id FROM sec0 WHERE section = 'facts'))"""
NAMES = ("header", "main_text", "facts", "reasons", "facts_and_reasons", "footer")
_COUNTS = ", ".join(f"count(*) FILTER (WHERE section = '{s}') AS n_{s}" for s in NAMES)

DATES = f"""d0 AS (SELECT doc_id, CASE WHEN contains(jfull, chr(13) || chr(10)) THEN string_split(jfull, chr(13) || chr(10)) ELSE string_split(jfull, chr(10)) END AS l FROM judgments WHERE jfull IS NOT NULL),
d1 AS (SELECT doc_id, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS idx0 FROM d0),
d2 AS (SELECT *, {_bare("replace(raw, chr(8203), '')")} AS c FROM d1 WHERE contains(raw, '中') AND contains(raw, '華') AND contains(raw, '民') AND contains(raw, '國') AND contains(raw, '年') AND contains(raw, '月') AND contains(raw, '日')),
d3 AS (SELECT *, CASE WHEN regexp_matches(raw, '{DATE}') THEN regexp_extract(raw, '{DATE}', ['y', 'm', 'd']) WHEN regexp_matches(raw, '{SHORT}') THEN regexp_extract(raw, '{SHORT}', ['y', 'm', 'd'])
  WHEN regexp_matches(c, '{DATE}') THEN regexp_extract(c, '{DATE}', ['y', 'm', 'd']) WHEN regexp_matches(c, '{SHORT}') THEN regexp_extract(c, '{SHORT}', ['y', 'm', 'd']) END AS g FROM d2),
dates AS (SELECT doc_id, idx0, g.y AS year, g.m AS month, g.d AS day, '中華民國' || g.y || '年' || g.m || '月' || g.d || '日' AS full_match, raw AS original_line, c AS cleaned_line FROM d3 WHERE g IS NOT NULL)"""


def _pua(c: str) -> str:
    u = f"unicode({c})"
    return f"""CASE WHEN NOT ({u} BETWEEN 57344 AND 63743 OR {u} BETWEEN 983040 AND 1048573 OR {u} BETWEEN 1048576 AND 1114109) THEN NULL
  WHEN {u} IN (62698, 62699, 62715, 62716, 62717, 62718, 62719) OR {u} BETWEEN 63163 AND 63172 THEN 'PUA_半形阿拉伯數字_括弧'
  WHEN {u} BETWEEN 62703 AND 62708 OR {u} IN (62713, 62714, 62720, 62721) OR {u} BETWEEN 62740 AND 62752 THEN 'PUA_全形阿拉伯數字_括弧'
  WHEN {u} BETWEEN 62722 AND 62729 THEN 'PUA_小寫中文數字_括弧' WHEN {u} BETWEEN 62730 AND 62739 THEN 'PUA_天干_括弧'
  WHEN {u} BETWEEN 62753 AND 62852 OR {u} BETWEEN 63153 AND 63162 THEN 'PUA_全形阿拉伯數字_圈圈' WHEN {u} BETWEEN 62853 AND 62952 THEN 'PUA_全形阿拉伯數字_句號'
  WHEN {u} BETWEEN 62953 AND 63052 THEN '全形數字' WHEN {u} BETWEEN 63053 AND 63152 THEN 'PUA_小寫中文數字_頓號' WHEN {u} BETWEEN 63173 AND 63182 THEN 'PUA_羅馬數字' ELSE 'PUA_未分組' END"""


# First characters with their category; the dictionary is the data's own table.
F1 = f"""{B}, f0 AS (SELECT doc_id, idx0, raw, {_strip('raw')} AS t FROM b), f1 AS (SELECT *, substr(t, 1, 1) AS symbol FROM f0 WHERE t <> ''),
f AS (SELECT f1.*, {_pua('f1.symbol')} AS pua, coalesce(s.category, {_pua('f1.symbol')}) AS category FROM f1 LEFT JOIN symbol_dim s ON s.symbol = f1.symbol)"""
DET = f"""{F1}, det AS (
  SELECT doc_id, idx0 + 1 AS line_number, t AS line_text, CASE WHEN m <> 'rule_rejected' THEN symbol END AS detected_symbol, CASE WHEN m <> 'rule_rejected' THEN category END AS symbol_category,
    CASE m WHEN 'ultra_strict_pua' THEN 1.0 WHEN 'soft_rule_only' THEN 0.5 ELSE 0.0 END::DOUBLE AS rule_based_score, CASE m WHEN 'ultra_strict_pua' THEN 1.0 ELSE 0.0 END::DOUBLE AS bert_score,
    m <> 'rule_rejected' AS final_prediction, m AS method_used
  FROM (SELECT *, CASE WHEN pua IS NOT NULL AND substr(t, 2, 1) = '、' THEN 'ultra_strict_pua' WHEN pua IS NULL AND category IS NOT NULL THEN 'soft_rule_only' ELSE 'rule_rejected' END AS m FROM f)
  UNION ALL SELECT doc_id, idx0 + 1, '', NULL, NULL, 0.0, 0.0, false, 'empty_line' FROM f0 WHERE t = ''
), pos AS (SELECT * FROM det WHERE final_prediction)"""
ULTRA = f"""{F1}, ultra AS (
  SELECT doc_id, idx0 + 1 AS line_number, symbol, printf('U+%04X', unicode(symbol)) AS unicode_code, category, t AS content, pua IS NOT NULL AS is_pua, true AS has_proper_newline
  FROM f WHERE substr(t, 2, 1) = '、' AND substr(t, 1, 1) <> chr(10) AND category IS NOT NULL AND (idx0 = 0 OR EXISTS (SELECT 1 FROM b WHERE b.doc_id = f.doc_id AND b.idx0 = f.idx0 - 1 AND suffix(b.raw, chr(13))))
)"""
# A category's level: how many categories first appear at or before it.
LEVELS = """cat AS (SELECT doc_id, symbol_category, min(line_number) AS fl, count(*) AS n FROM {rows} GROUP BY ALL),
lev AS (SELECT x.doc_id, x.symbol_category, x.fl, x.n, count(*) AS level FROM cat x JOIN cat y ON x.doc_id = y.doc_id AND y.fl <= x.fl GROUP BY ALL)"""
_EX = "(SELECT {agg} FROM (SELECT line_number, line_text FROM {rows} q WHERE q.doc_id = {t}.doc_id AND q.symbol_category = {t}.symbol_category ORDER BY line_number LIMIT 3) r)"

STRUCT = f"""{SEC}, {B}, hs AS (SELECT doc_id, section, raw, row_number() OVER (PARTITION BY doc_id, section ORDER BY idx0) AS p FROM sec),
fl AS (SELECT doc_id, bool_or(section = 'main_text') AS has_main_text, bool_or(section = 'facts') AS has_facts, bool_or(section = 'reasons') AS has_reasons, bool_or(section = 'facts_and_reasons') AS has_facts_and_reasons FROM sec GROUP BY doc_id),
reg AS (SELECT *, CASE WHEN has_facts_and_reasons THEN 'S-D' WHEN has_reasons THEN 'R-D' ELSE '全文' END AS learning_region, CASE WHEN has_facts_and_reasons THEN 'facts_and_reasons' ELSE 'reasons' END AS want FROM fl),
anc AS (SELECT r.doc_id, min(b.idx0) AS s FROM reg r JOIN hs ON hs.doc_id = r.doc_id AND hs.section = r.want AND hs.p <= 3 JOIN b ON b.doc_id = r.doc_id AND {_strip('b.raw')} = {_strip('hs.raw')} AND {_strip('b.raw')} <> '' GROUP BY r.doc_id),
str AS (SELECT r.doc_id, has_main_text, has_facts, has_reasons, has_facts_and_reasons, learning_region, CASE WHEN learning_region = '全文' THEN 0 ELSE s END AS learn_start, (SELECT count(*) FROM b WHERE b.doc_id = r.doc_id) AS total_lines
  FROM reg r LEFT JOIN anc USING (doc_id))"""
_DET_ONLY = DET[len(B) + 2 :]
RULES = f"""{STRUCT}, {_DET_ONLY}, span AS (SELECT pos.*, learning_region FROM pos JOIN str USING (doc_id) WHERE line_number > learn_start),
{LEVELS.format(rows="span")}, rules AS (SELECT lev.doc_id, lev.symbol_category, level AS assigned_level, n / (SELECT count(*) FROM span s WHERE s.doc_id = lev.doc_id) AS confidence, learning_region AS learning_source, n AS occurrences
  FROM lev JOIN str USING (doc_id))"""
_APPLY = f"""{RULES}, acat AS (SELECT doc_id, symbol_category, min(line_number) AS fl, count(*) AS n FROM pos GROUP BY ALL),
new AS (SELECT c.*, coalesce((SELECT max(assigned_level) FROM rules r WHERE r.doc_id = c.doc_id), 0) AS top FROM acat c WHERE NOT EXISTS (SELECT 1 FROM rules r WHERE r.doc_id = c.doc_id AND r.symbol_category = c.symbol_category)),
lvl AS (SELECT c.doc_id, c.symbol_category, r.assigned_level, true AS is_learned, c.n FROM acat c JOIN rules r ON r.doc_id = c.doc_id AND r.symbol_category = c.symbol_category
  UNION ALL SELECT x.doc_id, x.symbol_category, any_value(x.top) + count(*), false, any_value(x.n) FROM new x JOIN new y ON x.doc_id = y.doc_id AND y.fl <= x.fl GROUP BY x.doc_id, x.symbol_category)"""

MARK = f"""m0 AS (SELECT doc_id, idx0, raw, {_strip('raw')} AS t FROM b), m1 AS (SELECT *, {_date('t')} AS is_date, replace(replace(replace(t, ' ', ''), chr(12288), ''), chr(9), '') AS nb FROM m0),
md AS (SELECT doc_id, min(idx0) FILTER (is_date) AS d1, max(idx0) FILTER (is_date) AS d2, max(idx0) + 1 AS n FROM m1 GROUP BY doc_id),
mk AS (SELECT m1.*, d1, d2, n, CASE nb WHEN '主文' THEN 'main_text' WHEN '事實' THEN 'facts' WHEN '理由' THEN 'reasons' WHEN '事實及理由' THEN 'facts_and_reasons' WHEN '事實和理由' THEN 'facts_and_reasons' WHEN '事實與理由' THEN 'facts_and_reasons'
  ELSE CASE WHEN idx0 > d2 AND substr(nb, 1, 2) IN ('附錄', '附件', '附圖', '附表') THEN 'appendix' END END AS marker FROM m1 JOIN md USING (doc_id))"""
# Chunks: a union of the kinds, each from the marked lines.
CHUNKS = f"""{RULES}, {MARK},
sy AS (SELECT p.doc_id, p.line_number - 1 AS idx0, p.detected_symbol AS symbol, coalesce(r.assigned_level, 1) AS sl FROM pos p LEFT JOIN rules r ON r.doc_id = p.doc_id AND r.symbol_category = p.symbol_category),
dd AS (SELECT doc_id, any_value(d1) AS d1, any_value(d2) AS d2, any_value(n) AS n, min(idx0) FILTER (marker = 'main_text') AS main, min(idx0) FILTER (marker = 'appendix') AS apx FROM mk GROUP BY doc_id),
dx AS (SELECT dd.*, coalesce(main, 0) AS cs, coalesce(apx, n) - 1 AS ce, coalesce((SELECT min(idx0) FROM mk WHERE mk.doc_id = dd.doc_id AND marker <> 'appendix' AND idx0 > apx), n) - 1 AS ae FROM dd),
li AS (SELECT mk.doc_id, mk.idx0 AS i, mk.raw, is_date, marker, symbol, sl, dx.d1, dx.d2, main, apx, cs, ce, ae, marker IS NULL AND NOT is_date AND symbol IS NULL AS plain, coalesce(mk.idx0 > dx.d1 AND mk.idx0 < dx.d2, false) AS sig
  FROM mk JOIN dx ON dx.doc_id = mk.doc_id LEFT JOIN sy ON sy.doc_id = mk.doc_id AND sy.idx0 = mk.idx0),
isl AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM li WHERE i BETWEEN cs AND ce AND plain AND NOT sig),
apg AS (SELECT *, (SELECT count(*) FROM li k WHERE k.doc_id = li.doc_id AND k.marker = 'appendix' AND k.i <= li.i) AS g FROM li WHERE i BETWEEN apx AND ae AND plain),
c0 AS (
  SELECT doc_id, 0 AS br, -3 AS level, 0 AS s, max(i) AS e, 'header' AS ty, list(raw ORDER BY i) AS ls, NULL AS sym, 'header' AS id FROM li WHERE i < main GROUP BY doc_id
  UNION ALL SELECT doc_id, 1, -2, i, i, 'date', [raw], NULL, 'date_' || i FROM li WHERE i = d1 AND d1 BETWEEN cs AND ce
  UNION ALL SELECT doc_id, 2, -3, min(i), max(i), 'signature', list(raw ORDER BY i), NULL, 'signature' FROM li WHERE sig AND d1 BETWEEN cs AND ce GROUP BY doc_id
  UNION ALL SELECT doc_id, 3, -2, i, i, 'date', [raw], NULL, 'date_' || i FROM li WHERE i = d2 AND d2 > d1 AND d2 BETWEEN cs AND ce
  UNION ALL SELECT doc_id, 4, 0, i, i, marker, [raw], NULL, marker || '_' || i FROM li WHERE marker IS NOT NULL AND i BETWEEN cs AND ce
  UNION ALL SELECT doc_id, 5, sl, i, i, 'leveling_symbol', [raw], symbol, 'level_' || sl || '_' || i FROM li WHERE symbol IS NOT NULL AND i BETWEEN cs AND ce
  UNION ALL SELECT doc_id, 6, -1, min(i), max(i), 'content', list(raw ORDER BY i), NULL, 'content_' || min(i) || '_' || max(i) FROM isl GROUP BY doc_id, g
  UNION ALL SELECT doc_id, 7, 0, i, i, 'appendix', [raw], NULL, 'appendix_' || i FROM li WHERE marker = 'appendix' AND i BETWEEN apx AND ae
  UNION ALL SELECT doc_id, 8, -1, min(i), max(i), 'content', list(raw ORDER BY i), NULL, 'content_' || min(i) || '_' || max(i) FROM apg GROUP BY doc_id, g
  UNION ALL SELECT doc_id, 9, -3, any_value(d2) + 1, any_value(ce), 'footer', list(raw ORDER BY i), NULL, 'footer' FROM li WHERE i > d2 AND i <= ce AND plain AND NOT sig GROUP BY doc_id
), ch AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s, br) - 1 AS seq, level, s AS start_line, e AS end_line, ty AS chunk_type, ls AS content_lines, sym AS leveling_symbol, id AS chunk_id FROM c0)"""
_NL = lambda c: f"replace(replace({c}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
_NOBR = lambda c: f"replace(replace({c}, chr(13), ''), chr(10), '')"
# Ancestors: an earlier chunk of level 0 or more is open if no chunk between has its level or a smaller one.
TREE = f"""{CHUNKS}, ct AS (SELECT *, CASE WHEN level = 0 THEN {_strip(_NL('content_lines[1]'))} WHEN level >= 1 THEN {_strip(_NOBR('content_lines[1]'))} END AS title,
  array_to_string(list_transform(content_lines, lambda x: {_NL('x')}), chr(10)) AS txt FROM ch),
an AS (SELECT x.doc_id, x.seq, a.seq AS aseq, a.level AS alevel, a.title AS atitle FROM ct x JOIN ct a ON a.doc_id = x.doc_id AND a.seq < x.seq AND a.level >= 0 AND (x.level < 0 OR a.level < x.level)
  WHERE NOT EXISTS (SELECT 1 FROM ct k WHERE k.doc_id = x.doc_id AND k.seq > a.seq AND k.seq < x.seq AND k.level >= 0 AND k.level <= a.level))"""
_LOC = """CASE ty WHEN 'header' THEN 'H' WHEN 'footer' THEN 'H' WHEN 'signature' THEN 'SIG' WHEN 'date' THEN CASE WHEN nd = 0 THEN 'D1' ELSE 'D2' END WHEN 'appendix' THEN 'A' WHEN 'main_text' THEN 'M' WHEN 'facts' THEN 'F' WHEN 'reasons' THEN 'R'
  WHEN 'facts_and_reasons' THEN 'S' ELSE CASE WHEN regexp_matches(t1, '附[表錄件]') THEN 'A' WHEN regexp_matches(t1, '事實[及和與]理由') THEN 'S' WHEN regexp_matches(t1, '事　?實') THEN 'F' WHEN regexp_matches(t1, '理　?由') THEN 'R'
  WHEN regexp_matches(t1, '主　?文') THEN 'M' ELSE 'O' END END"""
RAG = f"""{TREE}, op AS (SELECT x.*, (SELECT max(k.seq) FROM ct k WHERE k.doc_id = x.doc_id AND k.seq < x.seq AND k.chunk_type <> 'content') AS os FROM ct x WHERE chunk_type = 'content'),
ow AS (SELECT op.*, CASE WHEN o.chunk_type = 'leveling_symbol' THEN os END AS owner FROM op LEFT JOIN ct o ON o.doc_id = op.doc_id AND o.seq = op.os),
pc AS (SELECT doc_id, owner, max(end_line) AS e, string_agg(txt, '' ORDER BY seq) AS allt, list(txt ORDER BY seq) AS tl FROM ow WHERE owner IS NOT NULL GROUP BY ALL),
paths AS (SELECT doc_id, seq, list(alevel ORDER BY aseq) AS lv, list(atitle ORDER BY aseq) AS ti FROM an GROUP BY ALL),
r0 AS (SELECT x.*, CASE chunk_type WHEN 'leveling_symbol' THEN 'hierarchical_section' WHEN 'content' THEN 'orphan_content' ELSE chunk_type END AS ty, pc.e, pc.allt, pc.tl, lv, ti, ti[1] AS t1,
    (SELECT count(*) FROM ct k WHERE k.doc_id = x.doc_id AND k.seq < x.seq AND k.chunk_type = 'date') AS nd
  FROM ct x LEFT JOIN pc ON pc.doc_id = x.doc_id AND pc.owner = x.seq LEFT JOIN paths ON paths.doc_id = x.doc_id AND paths.seq = x.seq
  WHERE NOT EXISTS (SELECT 1 FROM ow WHERE ow.doc_id = x.doc_id AND ow.seq = x.seq AND ow.owner IS NOT NULL)),
rag AS (SELECT doc_id, seq, chunk_id, ty AS chunk_type, level, start_line + 1 AS start_line, coalesce(e, end_line) + 1 AS end_line,
    CASE WHEN ty IN ('header', 'footer', 'signature', 'date') THEN upper(ty) WHEN ty = 'orphan_content' THEN 'Content' ELSE title END AS title, leveling_symbol,
    CASE WHEN ty = 'hierarchical_section' THEN coalesce(regexp_replace(array_to_string(tl, chr(10)), '^' || chr(10) || '*', ''), '') ELSE txt END AS content0,
    CASE WHEN ty = 'hierarchical_section' THEN coalesce(list_reduce(list_prepend('', tl), lambda p, q: CASE WHEN p = '' THEN q ELSE p || chr(10) || q END), '') ELSE txt END AS content,
    CASE WHEN ty = 'hierarchical_section' THEN {_bare("title || coalesce(allt, '')")} WHEN ty IN ('header', 'footer', 'signature', 'date') THEN txt WHEN level = 0 THEN {_bare('txt')} ELSE {_NOBR('txt')} END AS full_text,
    CASE WHEN ty IN ('hierarchical_section', 'orphan_content') THEN coalesce(array_to_string(list_transform(lv, lambda x: x::VARCHAR), '¦'), '') ELSE '' END AS hierarchy_path,
    CASE WHEN ty IN ('hierarchical_section', 'orphan_content') THEN coalesce(array_to_string(ti, '¦'), '') ELSE '' END AS parent_titles, {_LOC} AS location FROM r0)"""
_RAG_COLS = "doc_id, seq, chunk_id, chunk_type, level, start_line, end_line, title, leveling_symbol, content, full_text, hierarchy_path, parent_titles, location"
MTREE = f"""{TREE}, host AS (SELECT ct.doc_id, ct.seq, ct.level, CASE WHEN ct.level = -1 THEN (SELECT max(aseq) FROM an WHERE an.doc_id = ct.doc_id AND an.seq = ct.seq AND alevel >= 1) END AS h,
  CASE WHEN ct.level >= 0 THEN (SELECT max(aseq) FROM an WHERE an.doc_id = ct.doc_id AND an.seq = ct.seq) END AS parent_id, CASE WHEN ct.level >= 0 THEN (SELECT count(*) FROM an WHERE an.doc_id = ct.doc_id AND an.seq = ct.seq) ELSE 0 END AS depth FROM ct),
nd AS (SELECT ct.doc_id, coalesce(h, ct.seq) AS node_id, max(end_line) + 1 AS end_line, flatten(list(content_lines ORDER BY ct.seq)) AS cl FROM ct JOIN host ON host.doc_id = ct.doc_id AND host.seq = ct.seq GROUP BY ALL),
tree AS (SELECT nd.doc_id, node_id, parent_id, depth, row_number() OVER (PARTITION BY nd.doc_id, parent_id ORDER BY node_id) AS ordinal, ct.level, ct.chunk_type, ct.chunk_id, ct.leveling_symbol, ct.start_line + 1 AS start_line, nd.end_line, {_flat('cl')} AS content_lines
  FROM nd JOIN ct ON ct.doc_id = nd.doc_id AND ct.seq = node_id JOIN host ON host.doc_id = nd.doc_id AND host.seq = node_id)"""
_APX = lambda c: f"(length({_strip(c)}) <= 100 AND regexp_matches({_bare(c)}, '^附(錄|件|圖|表)'))"
_SECT = lambda c: f"(length({_strip(c)}) <= 20 AND {_bare(c)} IN ('主文', '事實', '理由', '事實及理由'))"
_DT = lambda c: rf"(length({_strip(c)}) <= 50 AND (regexp_matches({_strip(c)}, '^中[{WS}]*華[{WS}]*民[{WS}]*國.*\p{{Nd}}+.*年.*\p{{Nd}}+.*月.*\p{{Nd}}+.*日$') OR regexp_matches({_strip(c)}, '^\p{{Nd}}{{3,4}}[{WS}]*年[{WS}]*\p{{Nd}}{{1,2}}[{WS}]*月[{WS}]*\p{{Nd}}{{1,2}}[{WS}]*日$')))"
MD = f"""{CHUNKS}, k0 AS (SELECT *, list_filter(list_transform(content_lines, lambda x: {_strip('x')}), lambda x: x <> '') AS cl, list_filter(content_lines, lambda x: {_strip('x')} <> '') AS rl FROM ch),
k1 AS (SELECT *, array_to_string(cl, ' ') AS j, level <> -3 AND len(cl) > 0 AS shown FROM k0), k2 AS (SELECT *, {_APX('j')} AS apx, {_SECT('j')} OR {_DT('j')} OR {_APX('j')} AS h2 FROM k1),
k3 AS (SELECT *, shown AND h2 AS head, shown AND NOT h2 AND level >= 1 AS num FROM k2),
k4 AS (SELECT x.*, (SELECT count(*) FROM k3 y WHERE x.num AND y.doc_id = x.doc_id AND y.num AND y.level = x.level AND y.seq <= x.seq AND NOT EXISTS (SELECT 1 FROM k3 z WHERE z.doc_id = x.doc_id AND z.seq > y.seq AND z.seq < x.seq AND (z.head OR (z.num AND z.level < x.level)))) AS no,
  EXISTS (SELECT 1 FROM k3 y WHERE y.doc_id = x.doc_id AND y.seq <> x.seq AND abs(y.seq - x.seq) <= 5 AND regexp_matches(array_to_string(y.content_lines, ' '), '(?i)D1|D2')) AS near,
  EXISTS (SELECT 1 FROM k3 y WHERE y.doc_id = x.doc_id AND abs(y.seq - x.seq) = 1 AND y.level = -3) AS beside FROM k3 x),
k5 AS (SELECT doc_id, seq, CASE WHEN level = -3 THEN CASE WHEN len(rl) > 0 THEN list_append(rl, '') END WHEN NOT shown THEN NULL
  WHEN head AND apx AND len(cl) > 1 THEN list_append(list_concat(['## ' || cl[1], ''], cl[2:]), '') WHEN head THEN ['## ' || j, ''] WHEN level = 0 THEN [j, ''] WHEN level >= 1 THEN [repeat('    ', (level - 1)::INT) || no || '. ' || j, '']
  WHEN level = -1 AND near THEN NULL WHEN level = -1 AND (apx OR beside) THEN list_append(rl, '') WHEN level = -1 THEN [j, ''] ELSE ['*' || j || '*', ''] END AS blk FROM k4),
mdn AS (SELECT doc_id, flatten(list(blk ORDER BY seq) FILTER (blk IS NOT NULL)) AS ls FROM k5 GROUP BY doc_id)"""
DOCS = f"""{SEC}, {DATES}, cn AS (SELECT doc_id, {_COUNTS} FROM sec GROUP BY doc_id), dc AS (SELECT doc_id, count(*) AS dates_count FROM dates GROUP BY doc_id),
ds0 AS (SELECT j.doc_id, length(jfull) AS n_chars, cn.* EXCLUDE (doc_id), coalesce(dates_count, 0) AS dates_count FROM judgments j LEFT JOIN cn USING (doc_id) LEFT JOIN dc USING (doc_id)),
ds AS (SELECT *, CASE WHEN n_chars IS NULL THEN 'ERROR' ELSE coalesce(nullif(CASE WHEN n_main_text > 0 THEN 'M' ELSE '' END || CASE WHEN n_facts_and_reasons > 0 THEN 'S' WHEN n_facts > 0 THEN 'F' ELSE '' END
  || CASE WHEN n_reasons > 0 AND n_facts_and_reasons = 0 THEN 'R' ELSE '' END || CASE WHEN dates_count > 1 THEN 'D2' WHEN dates_count = 1 THEN 'D1' ELSE '' END, ''), 'N') END AS symbol FROM ds0)"""
_UNP = " UNION ALL ".join(f"SELECT '{s}' AS section, n_{s} AS n FROM ds WHERE symbol <> 'ERROR'" for s in NAMES)
PARTS = """fp AS (SELECT doc_id, string_split(regexp_replace(file_name, '\\.[^.,/]*$', ''), ',') AS p FROM judgments)"""
DOCL = "dl AS (SELECT doc_id, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS idx0 FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))"
_FILE = """SELECT doc_id, count(*) AS total_lines, count(*) FILTER (WHERE final_prediction) AS total_markers, count(*) FILTER (WHERE method_used = 'ultra_strict_pua') AS ultra_strict_markers, count(*) FILTER (WHERE final_prediction AND method_used = 'soft_rule_bert') AS bert_refined_markers,
  count(*) FILTER (WHERE final_prediction AND method_used IN ('ultra_strict_pua', 'soft_rule_only', 'rule_rejected', 'empty_line')) AS rule_only_markers, count(*) FILTER (WHERE rule_based_score > 0) AS candidates, count(*) FILTER (WHERE bert_score > 0 AND bert_score < 1) AS bert_processed FROM {t} GROUP BY doc_id"""
_STATS = "SELECT count(*) AS count, coalesce(avg(bert_score), 0) AS mean, coalesce(stddev_pop(bert_score), 0) AS std, coalesce(min(bert_score), 0) AS min, coalesce(max(bert_score), 0) AS max FROM {t} WHERE method_used IN ('soft_rule_only', 'soft_rule_bert') AND bert_score > 0"
PROC = f"""{CHUNKS}, acat AS (SELECT doc_id, symbol_category, min(line_number) AS fl, count(*) AS n FROM pos GROUP BY ALL),
new AS (SELECT c.*, coalesce((SELECT max(assigned_level) FROM rules r WHERE r.doc_id = c.doc_id), 0) AS top FROM acat c WHERE NOT EXISTS (SELECT 1 FROM rules r WHERE r.doc_id = c.doc_id AND r.symbol_category = c.symbol_category)),
lvl AS (SELECT c.doc_id, c.symbol_category, r.assigned_level, true AS is_learned, c.n FROM acat c JOIN rules r ON r.doc_id = c.doc_id AND r.symbol_category = c.symbol_category
  UNION ALL SELECT x.doc_id, x.symbol_category, any_value(x.top) + count(*), false, any_value(x.n) FROM new x JOIN new y ON x.doc_id = y.doc_id AND y.fl <= x.fl GROUP BY x.doc_id, x.symbol_category),
proc AS (SELECT s.doc_id, total_lines, coalesce(total_lines - learn_start, 0) AS learning_lines, coalesce((SELECT sum(n) FROM lvl WHERE lvl.doc_id = s.doc_id), 0)::BIGINT AS total_symbols_detected, (SELECT count(*) FROM rules r WHERE r.doc_id = s.doc_id) AS learned_rules_count,
  coalesce((SELECT count(*) FILTER (WHERE is_learned) / nullif(count(*), 0) FROM lvl WHERE lvl.doc_id = s.doc_id), 0) AS rule_coverage, (SELECT count(DISTINCT assigned_level) FROM lvl WHERE lvl.doc_id = s.doc_id) AS final_levels, (SELECT count(*) FROM ch WHERE ch.doc_id = s.doc_id) AS line_based_chunks_count, learning_region
  FROM str s)"""
_TRAD = "CASE WHEN contains(symbol, 'S') THEN 'combined' WHEN contains(symbol, 'M') AND contains(symbol, 'F') THEN 'separated' WHEN symbol[1] = 'R' THEN 'procedural' WHEN symbol[1] = 'M' AND NOT contains(symbol, 'R') THEN 'main_only' WHEN symbol[1] = 'F' AND NOT contains(symbol, 'R') THEN 'facts_only' ELSE 'incomplete' END"


def _w(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


ORACLE: dict[str, str] = {
    "jdg_s1_judgments": "SELECT doc_id, file_name, court, coalesce(jid, 'Unknown') AS jid, jfull FROM judgments",
    "jdg_s5_raw_length": "SELECT doc_id, length(jfull) AS n_chars FROM judgments",
    "src_s1_json_files": "SELECT doc_id || '.json' AS file_name, coalesce(jid, 'Unknown') AS jid, jfull, CASE WHEN jfull IS NULL THEN 'No JFULL field found' END AS error FROM judgments",
    "src_s6_training_csv": "SELECT coalesce(line_text, '') AS line_text, coalesce(sentiment, '') AS sentiment, count(*) AS count FROM labelled_lines GROUP BY ALL",
    "jdg_lines_crlf": _w(A, "SELECT doc_id, idx0, raw FROM a"),
    "jdg_lines_lf": _w(B, "SELECT doc_id, idx0, raw FROM b"),
    "jdg_p1_without_space": _w(B, f"SELECT doc_id, idx0, {_bare('raw')} AS bare, {_strip('raw')} AS stripped FROM b"),
    "jdg_p2_line_labels": _w(A, f"SELECT doc_id, idx0, {LABEL} AS label FROM a"),
    "jdg_p3_date_lines": _w(B, f"SELECT doc_id, idx0 FROM b WHERE {_date('raw')}"),
    "jdg_w1_carry_forward": _w(SEC, "SELECT doc_id, section, row_number() OVER (PARTITION BY doc_id, section ORDER BY idx0) - 1 AS pos, raw AS line FROM sec0"),
    "jdg_t1_sections": _w(SEC, "SELECT doc_id, section, row_number() OVER (PARTITION BY doc_id, section ORDER BY idx0) - 1 AS pos, raw AS line FROM sec"),
    "jdg_t1_section_stats": _w(SEC, f"SELECT doc_id, {_COUNTS} FROM sec GROUP BY doc_id"),
    "jdg_t2_dates": _w(DATES, "SELECT * FROM dates"),
    "jdg_p5_private_use": _w(F1, "SELECT doc_id, idx0, printf('U+%04X', unicode(symbol)) AS code FROM f WHERE pua IS NOT NULL"),
    "jdg_p6_symbol_category": _w(F1, "SELECT symbol, coalesce(category, '無效字符') AS category, count(*) AS count FROM f GROUP BY ALL"),
    "jdg_p7_pua_group": _w(F1, "SELECT doc_id, idx0, pua AS pua_group FROM f WHERE pua IS NOT NULL"),
    "jdg_p9_ultra_strict": _w(ULTRA, "SELECT * FROM ultra"),
    "jdg_p10_strict_pua": _w(DET, "SELECT doc_id, line_number, detected_symbol FROM det WHERE method_used = 'ultra_strict_pua'"),
    "jdg_p11_soft_candidates": _w(DET, "SELECT doc_id, line_number, detected_symbol, symbol_category FROM det WHERE method_used = 'soft_rule_only'"),
    "jdg_p12_detect": _w(DET, "SELECT * FROM det"),
    "jdg_j1_dictionary_join": _w(F1, "SELECT doc_id, idx0, symbol, category FROM f WHERE category IS NOT NULL"),
    "jdg_w2_previous_line": _w(B, "SELECT x.doc_id, x.idx0, coalesce(suffix(y.raw, chr(13)), true) AS proper FROM b x LEFT JOIN b y ON y.doc_id = x.doc_id AND y.idx0 = x.idx0 - 1"),
    "jdg_a1_ultra_by_category": _w(ULTRA, "SELECT doc_id, category, count(*) AS count, string_agg(line_number || symbol, '¦' ORDER BY line_number) AS members FROM ultra GROUP BY ALL"),
    "jdg_a2_ultra_by_pua_group": _w(ULTRA, "SELECT category, count(*) AS count FROM ultra WHERE is_pua GROUP BY ALL"),
    "jdg_a3_ultra_by_code": _w(ULTRA, "SELECT unicode_code, count(*) AS count, count(*) AS compliant FROM ultra GROUP BY ALL"),
    "jdg_a3b_ultra_by_level": _w(ULTRA + ", pos AS (SELECT *, category AS symbol_category FROM ultra), " + LEVELS.format(rows="pos"), "SELECT doc_id, level, n AS count FROM lev"),
    "jdg_k7_top_codes": _w(ULTRA, "SELECT unicode_code, count(*) AS count, count(*) AS compliant FROM ultra GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 20"),
    "jdg_a4_by_method": _w(DET, "SELECT method_used, count(*) AS total, count(*) FILTER (WHERE final_prediction) AS positive FROM det GROUP BY ALL"),
    "jdg_a5_hierarchy_levels": _w(
        DET + ", " + LEVELS.format(rows="pos"),
        "SELECT doc_id, symbol_category, level, n AS count, (SELECT unicode(detected_symbol) >= 57344 AND unicode(detected_symbol) NOT BETWEEN 63744 AND 983039 FROM pos p WHERE p.doc_id = lev.doc_id AND p.symbol_category = lev.symbol_category AND p.line_number = lev.fl) AS is_pua, "
        + _EX.format(agg="string_agg(line_number || ':' || CASE WHEN length(line_text) > 50 THEN substr(line_text, 1, 50) || '...' ELSE line_text END, '¦' ORDER BY line_number)", rows="pos", t="lev")
        + " AS examples FROM lev",
    ),
    "jdg_a6_by_category": _w(DET, "SELECT symbol_category, count(*) AS count FROM pos GROUP BY ALL"),
    "jdg_a7_score_stats": _w(DET, _STATS.format(t="det")),
    "jdg_a7b_summary": _w(DET, "SELECT count(*) AS total_lines, count(*) FILTER (WHERE final_prediction) AS positive, count(*) FILTER (WHERE final_prediction) / count(*) AS positive_ratio, count(*) FILTER (WHERE method_used = 'ultra_strict_pua') AS ultra_strict FROM det"),
    "jdg_a12b_file_stats": _w(DET, _FILE.format(t="det")),
    "jdg_a12b_batch_totals": _w(
        DET,
        "SELECT count(DISTINCT doc_id) AS files, count(*) AS total_lines, count(*) FILTER (WHERE final_prediction) AS total_markers, count(*) FILTER (WHERE method_used = 'ultra_strict_pua') AS ultra_strict_markers, 0::BIGINT AS bert_refined_markers, count(*) FILTER (WHERE final_prediction) AS rule_only_markers, count(*) FILTER (WHERE rule_based_score > 0) AS candidates, 0::BIGINT AS bert_processed, count(*) FILTER (WHERE rule_based_score > 0) / count(*) AS candidate_rate, count(*) FILTER (WHERE final_prediction) / count(*) FILTER (WHERE rule_based_score > 0) AS marker_rate FROM det",
    ),
    "jdg_a12c_marker_projection": _w(DET, "SELECT doc_id, line_number, printf('U+%04X', unicode(detected_symbol)) AS unicode_code, symbol_category, rule_based_score, bert_score, method_used = 'ultra_strict_pua' AS is_pua FROM pos"),
    "jdg_k5_most_markers": _w(DET, "SELECT doc_id, count(*) FILTER (WHERE final_prediction) AS total_markers FROM det GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 20"),
    "det_a4_by_method": "SELECT method_used, count(*) AS total, count(*) FILTER (WHERE final_prediction) AS positive FROM detections GROUP BY ALL",
    "det_a7_score_stats": _STATS.format(t="detections"),
    "det_a12b_file_stats": _FILE.format(t="detections"),
    "jdg_t3_structure": _w(STRUCT, "SELECT * FROM str"),
    "jdg_a13_rules": _w(RULES, "SELECT *, " + _EX.format(agg="string_agg(substr(line_text, 1, 50) || '...', '¦' ORDER BY line_number)", rows="span", t="rules") + " AS examples FROM rules"),
    "jdg_j4_category_levels": _w(_APPLY, "SELECT doc_id, symbol_category, assigned_level, is_learned, n AS count, " + _EX.format(agg="string_agg(substr(line_text, 1, 50) || '...', '¦' ORDER BY line_number)", rows="pos", t="lvl") + " AS examples FROM lvl"),
    "jdg_a14_hierarchy": _w(_APPLY, "SELECT p.doc_id, line_number, detected_symbol, p.symbol_category, assigned_level, is_learned AS is_learned_rule, line_text, method_used, bert_score FROM pos p JOIN lvl ON lvl.doc_id = p.doc_id AND lvl.symbol_category = p.symbol_category"),
    "jdg_a14_coverage": _w(_APPLY, "SELECT doc_id, count(*) FILTER (WHERE is_learned) / count(*) AS rule_coverage, count(DISTINCT assigned_level) AS total_levels, sum(n)::BIGINT AS total_symbols FROM lvl GROUP BY doc_id"),
    "jdg_p4_special_markers": _w(B + ", " + MARK, "SELECT doc_id, marker AS marker_type, idx0 FROM mk WHERE marker IS NOT NULL UNION ALL SELECT doc_id, 'dates', idx0 FROM mk WHERE is_date"),
    "jdg_t4_line_chunks": _w(CHUNKS, f"SELECT doc_id, seq, level, start_line, end_line, chunk_type, {_flat('content_lines')} AS content_lines, leveling_symbol, chunk_id FROM ch"),
    "jdg_a15_level_content": _w(
        CHUNKS,
        f"SELECT doc_id, 'Lv_' || level AS level_key, {_flat('flatten(list(list_prepend(h, content_lines) ORDER BY seq))')} AS content, sum(len(list_filter(content_lines, lambda x: NOT starts_with(x, '['))))::BIGINT AS n_lines FROM (SELECT *, '[' || chunk_type || ':' || (start_line + 1) || '-' || (end_line + 1) || ']' AS h FROM ch) GROUP BY doc_id, level",
    ),
    "jdg_a15b_chunk_types": _w(CHUNKS, "SELECT level, chunk_type, count(*) AS count FROM ch GROUP BY ALL"),
    "jdg_t5_rag_chunks": _w(RAG, f"SELECT {_RAG_COLS} FROM rag"),
    "jdg_p20_locations": _w(RAG, "SELECT chunk_type, location, count(*) AS count FROM rag GROUP BY ALL"),
    "jdg_t6_machine_tree": _w(MTREE, "SELECT * FROM tree"),
    "jdg_a16_location_stats": _w(RAG, "SELECT location, count(*) AS count, count(*) * 100 / (SELECT count(*) FROM rag) AS percent, string_agg(DISTINCT chunk_type, ',' ORDER BY chunk_type) AS chunk_types FROM rag GROUP BY location"),
    "jdg_k2_machine_payload": _w(
        RAG + PROC.removeprefix(CHUNKS) + ", rc AS (SELECT doc_id, count(*) AS n, string_agg(concat_ws('|', chunk_id, chunk_type, level, start_line, end_line, title, leveling_symbol, location, full_text), '¦' ORDER BY seq) AS chunks FROM rag GROUP BY doc_id)",
        "SELECT doc_id, file_name AS filename, learning_region, total_lines, total_symbols_detected, learned_rules_count, final_levels, coalesce(n, 0) AS rag_chunks_count, chunks FROM proc JOIN judgments USING (doc_id) LEFT JOIN rc USING (doc_id)",
    ),
    "jdg_a19_processing_stats": _w(PROC, "SELECT * EXCLUDE (learning_region) FROM proc"),
    "jdg_a12_batch_totals": _w(PROC, "SELECT learning_region, count(*) AS documents, sum(total_lines)::BIGINT AS lines, sum(total_symbols_detected)::BIGINT AS symbols, avg(rule_coverage) AS mean_coverage FROM proc GROUP BY ALL"),
    "jdg_p21_summaries": _w(PROC, "SELECT doc_id, file_name || ': region ' || learning_region || ', ' || total_symbols_detected || ' symbols, ' || learned_rules_count || ' rules, ' || final_levels || ' levels, ' || line_based_chunks_count || ' chunks' AS summary FROM proc JOIN judgments USING (doc_id)"),
    "rag_a16_location_stats": "SELECT coalesce(location, 'MISSING') AS location, count(*) AS count, count(*) * 100 / (SELECT count(*) FROM rag_chunks) AS percent, coalesce(string_agg(DISTINCT chunk_type, ',' ORDER BY chunk_type), '') AS chunk_types FROM rag_chunks GROUP BY ALL",
    "jdg_t7_markdown": _w(
        MD + ", fin AS (SELECT mdn.doc_id, list_concat(['# ' || coalesce(file_name, ''), '- learning_region: ' || learning_region, ''], ls) AS al FROM mdn JOIN judgments USING (doc_id) JOIN str USING (doc_id))",
        f"SELECT doc_id, {_strip('array_to_string(list_transform(al, lambda x: ' + _rstrip('x') + '), chr(10))')} || chr(10) AS markdown FROM fin",
    ),
    "jdg_p19_second_date": _w(CHUNKS, rf"SELECT doc_id, coalesce(min(seq) FILTER (level = -2 OR regexp_matches(array_to_string(content_lines, ' '), '中[{WS}]*華[{WS}]*民[{WS}]*國.*年.*月.*日')), -1) AS position FROM ch GROUP BY doc_id"),
    "jdg_p18_between_marks": _w(CHUNKS, "SELECT doc_id, seq FROM ch x WHERE EXISTS (SELECT 1 FROM ch y WHERE y.doc_id = x.doc_id AND y.seq <> x.seq AND abs(y.seq - x.seq) <= 5 AND regexp_matches(array_to_string(y.content_lines, ' '), '(?i)D1|D2'))"),
    "jdg_p13_p16_text_kinds": _w(
        B,
        rf"SELECT * FROM (SELECT doc_id, idx0, {_APX('raw')} AS appendix, regexp_matches({_strip('raw')}, '^(附錄|附件|附圖|附表[一二三四五六七八九十\p{{Nd}}]*$)') AS appendix_header, {_SECT('raw')} AS section, {_DT('raw')} AS date FROM b) WHERE appendix OR appendix_header OR section OR date",
    ),
    "lc_p17_sanitize": f"SELECT row_id, array_to_string(list_filter(list_transform(content_lines, lambda x: {_strip('x')}), lambda x: x <> ''), '¦') AS lines FROM line_chunks",
    "jdg_a9_part_counts": _w(PARTS, "SELECT kind, value, count(*) AS count FROM (SELECT unnest([{'kind': 'year', 'value': p[2]}, {'kind': 'case_type', 'value': p[3]}, {'kind': 'court', 'value': p[1]}], recursive := true) FROM fp WHERE len(p) >= 6) GROUP BY ALL"),
    "jdg_a10_doc_stats": _w(DOCS, "SELECT * FROM ds"),
    "jdg_a8_section_summary": _w(DOCS + f", un AS ({_UNP})", "SELECT section, count(*) FILTER (WHERE n > 0) AS present, count(*) FILTER (WHERE n = 0) AS empty, avg(n) AS avg, list_sort(list(n))[count(*) // 2 + 1] AS median, min(n) AS min, max(n) AS max FROM un GROUP BY section"),
    "jdg_a9b_section_presence": _w(DOCS + f", un AS ({_UNP})", "SELECT section, count(*) FILTER (WHERE n > 0) AS present FROM un GROUP BY section"),
    "jdg_a10_class_counts": _w(DOCS, "SELECT symbol, count(*) AS count, CASE WHEN symbol <> 'ERROR' THEN count(*) * 100 / (SELECT count(*) FROM ds WHERE symbol <> 'ERROR') END AS percent FROM ds GROUP BY symbol"),
    "jdg_a10b_traditional": _w(DOCS, f"SELECT {_TRAD} AS class, count(*) AS count FROM ds WHERE symbol <> 'ERROR' GROUP BY ALL"),
    "jdg_a10c_largest": _w(DOCS, "SELECT symbol, count(*) AS count, avg(n_main_text) AS mean_main_text, avg(n_facts) AS mean_facts, avg(n_reasons) AS mean_reasons, avg(n_facts_and_reasons) AS mean_facts_and_reasons FROM ds WHERE symbol <> 'ERROR' GROUP BY symbol ORDER BY 2 DESC, 1 LIMIT 3"),
    "jdg_a11_date_summary": _w(DATES, "SELECT count(DISTINCT doc_id) AS files_with_dates, count(*) AS total_dates FROM dates"),
    "jdg_a11_month_counts": _w(DATES, "SELECT year || '年' || month || '月' AS month, count(*) AS count FROM dates GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "jdg_a11b_sizes": "SELECT avg(n) / 1024 AS avg_kb, list_sort(list(n))[count(*) // 2 + 1] / 1024 AS median_kb, min(n) / 1024 AS min_kb, max(n) / 1024 AS max_kb FROM (SELECT length(jfull) AS n FROM judgments WHERE jfull IS NOT NULL)",
    "jdg_a11c_errors": "SELECT 'Error processing' AS kind, count(*) AS count FROM judgments WHERE jfull IS NULL HAVING count(*) > 0",
    "ll_a18_class_balance": "SELECT sentiment, count(*) AS count FROM labelled_lines GROUP BY ALL",
    "ll_u6_split": """WITH l AS (SELECT CASE lower(trim(sentiment)) WHEN 'positive' THEN 1.0 WHEN 'negative' THEN 0.0 END::DOUBLE AS label, count(*) AS n FROM labelled_lines GROUP BY 1)
SELECT label, true AS is_train, ceil(n * 0.8)::BIGINT AS count FROM l WHERE label IS NOT NULL UNION ALL SELECT label, false, n - ceil(n * 0.8)::BIGINT FROM l WHERE label IS NOT NULL""",
    "det_a17_metrics": """WITH r AS (SELECT detected_symbol IS NOT NULL AS y, final_prediction AS p, bert_score AS s FROM detections WHERE bert_score IS NOT NULL AND final_prediction IS NOT NULL),
k AS (SELECT y, p, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS rk FROM r),
c AS (SELECT count(*) FILTER (WHERE NOT y AND NOT p) AS tn, count(*) FILTER (WHERE NOT y AND p) AS fp, count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE y AND p) AS tp, sum(rk) FILTER (y) AS ranks, count(*) FILTER (WHERE y) AS np, count(*) FILTER (WHERE NOT y) AS nn FROM k)
SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, (ranks - np * (np + 1) / 2) / (np * nn) AS auc, tn, fp, fn, tp FROM c""",
    "doc_lines": _w(DOCL, "SELECT doc_id, count(*) AS n_lines, sum(length(raw))::BIGINT AS n_chars FROM dl GROUP BY doc_id"),
    "doc_w5_islands": _w(DOCL, f"SELECT doc_id, min(idx0) AS first, max(idx0) AS last FROM (SELECT doc_id, idx0, idx0 - row_number() OVER (PARTITION BY doc_id ORDER BY idx0) AS g FROM dl WHERE {_strip('raw')} <> '') GROUP BY doc_id, g"),
    "doc_w3_first_appearance": _w(DOCL + f", c AS (SELECT doc_id, substr({_strip('raw')}, 1, 1) AS c, min(idx0) AS f FROM dl WHERE {_strip('raw')} <> '' GROUP BY ALL)", "SELECT x.doc_id, x.c, count(DISTINCT y.f) AS rank FROM c x JOIN c y ON y.doc_id = x.doc_id AND y.f <= x.f GROUP BY x.doc_id, x.c"),
    "doc_a8_length_stats": "SELECT source, count(*) AS docs, list_sort(list(length(text)))[count(*) // 2 + 1] AS median, min(length(text)) AS min, max(length(text)) AS max FROM documents WHERE text IS NOT NULL GROUP BY source",
    "doc_top_sources": "SELECT source, count(*) AS count FROM documents GROUP BY source ORDER BY 2 DESC, 1 LIMIT 10",
}

# Sums of doubles depend on their order: both engines round these columns.
ROUNDED: dict[str, list[str]] = {
    "jdg_a7_score_stats": ["mean", "std", "min", "max"],
    "det_a7_score_stats": ["mean", "std", "min", "max"],
    "jdg_a7b_summary": ["positive_ratio"],
    "jdg_a12b_batch_totals": ["candidate_rate", "marker_rate"],
    "jdg_a13_rules": ["confidence"],
    "jdg_a14_coverage": ["rule_coverage"],
    "jdg_a16_location_stats": ["percent"],
    "rag_a16_location_stats": ["percent"],
    "jdg_a19_processing_stats": ["rule_coverage"],
    "jdg_a12_batch_totals": ["mean_coverage"],
    "jdg_a8_section_summary": ["avg"],
    "jdg_a10_class_counts": ["percent"],
    "jdg_a10c_largest": ["mean_main_text", "mean_facts", "mean_reasons", "mean_facts_and_reasons"],
    "jdg_a11b_sizes": ["avg_kb", "median_kb", "min_kb", "max_kb"],
    "det_a17_metrics": ["accuracy", "precision", "recall", "f1", "auc"],
}
DIGITS = 6
for _name, _columns in ROUNDED.items():
    _replace = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in _columns)
    ORACLE[_name] = f"SELECT * REPLACE ({_replace}) FROM ({ORACLE[_name]})"
