"""For each query that SQL can express, the same in DuckDB's SQL."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_TREE = """
WITH RECURSIVE n AS (
  SELECT s.id, min(s.parent_section_id) FILTER (WHERE s.parent_section_id IN (SELECT id FROM sections)) AS up
  FROM sections s WHERE s.id IS NOT NULL GROUP BY s.id
), t AS (
  SELECT id, id AS root_id, 0 AS depth, CAST(id AS VARCHAR) AS path, [id] AS way FROM n WHERE up IS NULL
  UNION ALL
  SELECT n.id, t.root_id, t.depth + 1, t.path || '/' || n.id, list_append(t.way, n.id) FROM t JOIN n ON n.up = t.id
), lost AS (
  SELECT id, up FROM n WHERE id NOT IN (SELECT id FROM t)
), walk AS (
  SELECT id, up AS anc FROM lost
  UNION
  SELECT walk.id, lost.up FROM walk JOIN lost ON lost.id = walk.anc
), circ AS (
  SELECT DISTINCT id FROM walk WHERE id = anc
), caught AS (
  SELECT walk.id, min(walk.anc) AS root_id FROM walk JOIN circ ON circ.id = walk.anc GROUP BY walk.id
)
"""

ORACLES["p1_found"] = f"""{_TREE}
SELECT id, root_id FROM caught
UNION
SELECT DISTINCT t.id, t.root_id FROM t JOIN sections s ON s.id = t.id WHERE s.level <> t.depth
"""

ORACLES["p1_paths"] = f"""{_TREE}
SELECT id, root_id, CAST(depth AS BIGINT) AS depth, false AS in_cycle, path FROM t
UNION ALL
SELECT id, root_id, NULL, true, NULL FROM caught
"""

ORACLES["p1_descendants"] = f"""{_TREE}
SELECT way[k] AS ancestor_id, id, CAST(depth - k + 1 AS BIGINT) AS distance
FROM (SELECT id, depth, way, unnest(range(1, depth + 1)) AS k FROM t)
"""

# White space as Python has it.
_WS = r"[\p{Z}\t\n\x0b\f\r\x{85}\x1c-\x1f]"
_W = r"[\p{L}\p{N}_]"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{_WS}+'), lambda w: w <> '')"


_Q = "q AS (SELECT lower(query) AS query, min(id) AS query_id FROM search_logs WHERE query IS NOT NULL GROUP BY 1)"
_ROUTE = rf"""{_Q}, routed AS (
  SELECT query_id, query, CASE
    WHEN regexp_matches(s, '^(what is|define|meaning of)\b') THEN 'definition' WHEN regexp_matches(s, '^(summarize|summary of|tl;?dr)\b') THEN 'summary'
    WHEN regexp_matches(s, '^(how to|steps to|guide for)\b') THEN 'procedure' WHEN regexp_matches(s, '\b(vs|versus|compare|difference between)\b') THEN 'comparison'
    WHEN len({_words("s")}) < 3 THEN 'keyword' ELSE 'qa' END AS intent
  FROM (SELECT *, {_strip("query")} AS s FROM q)
), kinds AS (SELECT * FROM (VALUES ('definition', 'semantic', 0.8::DOUBLE), ('summary', 'semantic', 1.0), ('procedure', 'hybrid', 0.6), ('comparison', 'hybrid', 0.5), ('keyword', 'lexical', 0.2), ('qa', 'hybrid', 0.7)) t(intent, strategy, alpha)),
r AS (SELECT query_id, query, intent, strategy, alpha FROM routed JOIN kinds USING (intent))"""

ORACLES["intent_route"] = f"WITH {_ROUTE} SELECT query_id, intent, strategy, alpha FROM r"

_BM25 = f"""c AS (SELECT id AS chunk_id, max(doc_id) AS doc_id, max(coalesce(content, '')) AS t FROM chunks WHERE id IS NOT NULL GROUP BY id),
w AS (SELECT chunk_id, doc_id, {_words("lower(t)")} AS ws FROM c),
p AS (SELECT chunk_id, doc_id, len(ws) AS dl, unnest(ws) AS term FROM w),
tf AS (SELECT term, chunk_id, doc_id, dl, count(*) AS tf FROM p GROUP BY ALL),
size AS (SELECT count(*) AS n, avg(len(ws)) AS avgdl FROM w),
raw AS (SELECT term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS idf0, any_value(avgdl) AS avgdl FROM tf, size GROUP BY term, n),
idf AS (SELECT term, avgdl, CASE WHEN idf0 < 0 THEN 0.25 * (SELECT avg(idf0) FROM raw) ELSE idf0 END AS idf FROM raw),
qt AS (SELECT query_id, unnest({_words("lower(query)")}) AS term FROM q),
scored AS (SELECT query_id, chunk_id, doc_id, round(sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM qt JOIN idf USING (term) JOIN tf USING (term) GROUP BY ALL)"""
_TOP = "SELECT query_id, chunk_id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM {0}) WHERE rank <= {1}"

ORACLES["bm25_topk"] = f"WITH {_Q}, {_BM25} {_TOP.format('(SELECT * FROM scored WHERE score > 0)', 10)}"
ORACLES["bm25_filtered"] = f"WITH {_Q}, {_BM25} " + _TOP.format("(SELECT * FROM scored WHERE score > 0 AND doc_id IN (SELECT id FROM pdf_documents WHERE status = 'indexed'))", 10)

_KNN = "SELECT a.vec_id AS query_id, b.vec_id AS chunk_id, round(1 / (1 + power(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 2)), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0"
ORACLES["knn_l2"] = _TOP.format(f"({_KNN})", 10)
ORACLES["knn_filtered"] = _TOP.format(f"({_KNN} AND b.label < 3)", 10)

_RRF = f"""WITH {_ROUTE}, {_BM25},
lex AS ({_TOP.format("(SELECT * FROM scored WHERE score > 0 AND query_id IN (SELECT query_id FROM r WHERE alpha < 1))", 20)}),
den0 AS (SELECT query_id, b.vec_id AS chunk_id, round(1 / (1 + power(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 2)), 6) AS score FROM r JOIN embeddings a ON a.vec_id = r.query_id % 500 CROSS JOIN embeddings b),
den AS ({_TOP.format("den0", 20)}),
j AS (SELECT coalesce(lex.query_id, den.query_id) AS query_id, coalesce(lex.chunk_id, den.chunk_id) AS chunk_id, lex.rank AS lr, den.rank AS dr FROM lex FULL JOIN den ON lex.query_id = den.query_id AND lex.chunk_id = den.chunk_id),
s AS (SELECT j.query_id, chunk_id, lr, dr, round(coalesce(2 * (1 - alpha) / (60 + lr), 0) + coalesce(2 * alpha / (60 + dr), 0), 9) AS score FROM j JOIN r USING (query_id)),
fused AS (SELECT query_id, chunk_id, score, CASE WHEN dr IS NULL THEN 'bm25' WHEN lr IS NULL THEN 'vector' ELSE 'hybrid' END AS source, rank
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, lr NULLS LAST, dr NULLS LAST) AS INTEGER) AS rank FROM s) WHERE rank <= 10)"""
ORACLES["rrf_fuse"] = f"{_RRF} SELECT query_id, chunk_id, score, source, rank FROM fused"
ORACLES["hybrid_enriched"] = f"""{_RRF},
ch AS (SELECT id, max(doc_id) AS doc_id, max(section_id) AS section_id, max(page_number) AS page_number FROM chunks WHERE id IS NOT NULL GROUP BY id),
dd AS (SELECT id, max(filename) AS filename, max(title) AS title FROM pdf_documents WHERE id IS NOT NULL GROUP BY id),
ss AS (SELECT id, max(title) AS title FROM sections WHERE id IS NOT NULL GROUP BY id)
SELECT query_id, rank, chunk_id, score, source, ch.doc_id, page_number, coalesce(filename, '') AS filename, coalesce(nullif(dd.title, ''), filename, '') AS document_title, coalesce(ss.title, '') AS section_title
FROM fused JOIN ch ON ch.id = chunk_id LEFT JOIN dd ON dd.id = ch.doc_id LEFT JOIN ss ON ss.id = ch.section_id"""

ORACLES["context_expand"] = """WITH one AS (SELECT id, max(doc_id) AS doc_id, max(chunk_index) AS chunk_index, max(content) AS content FROM chunks WHERE id IS NOT NULL GROUP BY id),
m AS (SELECT doc_id, chunk_index, min(content) AS content FROM one GROUP BY ALL),
x AS (SELECT one.id, one.doc_id, concat_ws(chr(10) || chr(10), p.content, one.content, f.content) AS e FROM one
  LEFT JOIN m p ON p.doc_id = one.doc_id AND p.chunk_index = one.chunk_index - 1 LEFT JOIN m f ON f.doc_id = one.doc_id AND f.chunk_index = one.chunk_index + 1)
SELECT id, doc_id, md5(e) AS expanded_md5, CAST(length(e) AS INTEGER) AS expanded_length FROM x"""

_HEX = "(strpos('0123456789abcdef', substr(h, k, 1)) - 1)"
ORACLES["fallback_text"] = f"""WITH {_Q},
j AS (SELECT query_id, doc_id, query, text, greatest(0, strpos(lower(text), query) - 101) AS start FROM documents, q WHERE contains(lower(text), query)),
m AS (SELECT *, md5(doc_id || '.txt:' || start) AS h FROM j)
SELECT query_id, doc_id, CAST(list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 33), lambda k: CAST({_HEX} AS BIGINT))), lambda a, x: (a * 16 + x) % 10000) AS INTEGER) AS result_id, CAST(start AS INTEGER) AS start,
  '...' || replace(substr(text, start + 1, length(query) + 200), chr(10), ' ') || '...' AS snippet FROM m"""

_CLEAN = rf"""regexp_replace(regexp_replace(regexp_replace(text, '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), '[^\t\n\r\x20-\x7e\x{{a0}}-\x{{ffff}}]', '', 'g'), '[^\p{{L}}\p{{N}}_\p{{Z}}\t\n\x0b\f\r\x{{85}}.,;:!?''"-]{{3,}}', ' ', 'g')"""
_PAGE_NO = rf"^{_WS}*(?:[-–—]?{_WS}*[0-9]{{1,4}}{_WS}*[-–—]?|[Pp]age{_WS}+[0-9]+{_WS}*(?:of{_WS}+[0-9]+)?){_WS}*$"
ORACLES["clean_text"] = rf"""WITH a AS (SELECT doc_id, regexp_replace({_CLEAN}, '({_W})-\n({_W})', '\1\2', 'g') AS t FROM documents),
b AS (SELECT doc_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: {_strip("regexp_replace(x, '[ \t]+', ' ', 'g')")}), lambda x: NOT regexp_matches(x, '{_PAGE_NO}')) AS ls FROM a)
SELECT doc_id, md5({_strip("array_to_string(ls, chr(10))")}) AS clean_md5 FROM b"""

_EDGES = f"""p AS (SELECT doc_id, page_number, {_strip("max(text)")} AS t FROM page_results GROUP BY ALL),
l AS (SELECT doc_id, CASE WHEN t <> '' THEN string_split(t, chr(10)) END AS ls FROM p),
n AS (SELECT doc_id, count(*) AS n FROM l GROUP BY ALL HAVING count(*) >= 3),
e AS (SELECT doc_id, 'first' AS edge, {_strip("ls[1]")} AS line FROM l UNION ALL SELECT doc_id, 'last', {_strip("ls[-1]")} FROM l),
k AS (SELECT doc_id, edge, line, count(*) AS k FROM e WHERE line <> '' GROUP BY ALL),
edges AS (SELECT DISTINCT doc_id, line FROM k JOIN n USING (doc_id) WHERE k >= greatest(3, floor(n * 0.4)))"""
ORACLES["header_footer"] = f"WITH {_EDGES} SELECT doc_id, line FROM edges"

_FULL = f"""ft AS (SELECT doc_id, string_agg(t, chr(10) || chr(10) ORDER BY page_number) AS t FROM (SELECT doc_id, page_number, max(text) AS t FROM page_results WHERE regexp_matches(text, '[^\\p{{Z}}\\t\\n\\x0b\\f\\r\\x{{85}}\\x1c-\\x1f]') GROUP BY ALL) GROUP BY doc_id)"""
ORACLES["page_text_agg"] = f"WITH {_FULL} SELECT doc_id, md5(t) AS text_md5 FROM ft"
ORACLES["drop_header_footer"] = f"""WITH {_EDGES}, {_FULL}, g AS (SELECT doc_id, list(line) AS gone FROM edges GROUP BY 1)
SELECT ft.doc_id, md5(CASE WHEN gone IS NULL THEN t ELSE array_to_string(list_filter(string_split(t, chr(10)), lambda x: NOT list_contains(gone, {_strip("x")})), chr(10)) END) AS content_md5 FROM ft LEFT JOIN g USING (doc_id)"""

_S = r"[\p{Z}\t\n\x0b\f\r\x{85}]"
_IN = r"A-Za-z0-9:–—\-\p{Z}\t\n\x0b\f\r\x{85}"
_CAPTION = rf"(?i)^(?:Figure|Fig\.?|Table|Exhibit){_S}+[0-9]+.*"
ORACLES["parse_sections"] = rf"""WITH d AS (SELECT id AS doc_id, max(content) AS t FROM pdf_documents WHERE id IS NOT NULL GROUP BY 1),
raw AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS raw, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d WHERE t IS NOT NULL),
ln AS (SELECT doc_id, pos, {_strip("raw")} AS line FROM raw),
ty AS (SELECT *, CASE WHEN regexp_matches(line, '^(?:[IVX]+|[0-9]+)\.{_S}+[A-Z][{_IN}]{{3,100}}$') THEN 'h1' WHEN regexp_matches(line, '^[0-9]+\.[0-9]+{_S}+[A-Z][{_IN}]{{3,100}}$') THEN 'h2'
  WHEN regexp_matches(line, '^[0-9]+\.[0-9]+\.[0-9]+{_S}+[A-Z][{_IN}]{{3,100}}$') THEN 'h3' WHEN regexp_matches(line, '^[A-Z0-9:–—\-\p{{Z}}\t]{{5,80}}$') AND NOT regexp_matches(line, '{_CAPTION}') THEN 'h1'
  WHEN regexp_matches(line, '^(?:[-•●▪◦▸►]|[0-9]+[.)]{_S}|[a-z][.)]{_S})') THEN 'list_item' WHEN regexp_matches(line, '{_CAPTION}') THEN 'caption' ELSE 'paragraph' END AS t FROM ln WHERE line <> ''),
sg AS (SELECT *, t IN ('h1', 'h2', 'h3') AS head, sum(CASE WHEN t IN ('h1', 'h2', 'h3') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS seg FROM ty),
nt AS (SELECT *, sum(CASE WHEN head THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, seg ORDER BY pos) AS nth FROM sg),
ct AS (SELECT *, CASE WHEN head THEN NULL WHEN nth = 1 THEN 'paragraph' ELSE t END AS ct FROM nt),
br AS (SELECT *, CASE WHEN nth > 1 AND t <> lag(ct) OVER (PARTITION BY doc_id, seg ORDER BY pos) THEN 1 ELSE 0 END AS brk FROM ct),
bl AS (SELECT *, CASE WHEN head THEN -1 ELSE sum(brk) OVER (PARTITION BY doc_id, seg ORDER BY pos) END AS block FROM br),
g AS (SELECT doc_id, seg, block, min(pos) AS pos, arg_min(t, pos) AS t0, arg_min(ct, pos) AS ct, string_agg(line, chr(10) ORDER BY pos) AS content FROM bl GROUP BY doc_id, seg, block),
h AS (SELECT doc_id, seg, substr(content, 1, 255) AS title, CAST(substr(t0, 2, 1) AS INTEGER) AS level FROM g WHERE block = -1),
u AS (SELECT doc_id, pos, CASE WHEN block = -1 THEN 'heading' ELSE ct END AS section_type, coalesce(title, 'Document Root') AS title, content, CASE WHEN block = -1 THEN level ELSE coalesce(level, 0) + 1 END AS level FROM g LEFT JOIN h USING (doc_id, seg)
  UNION ALL SELECT doc_id, -1, 'paragraph', 'Document Root', '', 0 FROM d)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS order_index, section_type, title, level, md5(content) AS content_md5 FROM u"""

ORACLES["unified_tree"] = """WITH s AS (SELECT DISTINCT * FROM sections)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_sections, md5(array_to_string(list_sort(list(concat_ws(':', order_index, title))), '|')) AS titles_md5 FROM s GROUP BY doc_id"""

_WIN = "reverse(substr(t, s + 1025, 1024))"
_END = f"CASE WHEN n <= 2304 OR s + 2048 >= n THEN n WHEN strpos({_WIN}, chr(10)) > 0 THEN s + 2049 - strpos({_WIN}, chr(10)) WHEN strpos({_WIN}, ' .') > 0 THEN s + 2049 - strpos({_WIN}, ' .') ELSE s + 2048 END"
ORACLES["chunk_docs"] = f"""WITH RECURSIVE d AS (SELECT id, max(content) AS t FROM pdf_documents WHERE id IS NOT NULL GROUP BY id),
r AS (
  SELECT id, t, length(t) AS n, 0 AS k, CAST(0 AS BIGINT) AS s, {_END.replace("s + ", "0 + ").replace("n <=", "length(t) <=").replace(">= n", ">= length(t)").replace("THEN n ", "THEN length(t) ")} AS e FROM d WHERE {_strip("t")} <> ''
  UNION ALL
  SELECT id, t, n, k, s, {_END} FROM (SELECT id, t, n, k + 1 AS k, CASE WHEN e - 256 > 0 THEN e - 256 ELSE e END AS s FROM r WHERE e < n)
), x AS (SELECT id, k, s, {_strip("substr(t, s + 1, e - s)")} AS c FROM r)
SELECT id AS doc_id, k AS chunk_index, sha256(c) AS content_hash, CAST(s AS INTEGER) AS start_char, CAST(s + length(c) AS INTEGER) AS end_char, CAST(length(c) // 4 AS INTEGER) AS token_count FROM x"""

_TYPES = {
    "report": ["report", "annual", "summary", "fiscal", "quarterly", "esg"], "paper": ["abstract", "methodology", "conclusion", "references", "arxiv"],
    "manual": ["manual", "guide", "instructions", "troubleshooting", "setup"], "financial": ["10-k", "10-q", "earnings", "balance sheet", "revenue"], "legal": ["agreement", "contract", "liability", "terms", "party"],
}
_HITS = ", ".join("(" + " + ".join(f"(length(t) - length(replace(t, '{w}', ''))) // {len(w)}" for w in ws) + f") AS {k}" for k, ws in _TYPES.items())
ORACLES["doc_type"] = f"""WITH h AS (SELECT doc_id, {_HITS} FROM (SELECT doc_id, lower(text) AS t FROM documents WHERE text IS NOT NULL)), b AS (SELECT *, greatest({", ".join(_TYPES)}) AS best FROM h)
SELECT doc_id, CASE WHEN best <= 2 THEN 'general' {" ".join(f"WHEN {k} = best THEN '{k}'" for k in _TYPES)} END AS found_type FROM b"""

_STOP = "the and to of a in is that for it as was with be by on not he i this are or his from at which but have an had they you were their one all we can her has there been if more when will would who so no"
_TOK = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}_]+'), lambda w: regexp_full_match(w, '[a-z]{4,20}'))"
ORACLES["word_count"] = f"SELECT doc_id, CAST(len({_TOK}) AS INTEGER) AS word_count FROM documents WHERE text IS NOT NULL"
ORACLES["keywords_top10"] = f"""WITH w AS (SELECT doc_id, {_TOK} AS ws FROM documents), x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
c AS (SELECT doc_id, word, count(*) AS count, min(pos) AS at0 FROM x WHERE word NOT IN ({", ".join(f"'{x}'" for x in _STOP.split())}) GROUP BY doc_id, word)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, word, count FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY count DESC, at0) AS rank FROM c) WHERE rank <= 10"""

_BRANDS = "b AS (SELECT l_orderkey AS sentence, l_linenumber AS pos, p_brand AS name, l_suppkey AS doc_id FROM lineitem JOIN part ON l_partkey = p_partkey)"
ORACLES["entity_upsert_counts"] = f"WITH {_BRANDS} SELECT doc_id, name, 'BRAND' AS entity_type, count(*) AS count FROM b GROUP BY ALL"
_PAIRS = "e AS (SELECT x.sentence, x.name AS source_entity, y.name AS target_entity FROM b x JOIN b y ON x.sentence = y.sentence AND x.pos < y.pos AND x.name <> y.name)"
ORACLES["cooccurrence_edges"] = f"WITH {_BRANDS}, {_PAIRS} SELECT source_entity, target_entity, 'co_occurs' AS relation_type, count(*) AS weight FROM e GROUP BY ALL"
ORACLES["edge_neighbours"] = f"WITH {_BRANDS}, {_PAIRS} SELECT sentence, source_entity, target_entity, 0.5::DOUBLE AS confidence FROM e WHERE source_entity = 'Brand#1' OR target_entity = 'Brand#1'"
ORACLES["entity_name_search"] = f"WITH {_BRANDS} SELECT name, count(*) AS count FROM b WHERE name ILIKE '%bRAND#1%' GROUP BY name ORDER BY count DESC, name LIMIT 50"
ORACLES["entity_types"] = "SELECT DISTINCT section_type AS entity_type FROM sections"
ORACLES["dedup_sha256"] = """WITH d AS (SELECT DISTINCT id, filename, content FROM pdf_documents WHERE content IS NOT NULL)
SELECT id, filename, row_number() OVER (PARTITION BY sha256(content) ORDER BY filename, id) = 1 AS is_first FROM d"""
ORACLES["validation_report"] = """WITH f AS (SELECT DISTINCT filename, file_size_bytes, content FROM pdf_documents),
c AS (SELECT filename AS path, length(filename) % 7 <> 0 AS mime, lower(regexp_extract(filename, '(\\.[^./]+)$', 1)) = '.pdf' AS ext, file_size_bytes BETWEEN 100 AND 250000 AS size,
  (CASE WHEN length(filename) % 7 = 0 THEN 'PK' ELSE '%PDF-' END) || coalesce(content, '') AS body FROM f),
o AS (SELECT *, mime AND ext AND size AS ok FROM c),
m AS (SELECT *, CASE WHEN ok THEN row_number() OVER (PARTITION BY ok, sha256(body) ORDER BY string_split(path, '/')) END AS copy FROM o)
SELECT path, ok AND copy = 1 IS TRUE AS passed, CASE WHEN ok AND copy = 1 THEN 'Passed' WHEN ok THEN 'Failed: Duplicate (SHA-256)'
  ELSE 'Failed: ' || concat_ws(', ', CASE WHEN NOT mime THEN 'MIME Type' END, CASE WHEN NOT ext THEN 'Extension' END, CASE WHEN NOT size THEN 'File Size' END) END AS summary FROM m"""
ORACLES["document_upsert"] = """WITH o AS (SELECT filename, max(struct_pack(id := id, title := title, status := status)) AS v FROM pdf_documents WHERE filename IS NOT NULL GROUP BY 1),
n AS (SELECT CASE WHEN id % 20 = 0 THEN filename ELSE 'new-' || filename END AS filename, max(id) + 1000000 AS id FROM pdf_documents WHERE id % 10 = 0 GROUP BY 1)
SELECT coalesce(o.v.id, n.id) AS id, coalesce(o.filename, n.filename) AS filename, CASE WHEN n.id IS NULL THEN o.v.title ELSE 'revised' END AS title, CASE WHEN n.id IS NULL THEN o.v.status ELSE 'extracted' END AS status FROM o FULL JOIN n ON o.filename = n.filename"""
ORACLES["delete_reprocessed"] = "SELECT id, doc_id FROM chunks WHERE NOT EXISTS (SELECT 1 FROM pdf_documents p WHERE p.status <> 'indexed' AND p.id = chunks.doc_id)"
ORACLES["composed_text"] = """SELECT id, sha256(CASE WHEN coalesce(title, '') <> '' OR coalesce(author, '') <> '' THEN concat_ws(chr(10), '--- Document Metadata ---', CASE WHEN title <> '' THEN 'Title: ' || title END,
  CASE WHEN author <> '' THEN 'Author: ' || author END, 'Pages: ' || page_count, '--- End Metadata ---') || chr(10) || chr(10) || content ELSE content END) AS text_sha256 FROM (SELECT DISTINCT * FROM pdf_documents WHERE content IS NOT NULL)"""
ORACLES["missing_hashes"] = "WITH c AS (SELECT DISTINCT id, doc_id, content_hash FROM chunks) SELECT id, doc_id, content_hash FROM c WHERE NOT EXISTS (SELECT 1 FROM c x WHERE x.id % 3 = 0 AND x.doc_id = c.doc_id AND x.content_hash = c.content_hash)"
ORACLES["table_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ("pdf_documents", "sections", "chunks", "chunk_embeddings", "search_logs", "documents", "page_results"))
ORACLES["recent_logs"] = "SELECT id, query, intent FROM (SELECT DISTINCT * FROM search_logs) ORDER BY id DESC LIMIT 50"
ORACLES["log_stats"] = "SELECT strategy, intent, count(*) AS n, CAST(sum(results_count) AS BIGINT) AS results, CAST(sum(CAST(latency_ms AS DECIMAL(18,3))) AS DOUBLE) AS total_latency FROM (SELECT DISTINCT * FROM search_logs) GROUP BY strategy, intent"
ORACLES["page_method_counts"] = "SELECT doc_id, count(*) AS pages, count(*) FILTER (method = 'pdfplumber') AS pdfplumber, count(*) FILTER (method = 'ocr') AS ocr, count(*) FILTER (method = 'empty') AS empty FROM (SELECT DISTINCT doc_id, page_number, method FROM page_results) GROUP BY doc_id"

_PN = rf"(?i)^(?:{_S}*[-–—]?{_S}*[0-9]{{1,4}}{_S}*[-–—]?{_S}*|Page{_S}+[0-9]+.*)$"
_LAYOUT = rf"""p AS (SELECT doc_id, page_number, max(text) AS t FROM page_results WHERE text IS NOT NULL GROUP BY ALL),
raw AS (SELECT doc_id, page_number, unnest(string_split(t, chr(10))) AS raw, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS line_no FROM p),
ln AS (SELECT *, {_strip("raw")} AS line FROM raw),
one AS (SELECT doc_id, page_number, line_no, line, CASE WHEN regexp_matches(line, '^(?:[0-9]+\.?{_S}+)?[A-Z][A-Za-z:–—\-\p{{Z}}\t\n\x0b\f\r\x{{85}}]{{3,80}}$') THEN 'heading' WHEN regexp_matches(line, '^{_S}*(?:[-•●▪◦▸►]|[0-9]+[.)]{_S}|[a-z][.)]{_S})') THEN 'list_item' WHEN regexp_matches(line, '{_PN}') THEN 'page_number' ELSE 'paragraph' END AS element_type FROM ln WHERE line <> ''),
el AS (SELECT * FROM one UNION ALL SELECT doc_id, page_number, line_no, line, 'figure_reference' FROM one WHERE regexp_matches(line, '(?i)(?:Figure|Fig\.?|Exhibit|Chart|Graph|Diagram){_S}+[0-9]+'))"""
ORACLES["layout_elements"] = f"WITH {_LAYOUT} SELECT doc_id, page_number, CAST(line_no AS INTEGER) AS line_no, element_type, CASE element_type WHEN 'heading' THEN 0.7 WHEN 'paragraph' THEN 0.6 WHEN 'figure_reference' THEN 0.8 ELSE 1.0 END::DOUBLE AS confidence, substr(line, 1, 80) AS preview FROM el"
ORACLES["layout_summary"] = f"WITH {_LAYOUT} SELECT doc_id, 'Detected elements: ' || string_agg(DISTINCT element_type, ', ' ORDER BY element_type) AS summary FROM el GROUP BY doc_id"
ORACLES["page_flags"] = f"""WITH p AS (SELECT doc_id, page_number, coalesce(max(text), '') AS t FROM page_results GROUP BY ALL),
l AS (SELECT doc_id, page_number, list_filter(list_transform(string_split(t, chr(10)), lambda x: {_strip("x")}), lambda x: x <> '') AS ls FROM p)
SELECT doc_id, page_number, length(coalesce(ls[1], '')) < 80 AS has_header, regexp_matches(coalesce(ls[-1], ''), '{_PN}') OR length(coalesce(ls[-1], '')) < 30 AS has_footer FROM l"""
ORACLES["gutter_detect"] = """WITH b AS (SELECT user_id AS page, CAST(least(floor(abs(value) / 2.0), 99) AS INTEGER) AS b FROM events WHERE value IS NOT NULL),
c AS (SELECT page, b, count(*) AS n FROM b GROUP BY ALL), t AS (SELECT page, count(*) / 100.0 AS mean FROM b GROUP BY ALL),
low AS (SELECT t.page, g.b FROM t CROSS JOIN (SELECT unnest(range(25, 75)) AS b) g LEFT JOIN c ON c.page = t.page AND c.b = g.b WHERE coalesce(c.n, 0) <= t.mean * 0.1),
r AS (SELECT page, min(b) AS s, max(b) AS e FROM (SELECT page, b, b - row_number() OVER (PARTITION BY page ORDER BY b) AS g FROM low) GROUP BY page, g HAVING max(b) - min(b) >= 2)
SELECT page, CAST(s AS INTEGER) AS start_bin, CAST(e AS INTEGER) AS end_bin, CAST((s + e + 1) / 2.0 * 2.0 AS DOUBLE) AS split FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY e - s DESC, s) AS k FROM r) WHERE k = 1"""
ORACLES["status_pending"] = "SELECT DISTINCT id, filename FROM pdf_documents WHERE status <> 'indexed' AND id NOT IN (SELECT doc_id FROM chunks WHERE doc_id IS NOT NULL AND token_count > 0 AND page_number > 2)"
ORACLES["documents_by_status"] = "SELECT id, filename, doc_type, language FROM (SELECT DISTINCT * FROM pdf_documents) WHERE status = 'indexed'"
ORACLES["representation_lookup"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
ORACLES["events_tumbling"] = "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL"
ORACLES["cube_lineitem"] = "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)"
ORACLES["setops_docs"] = "SELECT id FROM pdf_documents INTERSECT SELECT doc_id FROM sections UNION (SELECT doc_id FROM chunks EXCEPT SELECT id FROM pdf_documents)"

# Sections whose parent is one of the same document; those whose chain of parents ends in a circle hang at the top.
_NESTED = """WITH RECURSIVE rows_ AS (SELECT DISTINCT id, doc_id, parent_section_id, order_index, section_type, title, level, content FROM sections WHERE doc_id IS NOT NULL),
flat AS (SELECT DISTINCT doc_id FROM rows_ WHERE id IS NULL),
one AS (SELECT id, max(struct_pack(doc_id := doc_id, up := parent_section_id)) AS s FROM rows_ WHERE doc_id NOT IN (SELECT doc_id FROM flat) GROUP BY id),
n AS (SELECT a.id, a.s.doc_id AS doc_id, b.id AS up FROM one a LEFT JOIN one b ON a.s.up = b.id AND a.s.doc_id = b.s.doc_id),
t AS (SELECT id FROM n WHERE up IS NULL UNION ALL SELECT n.id FROM t JOIN n ON n.up = t.id),
tops AS (SELECT doc_id, count(*) FILTER (WHERE up IS NULL OR id NOT IN (SELECT id FROM t)) AS n_top, count(*) AS n_sections FROM n GROUP BY doc_id
  UNION ALL SELECT doc_id, count(*), 0 FROM rows_ WHERE doc_id IN (SELECT doc_id FROM flat) GROUP BY doc_id)"""
ORACLES["section_tree"] = f"{_NESTED} SELECT doc_id, CAST(n_top AS INTEGER) AS n_top, CAST(n_sections AS INTEGER) AS n_sections FROM tops"
ORACLES["representation_built"] = f"{_NESTED} SELECT p.id, p.filename, CAST(coalesce(n_top, 0) AS INTEGER) AS n_top FROM (SELECT id, max(filename) AS filename FROM pdf_documents GROUP BY id) p LEFT JOIN tops ON tops.doc_id = p.id"
ORACLES["context_parent"] = """SELECT c.id AS chunk_id, md5(coalesce(s.content, '')) AS parent_md5 FROM (SELECT id, max(section_id) AS section_id FROM chunks WHERE id IS NOT NULL GROUP BY id) c
LEFT JOIN (SELECT id, max(content) AS content FROM sections WHERE id IS NOT NULL GROUP BY id) s ON s.id = c.section_id"""
_TOP10 = _TOP.format("(SELECT * FROM scored WHERE score > 0)", 10)
ORACLES["rerank_hits"] = f"""WITH {_Q}, {_BM25}, hits AS ({_TOP10}),
x AS (SELECT query_id, hits.chunk_id, hits.rank AS r0, list_distinct({_words("lower(query)")}) AS qw, ws FROM hits JOIN q USING (query_id) JOIN w ON w.chunk_id = hits.chunk_id),
y AS (SELECT query_id, chunk_id, r0, CASE WHEN len(qw) = 0 THEN 0.0 ELSE round(len(list_filter(qw, lambda v: list_contains(ws, v)))::DOUBLE / len(qw), 6) END AS score FROM x)
SELECT query_id, chunk_id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, r0) AS rank FROM y) WHERE rank <= 5"""
_ANSWERED = f"""hits AS ({_TOP10}), f AS (SELECT query_id, count(*) AS n FROM documents, q WHERE contains(lower(text), query) AND query_id NOT IN (SELECT query_id FROM hits) GROUP BY query_id),
a AS (SELECT query_id, 'bm25' AS source, count(*) AS n FROM hits GROUP BY query_id UNION ALL SELECT query_id, 'fallback_txt', n FROM f)"""
ORACLES["fallback_for_empty"] = f"WITH {_Q}, {_BM25}, {_ANSWERED} SELECT * FROM a"
ORACLES["search_log_rows"] = f"""WITH {_ROUTE}, {_BM25}, {_ANSWERED}
SELECT query_id, query, intent, CAST(coalesce(n, 0) AS INTEGER) AS results_count, strategy || ' (alpha=' || printf('%.2f', alpha) || ')' || CASE WHEN source = 'fallback_txt' THEN ' + fallback_txt_search' ELSE '' END AS strategy FROM r LEFT JOIN a USING (query_id)"""


def _rule_mentions() -> str:
    from leafmill.operators.graph import DROPPED_LABELS, RULES

    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    label = "CASE " + " ".join(f"WHEN regexp_full_match(name, {quoted(rule)}) THEN '{k}'" for k, rule in RULES.items()) + " END"
    each = quoted("(" + "|".join(RULES.values()) + ")")
    return f"""s0 AS (SELECT doc_id, chunk_id, row_number() OVER () AS r, ss FROM (SELECT doc_id, id AS chunk_id, string_split(regexp_replace(content, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS ss FROM src WHERE content IS NOT NULL)),
s1 AS (SELECT doc_id, chunk_id, r, generate_subscripts(ss, 1) AS sentence_no, unnest(ss) AS sentence FROM s0),
s2 AS (SELECT doc_id, chunk_id, sentence_no, regexp_extract_all(sentence, {each}, 1) AS ns FROM s1),
s3 AS (SELECT doc_id, chunk_id, sentence_no, unnest(ns) AS name, generate_subscripts(ns, 1) AS pos FROM s2),
s4 AS (SELECT *, {label} AS label FROM s3),
m AS (SELECT doc_id, chunk_id, sentence_no, pos, label, array_to_string(list_transform(regexp_extract_all({_strip("name")}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), lambda x: upper(x[1]) || lower(x[2:])), '') AS name FROM s4
  WHERE label NOT IN ({", ".join(f"'{x}'" for x in DROPPED_LABELS)}) AND length(trim(name)) >= 2)"""


ORACLES["rule_entities"] = f"WITH src AS (SELECT id, doc_id, content FROM chunks), {_rule_mentions()} SELECT doc_id, name, label AS entity_type, count(*) AS count FROM m GROUP BY ALL"
ORACLES["rule_relationships"] = f"""WITH src AS (SELECT DISTINCT id, doc_id, content FROM chunks), {_rule_mentions()},
ids AS (SELECT doc_id, name, max(length(name) * 1000 + length(label)) AS id FROM m GROUP BY ALL),
e AS (SELECT a.doc_id, a.name AS source_entity, b.name AS target_entity FROM m a JOIN m b ON a.doc_id = b.doc_id AND a.chunk_id = b.chunk_id AND a.sentence_no = b.sentence_no AND a.pos < b.pos AND a.name <> b.name)
SELECT e.doc_id, source_entity, target_entity, CAST(x.id AS INTEGER) AS source_id, CAST(y.id AS INTEGER) AS target_id, count(*) AS n FROM e
JOIN ids x ON x.doc_id = e.doc_id AND x.name = source_entity JOIN ids y ON y.doc_id = e.doc_id AND y.name = target_entity GROUP BY ALL"""
ORACLES["chunk_sections"] = f"""WITH RECURSIVE d AS (SELECT doc_id, order_index, sha256(content) AS h, any_value(content) AS t, min(coalesce(page_start, 0)) AS page_number FROM sections WHERE doc_id IS NOT NULL AND {_strip("content")} <> '' GROUP BY ALL),
r AS (
  SELECT doc_id, order_index, h, page_number, t, length(t) AS n, 0 AS k, CAST(0 AS BIGINT) AS s, {_END.replace("s + ", "0 + ").replace("n <=", "length(t) <=").replace(">= n", ">= length(t)").replace("THEN n ", "THEN length(t) ")} AS e FROM d
  UNION ALL
  SELECT doc_id, order_index, h, page_number, t, n, k, s, {_END} FROM (SELECT doc_id, order_index, h, page_number, t, n, k + 1 AS k, CASE WHEN e - 256 > 0 THEN e - 256 ELSE e END AS s FROM r WHERE e < n)
), x AS (SELECT *, {_strip("substr(t, s + 1, e - s)")} AS c FROM r)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY order_index NULLS FIRST, h, k) - 1 AS INTEGER) AS chunk_index, sha256(c) AS content_hash, CAST(s AS INTEGER) AS start_char, CAST(s + length(c) AS INTEGER) AS end_char, CAST(length(c) // 4 AS INTEGER) AS token_count, page_number FROM x"""
ORACLES["enriched_documents"] = f"""WITH s AS (SELECT DISTINCT doc_id, order_index, id, content FROM sections WHERE doc_id IS NOT NULL AND content <> ''),
ft AS (SELECT doc_id AS id, string_agg(content, ' ' ORDER BY order_index NULLS FIRST, id NULLS FIRST, content) AS text FROM s GROUP BY doc_id),
tk AS (SELECT id, {_TOK} AS ws FROM ft), x AS (SELECT id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM tk),
c AS (SELECT id, word, count(*) AS n, min(pos) AS at0 FROM x WHERE word NOT IN ({", ".join(f"'{v}'" for v in _STOP.split())}) GROUP BY id, word),
kw AS (SELECT id, string_agg(word, ' ' ORDER BY rank) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, at0) AS rank FROM c) WHERE rank <= 10 GROUP BY id),
h AS (SELECT id, {_HITS} FROM (SELECT id, lower(text) AS t FROM ft)), b AS (SELECT *, greatest({", ".join(_TYPES)}) AS best FROM h),
ty AS (SELECT id, CASE WHEN best <= 2 THEN 'general' {" ".join(f"WHEN {k} = best THEN '{k}'" for k in _TYPES)} END AS found FROM b)
SELECT p.id, coalesce(found, doc_type) AS doc_type, CAST(len(ws) AS INTEGER) AS word_count, keywords FROM (SELECT id, max(doc_type) AS doc_type FROM pdf_documents GROUP BY id) p LEFT JOIN tk ON tk.id = p.id LEFT JOIN kw ON kw.id = p.id LEFT JOIN ty ON ty.id = p.id"""
ORACLES["chunk_counts"] = "SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id"
_PAGES = "p AS (SELECT CAST(doc_id AS VARCHAR) AS doc_path, page_number, max(method) AS method, max(text) AS text FROM page_results GROUP BY ALL)"
_TABLE = "'[Table 1 — Page ' || page_number || ']' || chr(10) || coalesce(method, '') || ' | ' || chr(10) || repeat('-', 40) || chr(10) || 'a b | ' || page_number"
_SEEN = _words("text")
ORACLES["page_extraction"] = f"""WITH {_PAGES}, m AS (SELECT *, CASE WHEN method IN ('pdfplumber', 'ocr') AND len({_SEEN}) > 0 THEN method ELSE 'empty' END AS found FROM p)
SELECT doc_path, page_number, found AS method, found <> 'empty' AS has_text, md5(CASE WHEN found = 'empty' THEN '' ELSE text END || CASE WHEN found = 'pdfplumber' AND page_number % 2 = 0 THEN chr(10) || chr(10) || {_TABLE} ELSE '' END) AS text_md5 FROM m"""
ORACLES["page_tables"] = f"WITH {_PAGES} SELECT doc_path, page_number, 1 AS table_no, 2 AS n_rows, {_TABLE} AS text FROM p WHERE page_number % 2 = 0"
ORACLES["drawn_elements"] = f"""WITH {_PAGES} SELECT doc_path, page_number, 'table' AS element_type, 0.9::DOUBLE AS confidence, 'Table with 2 rows' AS preview FROM p WHERE page_number % 2 = 0
UNION ALL SELECT doc_path, page_number, 'figure', 0.9, (page_number % 3) || ' images' FROM p WHERE page_number % 3 > 0"""
ORACLES["order_tables"] = """WITH r AS (SELECT l_orderkey, concat_ws(' | ', l_linenumber, trim(l_returnflag), trim(l_linestatus)) AS line, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_linestatus) AS k FROM lineitem)
SELECT l_orderkey, md5(string_agg(CASE WHEN k = 1 THEN line || chr(10) || repeat('-', greatest(40, length(line))::INTEGER) ELSE line END, chr(10) ORDER BY k)) AS table_md5 FROM r GROUP BY l_orderkey"""
ORACLES["median_size"] = "SELECT user_id AS page, list_sort(list(value))[count(*) // 2 + 1] AS median_size FROM events WHERE value IS NOT NULL GROUP BY user_id"
ORACLES["multi_column"] = """WITH x AS (SELECT DISTINCT user_id AS page, CAST(trunc(abs(value)) AS INTEGER) AS x FROM events WHERE value IS NOT NULL), g AS (SELECT page, x - lag(x) OVER (PARTITION BY page ORDER BY x) AS gap FROM x)
SELECT page, count(*) > 20 AND coalesce(max(gap), 0) > 50 AS multi_column FROM g GROUP BY page"""
ORACLES["delete_cascade"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t} WHERE NOT EXISTS (SELECT 1 FROM pdf_documents p WHERE p.status <> 'indexed' AND p.id = {t}.doc_id)" for t in ("sections", "chunks", "chunk_embeddings", "page_results")) + " UNION ALL SELECT 'search_logs', count(*) FROM search_logs"
ORACLES["live_vectors"] = "SELECT model_name, level, count(*) AS n FROM chunk_embeddings WHERE chunk_id IS NULL OR chunk_id IN (SELECT id FROM chunks WHERE token_count > 0) GROUP BY ALL"
ORACLES["text_paths"] = "SELECT DISTINCT id, CASE WHEN strpos(substr(filename, 2), '.') > 0 THEN regexp_replace(filename, '\\.[^.]*$', '') ELSE filename END || '.txt' AS text_path FROM pdf_documents"
ORACLES["events_sessions"] = """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k"""
ORACLES["approx_distinct_users"] = "SELECT event_type, count(DISTINCT user_id) AS n, true AS near FROM events GROUP BY event_type"
