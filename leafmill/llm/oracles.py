"""For each of these queries that SQL can express, the same in DuckDB's SQL."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "p5_found": """
SELECT DISTINCT source_table, id, CASE WHEN regexp_matches(content, '[^\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]{769}[^\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]{768}[^\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]{768}') THEN 'forced' ELSE 'natural' END AS kind
FROM (SELECT 'pdf_documents' AS source_table, id, content FROM pdf_documents UNION ALL SELECT 'chunks', id, content FROM chunks)
WHERE length(content) > 2304
""",
    "p5_rebuilt": """
SELECT DISTINCT source_table, id, md5(content) AS text_md5 FROM (SELECT 'pdf_documents' AS source_table, id, content FROM pdf_documents UNION ALL SELECT 'chunks', id, content FROM chunks)
WHERE length(content) > 2304
""",
    "p6_decoded": "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE text IS NOT NULL",
}
