"""Table schemas."""

from __future__ import annotations

DOCUMENTS = "id long, filename string, sha256 string, page_count int, file_size_bytes long, title string, author string, doc_type string, language string, metadata_json string, status string, content string, created_at timestamp, updated_at timestamp"
SECTIONS = "id long, doc_id long, parent_section_id long, section_type string, title string, content string, page_start int, page_end int, order_index int, level int, metadata_json string"
CHUNKS = "id long, doc_id long, section_id long, content string, content_hash string, chunk_index int, start_char int, end_char int, token_count int, page_number int, metadata_json string"
EMBEDDINGS = "id long, chunk_id long, doc_id long, level string, model_name string, dimensions int, vector_blob binary"
ENTITIES = "doc_id long, name string, entity_type string, count long, metadata_json string"
RELATIONSHIPS = "source_entity string, target_entity string, relation_type string, doc_id long, confidence double"
SEARCH_LOGS = "id long, query string, intent string, results_count int, latency_ms double, strategy string, logged_at timestamp"
PAGE_INPUT = "doc_path string, page_number int, text string, ocr_text string, page_width double, chars array<struct<x0:double,size:double>>, tables array<array<array<string>>>, n_images int"
TABLES = {"documents": DOCUMENTS, "sections": SECTIONS, "chunks": CHUNKS, "embeddings": EMBEDDINGS, "entities": ENTITIES, "relationships": RELATIONSHIPS, "search_logs": SEARCH_LOGS}
