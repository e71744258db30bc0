"""Schemas of the tables that the operators exchange."""

from __future__ import annotations

SPAN = "struct<text:string,size:double,bold:boolean,bbox:array<double>>"
PAGE = f"struct<page_num:int,text:string,method:string,spans:array<{SPAN}>,tables:array<array<array<string>>>>"
EXTRACTION = f"path string, source_rel string, doc_type string, pages array<{PAGE}>, errors array<string>"
PAGES = f"source_rel string, doc_type string, page_num int, text string, method string, spans array<{SPAN}>, tables array<array<array<string>>>"
CHUNK = "chunk_id string, source_file string, doc_type string, chunk_type string, heading string, page_start int, page_end int, text string, char_count int, qa_role string, linked_source string"
LINK = "path string, role string, linked_to string, match_type string"
EVAL_ITEM = "id string, section string, topic string, question string, must_contain_any array<string>, expected_source_any array<string>"
