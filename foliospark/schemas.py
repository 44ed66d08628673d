"""Declared schemas: nothing is inferred."""

from __future__ import annotations

#: A file as it is scanned, before and after classification.
FILE = "path string, name string, ext string, length long, content binary"
PDF_INFO = "page_count int, chars array<int>"
#: A line that a parser prints.
PARSER_LINE = "ok boolean, parser string, pages int, error string, table_count int, cpu_fallback boolean"
#: What parsing a file gives.
RESULT = "doc_id string, source string, doc_class string, parser string, content string, pages int, ok boolean, error string, elapsed_s double, table_count int, cpu_fallback boolean"
#: A table's grid and a document tree.
GRID = "struct<rows:int,cols:int,cells:array<struct<row:int,col:int,content:string>>>"
NODE = f"struct<node_type:string,text:string,heading_text:string,heading_level:int,description:string,grid:{GRID},children:array<int>>"
TREE = f"array<{NODE}>"
#: What a page extraction gives.
PAGE = "doc_id string, page_no int, text string, cpu_fallback boolean"
#: Job events and job states.
JOB_EVENT = "job_id string, ts timestamp, status string, filename string, error string"
JOB_STATE = "job_id string, status string, filename string, created_at timestamp, updated_at timestamp, error string"
