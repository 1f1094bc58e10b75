from feedloom.sources.archives import first_member_lines, list_archives, read_archives, shared_header, stage_lines
from feedloom.sources.delimited import csv_audit, infer_csv, infer_lines, judge_lines, parse_lines, read_csv
from feedloom.sources.landed import LANDED, RUNS, first_link, missing_pages, page_requests, read_documents, read_landed

__all__ = [
    "LANDED",
    "RUNS",
    "csv_audit",
    "first_link",
    "first_member_lines",
    "infer_csv",
    "infer_lines",
    "judge_lines",
    "list_archives",
    "missing_pages",
    "page_requests",
    "parse_lines",
    "read_archives",
    "read_csv",
    "read_documents",
    "read_landed",
    "shared_header",
    "stage_lines",
]
