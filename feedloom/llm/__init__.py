"""Operators for large training corpora: documents, pages and benchmarks at scale."""
