"""Readers: delimited text, workbooks, HTML tables, parquet, catalog tables."""
