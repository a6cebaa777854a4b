"""Readers and writers: file listing, CSV/TSV, JSON shapes, TFRecord, Parquet."""
