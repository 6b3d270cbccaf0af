"""Readers and writers: Parquet tables, JSON series documents, marts."""
