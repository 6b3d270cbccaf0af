"""Composed jobs: ingest, master blocks, marts, reports, registered queries."""
