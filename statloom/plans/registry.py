"""All registered queries: name -> (spark_fn, oracle_sql or None)."""

from __future__ import annotations


def all_queries():
    from statloom.plans import ingest_queries, series_queries, testdata  # noqa: F401  (registration)

    return dict(testdata.REGISTRY)
