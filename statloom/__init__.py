"""statloom: a Spark-native engine for statistical indicator panels.

Subpackages:

* ``sources``   readers and writers (Parquet tables, JSON series documents, marts)
* ``functions`` column expressions (safe arithmetic, name parsing, periods, labels)
* ``operators`` DataFrame operators (measures, joins, star maintenance, ranks,
  reshaping, LOWESS)
* ``plans``     composed jobs (ingest, master blocks, the nine marts, reports,
  and the registered queries over the test tables)
* ``streaming`` the incremental landing-folder loader

Command line: ``python -m statloom {load,marts,reports}``.
"""

__version__ = "0.1.0"
