"""Training-data operators: thirteen corpus operators on Spark (see README, "Training data").

Nothing outside this subpackage imports it, apart from the guarded entry in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
