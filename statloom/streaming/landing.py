"""Incremental ingest with Structured Streaming.

New JSON Lines files in a landing folder are picked up as micro-batches; each
batch runs the same load as the batch path (get-or-create dimensions,
insert-or-ignore facts, one new version of the star) through ``foreachBatch``. Because the load ignores
keys that are already stored (with ``update``, stored values that are the same), a micro-batch replayed after a failure (the
sink is at-least-once) leaves the tables unchanged: the result is
exactly-once. The stream's progress lives in the checkpoint location. It has
to be named, must be in a shared folder, and must be the same at each start,
or the stream would begin anew. Rejects are written per batch, so a replayed
batch overwrites its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statloom.plans import ingest
from statloom.schemas import BAD_RECORD, READ_SERIES, READ_SERIES_FILE
from statloom.sources.series_json import KEEP_BAD, files_to_series


def start_landing_stream(
    spark: SparkSession,
    landing_dir: str,
    star_root: str,
    checkpoint: str,
    rejects_dir: str | None = None,
    available_now: bool = False,
    max_files_per_trigger: int | None = None,
    files: bool = False,
    conflict: str = "ignore",
) -> StreamingQuery:
    """Start loading ``landing_dir`` into the star at ``star_root``; ``conflict`` as in ``ingest.load``.

    ``files=True`` reads downloaded ``<code>.json`` table files (one JSON
    document each) instead of JSON Lines.
    """
    reader = spark.readStream.schema(READ_SERIES_FILE if files else READ_SERIES).options(**KEEP_BAD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if files:
        raw = reader.option("multiLine", True).json(landing_dir).select(
            "Nombre", "Data", BAD_RECORD, F.col("_metadata.file_name").alias("file_name")
        )
    else:
        raw = reader.json(landing_dir)
    store = ingest.StarStore(spark, star_root)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        if files:
            batch = files_to_series(batch)
        rejects = ingest.load(batch, store, conflict)
        if rejects_dir:
            # one folder per batch, overwritten: a replayed batch writes its rejects once
            for name, df in rejects.items():
                df.write.mode("overwrite").parquet(f"{rejects_dir.rstrip('/')}/{name}/batch_id={batch_id}")

    writer = raw.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
