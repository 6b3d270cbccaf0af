"""Exact global positions without a single-partition window.

``global_rank`` numbers rows 0..n-1 in a total order:

1. range-partition on the order columns and sort inside each partition;
2. tag rows with (partition id, position in partition) and checkpoint, so the
   numbering is frozen even if an executor is lost and tasks re-run;
3. count rows per partition; running offsets over those counts (one row per
   partition, so that window is tiny) are broadcast back.

Work and memory per task are those of one range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.session import ensure_checkpoint_dir

_ID_BITS = 33  # monotonically_increasing_id keeps the record number in the low 33 bits


def global_rank(
    df: DataFrame,
    order_cols: Sequence[str],
    out: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 0-based position in ``order_cols`` order.

    ``order_cols`` must form a total order (end with a unique column), so the
    numbering is deterministic. The tagged rows are checkpointed before the
    per-partition counts are taken, so counts and positions always come from
    the same partitioning (two separately planned shuffles could otherwise be
    coalesced differently by AQE).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = list(order_cols)
    # Without an explicit count AQE may merge small neighbouring ranges, which
    # keeps their order; a tiny input then does not fan out to many tasks.
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    tagged = (
        ranged
        .sortWithinPartitions(*cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off")
    )
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _ID_BITS)
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_off") + local)
        .drop("_pid", "_mid", "_off")
    )
