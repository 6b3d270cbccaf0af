"""Intermediate tables in the cluster's shared folder, and sizes that choose partition counts."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.session import shared_path

#: Bytes of text that one group of a grouped step should hold.
GROUP_BYTES = 16 << 20


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds for a while and is then put back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def tidy(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """While it holds, the shuffle files of a query go when the query has ended.

    For queries whose result is written or checkpointed (nothing reads their shuffles
    again): a loop of them would else leave files until the driver collects its garbage.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


class Tables:
    """Parquet tables under one folder of ``spark.checkpoint.dir``; ``drop`` removes them.

    Shuffle files of a write go when the table is there: nothing reads them again.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = shared_path(spark, f"{name}-{uuid.uuid4().hex}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with tidy(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str | None = None) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_groups(docs: DataFrame, column: str = "text", size: int = GROUP_BYTES) -> int:
    """How many groups of about ``size`` bytes the texts make (the shuffle partitions at least)."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(shuffle_partitions(docs.sparkSession), -(-total // size))


#: A side of at most so many rows may be broadcast by ``attach``.
BROADCAST_ROWS = 100_000
SALTS = 32


def attach(big: DataFrame, small: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """Left join of ``small`` (one row per key, NULL equals NULL) on ``keys``, safe where one key holds most of ``big``.

    ``small`` is counted first (pass a checkpointed table): up to
    ``BROADCAST_ROWS`` rows it is broadcast. Beyond that each row of it is
    repeated ``SALTS`` times and ``big`` is dealt by key and ``salt``, a
    column that differs between the rows of one key.
    """
    names = {k: f"{k} of small" for k in keys}
    right = small.select(*(F.col(k).alias(names.get(k, k)) for k in small.columns))
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        right = F.broadcast(right)
    else:
        big = big.withColumn("dealt salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int"))
        right = right.withColumn("own salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"`{names[k]}`"))
    if "dealt salt" in big.columns:
        on = on & (F.col("`dealt salt`") == F.col("`own salt`"))
    return big.join(right, on, "left").drop(*names.values(), "dealt salt", "own salt")
