"""Star-schema maintenance: first-wins dedup, insert-or-ignore, get-or-create
dimensions, constraint checks and orphan reports.

All of it is joins and aggregates on keys:

* ``first_wins`` is a ``groupBy(keys)`` with ``min_by`` (partial aggregation on
  the map side, so a hot key does not pile up in one task);
* ``insert_or_ignore`` is a ``left_anti`` join against the stored facts on the
  keys (``=`` where a key part can't be NULL, ``<=>`` where it can);
* ``insert_or_update`` replaces the stored rows of keys that come again, by
  rewriting only the partitions where a value changes;
* ``extend_dimension`` anti-joins the batch's distinct members against the
  dimension and numbers the new ones after the current maximum id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.operators.joins import key_condition
from statloom.operators.ranking import global_rank
from statloom.session import ensure_checkpoint_dir


def first_wins(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key (NULL key parts form their own group): the row that
    comes first in ``order_cols`` order."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = F.struct(*[F.col(c) for c in order_cols])
    picked = F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*").select(*df.columns)


def anti_join_null_safe(
    batch: DataFrame, existing: DataFrame, keys: Sequence[str], nullable: Sequence[str] | None = None
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing`` (NULL = NULL in the
    ``nullable`` key parts; all, if not given)."""
    ex = existing.select(*keys).alias("_ex")
    b = batch.alias("_b")
    return b.join(ex, key_condition(b, ex, keys, nullable), "left_anti").select(*[F.col(f"_b.`{c}`").alias(c) for c in batch.columns])


def insert_or_ignore(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] = (),
    nullable: Sequence[str] | None = None,
) -> DataFrame:
    """New rows to append: the batch deduplicated first-wins, minus keys that
    already exist. Existing rows are never replaced (first write wins)."""
    dedup = first_wins(batch, keys, order_cols) if order_cols else batch.dropDuplicates(list(keys))
    return anti_join_null_safe(dedup, existing, keys, nullable)


def last_wins(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key (NULL equals NULL): the row that comes last in ``order_cols`` order."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order_cols])).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*").select(*df.columns)


def insert_or_update(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    group: str,
    nullable: Sequence[str] | None = None,
) -> tuple[DataFrame, list]:
    """The batch's last row of each key replaces the stored one: (rows to write, groups to replace).

    ``group`` is the key column the stored table is partitioned by. Only groups
    in which a stored row changes its value are replaced, and for those the rows
    to write are the whole new content. Other groups get their new keys
    appended. The list has one value per changed partition.
    """
    ensure_checkpoint_dir(existing.sparkSession)
    cols = existing.columns
    values = [c for c in cols if c not in keys]
    new = last_wins(batch.select(*cols, *[c for c in order_cols if c not in cols]), keys, order_cols).select(*cols).checkpoint(eager=True)
    a, b = existing.alias("_a"), new.alias("_b")
    differs = F.lit(False)
    for c in values:
        differs = differs | ~F.col(f"_a.`{c}`").eqNullSafe(F.col(f"_b.`{c}`"))
    hit = a.join(b, key_condition(a, b, keys, nullable)).where(differs)
    changed = [r[0] for r in hit.select(F.col(f"_a.`{group}`")).distinct().collect()]  # one value per partition
    replaced = F.coalesce(F.col(group).isin([c for c in changed if c is not None]), F.lit(False))
    if None in changed:
        replaced = replaced | F.col(group).isNull()
    kept = anti_join_null_safe(existing.where(replaced), new.where(replaced), keys, nullable)
    added = anti_join_null_safe(new.where(~replaced), existing.where(~replaced), keys, nullable)
    return kept.unionByName(new.where(replaced)).unionByName(added), changed


def stored_or_twice(existing: DataFrame, batch: DataFrame, keys: Sequence[str], nullable: Sequence[str] | None = None) -> DataFrame:
    """Keys of the batch that are stored already, or that come more than once in it."""
    counted = batch.groupBy(*keys).agg(F.count("*").alias("_n")).alias("_c")
    ex = existing.select(*keys).alias("_e")
    stored = counted.join(ex, key_condition(counted, ex, keys, nullable), "left_semi")
    return stored.select(*keys).unionByName(counted.where("_n > 1").select(*keys)).distinct()


def extend_dimension(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    id_col: str,
    order_cols: Sequence[str],
    attrs: Sequence[str] = (),
) -> DataFrame:
    """Get-or-create: rows to add to a dimension, with fresh ids.

    ``batch`` holds candidate members (``keys``, ``attrs``, ``order_cols``).
    Attributes come from the first occurrence (first insert wins). New ids
    continue after the dimension's current maximum, in first-seen order.
    """
    keys, attrs, order_cols = list(keys), list(attrs), list(order_cols)
    ensure_checkpoint_dir(existing.sparkSession)
    members = first_wins(batch.select(*keys, *attrs, *order_cols), keys, order_cols)
    new = anti_join_null_safe(members, existing, keys).checkpoint(eager=True)
    if new.isEmpty():  # nothing to number
        return new.select(F.lit(0).cast("long").alias(id_col), *keys, *attrs)
    start = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
    ranked = global_rank(new, order_cols + keys, out="_pos")
    return ranked.select(
        (start + F.col("_pos") + F.lit(1)).cast("long").alias(id_col), *keys, *attrs
    )


def attach_ids(
    facts: DataFrame, dim: DataFrame, keys: Sequence[str], id_col: str, null_safe: bool = False
) -> DataFrame:
    """Replace dimension members by their ids (inner join on the members).

    Spark chooses the join from the dimension's measured size."""
    d = dim.select(id_col, *keys)
    if not null_safe:
        return facts.join(d, list(keys))
    f = facts.alias("_f")
    dd = d.alias("_d")
    out = f.join(dd, key_condition(f, dd, keys), "inner")
    return out.select(*[F.col(f"_f.`{c}`").alias(c) for c in facts.columns], F.col(f"_d.{id_col}"))


def split_rejects(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, rejects). ``checks`` are (reason, failing
    condition) pairs; a rejected row carries the first failing reason."""
    reason = F.lit(None).cast("string")
    for name, failing in reversed(list(checks)):
        reason = F.when(failing, F.lit(name)).otherwise(reason)
    tagged = df.withColumn("_reject", reason)
    good = tagged.filter(F.col("_reject").isNull()).drop("_reject")
    rejects = tagged.filter(F.col("_reject").isNotNull()).withColumnRenamed("_reject", "reject_reason")
    return good, rejects


def not_null_checks(columns: Sequence[str]) -> list[tuple[str, Column]]:
    """NOT NULL constraints as reject checks."""
    return [(f"null_{c}", F.col(c).isNull()) for c in columns]


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose foreign key has no dimension row."""
    dk = dim_key or fact_key
    d = dim.select(F.col(dk).alias("_dk"))
    return fact.join(d, fact[fact_key] == d["_dk"], "left_anti")


def constraint_counts(
    fact: DataFrame, required: Sequence[str], foreign: dict[str, tuple[DataFrame, str]], unique: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """Rows (check, n_rows): NOT NULL violations of ``required`` columns,
    orphans of ``foreign`` keys (column -> (dimension, its key)), and for each
    ``unique`` name -> key columns the rows besides one of each key (NULL key
    parts equal each other).

    One scan of the facts and one join: each row gives a (check, value) pair
    for every constraint, pairs are counted first (a partial aggregate, so a
    value that a third of all rows hold is one row per task), and the counted
    pairs are looked up among the allowed ones. A NULL foreign key has no
    dimension row, so it counts as an orphan.

    Unique keys take part in the same scan by a 64-bit hash. Only rows whose
    hash was met twice are then read again and grouped by the key itself, so a
    collision of hashes is not reported."""
    spark = fact.sparkSession
    unique = {f"unique_{name}": list(keys) for name, keys in (unique or {}).items()}
    present = F.lit("present")
    pairs = [(f"null_{c}", F.when(F.col(c).isNotNull(), present)) for c in required]
    pairs += [(f"orphan_{k}", F.col(k).cast("string")) for k in foreign]
    no_value, no_hash = F.lit(None).cast("string"), F.lit(None).cast("long")
    found = [F.struct(F.lit(n).alias("check"), v.alias("value"), no_hash.alias("hash")) for n, v in pairs]
    found += [F.struct(F.lit(n).alias("check"), no_value.alias("value"), F.xxhash64(*keys).alias("hash")) for n, keys in unique.items()]
    each = fact.select(F.explode(F.array(*found)).alias("p")).select("p.*")
    counted = each.groupBy("check", "value", "hash").agg(F.count(F.lit(1)).alias("n"))
    twice = counted.where(F.col("hash").isNotNull() & (F.col("n") > 1)).select("check", "hash")
    counted = counted.where("hash IS NULL")
    allowed = spark.createDataFrame([(f"null_{c}", "present") for c in required], "check string, value string")
    for k, (dim, dim_key) in foreign.items():
        allowed = allowed.unionByName(dim.select(F.lit(f"orphan_{k}").alias("check"), F.col(dim_key).cast("string").alias("value")).distinct())
    broken = counted.join(allowed, ["check", "value"], "left_anti").groupBy("check").agg(F.sum("n").alias("n"))
    for name, keys in unique.items():
        again = fact.select(*keys, F.xxhash64(*keys).alias("_hash")).join(
            twice.where(F.col("check") == name).select(F.col("hash").alias("_hash")), "_hash", "left_semi")
        surplus = again.groupBy(*keys).agg((F.count("*") - 1).alias("_more")).agg(F.sum("_more").alias("n"))
        broken = broken.unionByName(surplus.select(F.lit(name).alias("check"), "n"))
    checks = spark.createDataFrame([(n,) for n in [*dict(pairs), *unique]], "check string")
    return checks.join(broken, "check", "left").select("check", F.coalesce("n", F.lit(0)).alias("n_rows"))
