"""Sharding by balanced label propagation, in DataFrame operations only.

Documents with one group key (here: equal texts) are linked. Labels are
shards. Linked documents are handled as *cells*: those of a group whose doc_id
falls into the same hash class. A group that holds a third of all rows is thus
a bounded number of rows, which can go to different shards.

1. Groups larger than an even share of all bytes fill one shard after another,
   cell by cell.
2. Propagation: the cells of every other group start in shards drawn by their
   hash class, in proportion to the room left there; the cells of a group in
   one shard are a piece. In each round, cut groups want to lie whole in one of
   their shards: in rounds of exchange the one that holds most of the group
   (ties: another hash each round), in rounds of room the one that holds most
   of it among those it still fits into. Exchange admits as much as departures
   of the same round make up for, by pairs of shards; room admits what a shard
   has room for without departures. A group that moved is whole and stays.
   Rounds end when neither kind admits anything.
3. Release: groups that a shard holds beyond its even share, and groups still
   cut, are dealt out whole by the filling if smaller documents (or the size of
   a share) can make up for their size. Larger ones go whole into shards that
   still have room for them; of those that fit nowhere the pieces stay.
4. Filling: all other documents fill what each shard lacks, in waves from
   large to small documents. Each wave deals its documents out in proportion
   to what the shards still lack, so the last wave, of the smallest
   documents, leaves differences of about one small document.

Running sums, for quotas, filling and slots, are two-level: sums per hash
bucket, then inside a bucket. No window holds more than a bucket or one row
per bucket, and the number of buckets follows the number of rows. The driver
holds one row per shard, pair of shards, size class or group larger than a share.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.shared import Tables

#: Cells of a group, at least; CELLS_PER_SHARD times the shards if that is more.
CELLS = 256
CELLS_PER_SHARD = 16
#: Groups up to this part of a share are always dealt out whole.
SMALL = 1 / 200
#: Rows of one bucket of a running sum.
BUCKET_ROWS = 20_000
#: Waves of filling: shares of the bytes still to deal out, from the largest documents on.
WAVES = (0.6, 0.9, 0.98, 0.998, 1.0)
#: Size classes per factor of two.
CLASSES = 8


def running_sum(df: DataFrame, value: str, by: list[str], key: list[str], rows: int, salt: int = 0) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same ``by`` that precede in hash order of ``key``."""
    bucket = F.pmod(F.xxhash64(*key, F.lit(salt)), F.lit(max(1, math.ceil(rows / BUCKET_ROWS))))
    df = df.withColumn("bucket", bucket)
    totals = df.groupBy(*by, "bucket").agg(F.sum(value).alias("total"))
    earlier = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, "bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*by, "bucket").orderBy(*(F.col(k) for k in key)).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return df.join(totals, [*by, "bucket"]).withColumn("before", F.col("base") + F.col("inside")).drop("bucket", "base", "inside")


def _of(values: dict[int, float], shard: str | Column) -> Column:
    """The value of a shard, from a map of one entry per shard."""
    return F.element_at(F.create_map(*(F.lit(x) for kv in sorted(values.items()) for x in kv)), F.col(shard) if isinstance(shard, str) else shard)


def _loads(df: DataFrame, weight: str, shards: int) -> dict[int, float]:
    """Weight per shard: one row per shard comes to the driver."""
    found = {r.shard: float(r.w or 0) for r in df.where("shard IS NOT NULL").groupBy("shard").agg(F.sum(weight).alias("w")).collect()}
    return {s: found.get(s, 0.0) for s in range(shards)}


def _class(weight: str) -> Column:
    return F.floor(F.log2(weight) * CLASSES).cast("int")


def _classes(df: DataFrame, weight: str) -> dict[int, float]:
    """Weight per size class."""
    return {r.c: float(r.w) for r in df.groupBy(_class(weight).alias("c")).agg(F.sum(weight).alias("w")).collect()}


def _dealt(place: Column, parts: list[float], whole: float, otherwise: int) -> Column:
    """The shard whose part of the range from 0 to ``whole`` holds ``place``; parts are proportional to ``parts``."""
    total, end, ends = sum(parts) or 1.0, 0.0, []
    for s, part in enumerate(parts):
        end += part / total * whole
        ends.append((s, end))
    shard = F.lit(otherwise)
    for s, e in reversed(ends):
        shard = F.when(place < e, F.lit(s)).otherwise(shard)
    return shard


def _hot(cells: DataFrame, shards: int, share: float, rows: int) -> DataFrame:
    """Cells (grp, cell, weight, shard) of the groups larger than a share: they fill one shard after another."""
    big = cells.where(F.col("total") > share)
    groups = big.groupBy("grp").agg(F.max("total").alias("total")).orderBy(F.desc("total"), "grp").collect()  # fewer than shards
    line = big.where(F.col("weight") <= share / 8)
    largest = line.agg(F.max("weight")).first()[0]
    if not groups or largest is None:
        return big.withColumn("shard", F.lit(None).cast("int")).select("grp", "cell", "weight", "shard")
    starts, at = [], 0
    for g in groups:
        starts += [F.lit(g.grp), F.lit(at)]
        at += g.total
    index = F.floor((F.element_at(F.create_map(*starts), F.col("grp")) + F.col("before")) / (share - largest)).cast("int")
    line = running_sum(line, "weight", ["grp"], ["cell"], rows).withColumn("shard", F.when(index < shards, index))
    return line.select("grp", "cell", "weight", "shard").unionByName(
        big.where(F.col("weight") > share / 8).select("grp", "cell", "weight", F.lit(None).cast("int").alias("shard"))
    )


def _accepted(load: dict[int, float], share: float, flow: dict[tuple[int, int], float]) -> dict[int, float]:
    """The largest part of its arrivals that each shard can take, given the departures that follow from all parts."""
    into = {t: 0.0 for t in load}
    for (_, t), w in flow.items():
        into[t] += w
    part = {t: 1.0 for t in load}
    for _ in range(1000):
        leaves = {s: 0.0 for s in load}
        for (s, t), w in flow.items():
            leaves[s] += part[t] * w
        new = {t: min(part[t], max(0.0, share - load[t] + leaves[t]) / into[t]) if into[t] else part[t] for t in load}
        if all(part[t] - new[t] < 1e-6 for t in load):
            return new
        part = new
    return part


def _propagate(cells: DataFrame, base: dict[int, float], share: float, rows: int, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Label propagation over cells (grp, total, shard, n, weight), in shards that hold ``base`` already.

    Returns the groups that lie in one shard (grp, total, shard), and the others (grp, total, pieces)."""
    spark, shards = cells.sparkSession, len(base)
    pieces = cells.groupBy("grp", "total", "shard").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))
    state = tables.write(pieces.groupBy("grp", "total").agg(F.collect_list(F.struct("shard", "n", "weight")).alias("pieces")), "groups")
    load = _loads(state.select(F.inline("pieces")), "weight", shards)
    load = {s: load[s] + base[s] for s in load}
    whole = state.where("size(pieces) = 1").select("grp", "total", F.col("pieces")[0]["shard"].alias("shard"))
    state = state.where("size(pieces) > 1")
    r = idle = 0
    while idle < 2:
        exchange = r % 2 == 0
        fits = lambda p: F.lit(True) if exchange else F.col("total") - p["weight"] <= _of({s: share - load[s] for s in load}, p["shard"])  # noqa: B023, E731
        best = F.array_max(F.transform("pieces", lambda p: F.struct(fits(p).alias("fits"), p["n"].alias("n"), F.xxhash64("grp", p["shard"], F.lit(r)).alias("tie"), p["shard"].alias("shard"), p["weight"].alias("weight"))))  # noqa: B023
        wants = state.withColumn("best", best).select("grp", "total", "pieces", F.col("best.shard").alias("target"), (F.col("total") - F.col("best.weight")).alias("move"), F.col("best.fits").alias("fits"))
        others = F.filter("pieces", lambda p: p["shard"] != F.col("target"))
        wants = wants.withColumn("source", F.array_max(F.transform(others, lambda p: F.struct(p["weight"].alias("weight"), p["shard"].alias("shard"))))["shard"])
        wants = tables.write(wants.withColumn("turn", F.xxhash64("grp", F.lit(r))), f"wants{r}")
        if exchange:
            leaving = wants.select("target", F.inline("pieces")).where("shard != target").groupBy("shard", "target").agg(F.sum("weight").alias("w"))
            part = _accepted(load, share, {(x.shard, x.target): float(x.w) for x in leaving.collect()})
            by, ask = ["source", "target"], wants
            quota = wants.groupBy(*by).agg(F.sum("move").alias("quota")).withColumn("quota", F.col("quota") * _of(part, "target"))
        else:
            by, ask = ["target"], wants.where("fits")
            quota = spark.createDataFrame([(s, share - load[s]) for s in load], "target int, quota double")
        taken = running_sum(ask, "move", by, ["turn", "grp"], rows, r).join(quota, by).where("before + move <= quota")
        taken = tables.write(taken.select("grp", "total", "pieces", "target", "move"), f"taken{r}")
        change = taken.select(F.inline("pieces"), "target").where("shard != target")
        change = change.select("shard", (-F.col("weight")).alias("w")).unionByName(taken.select(F.col("target").alias("shard"), F.col("move").alias("w")))
        change = _loads(change, "w", shards)
        idle = idle + 1 if taken.isEmpty() else 0
        if not idle:
            load = {s: load[s] + change[s] for s in load}
            whole = whole.unionByName(taken.select("grp", "total", F.col("target").alias("shard")))
            state = tables.write(wants.join(taken.select("grp"), "grp", "left_anti").select("grp", "total", "pieces"), f"groups{r}")
        r += 1
    return whole, state


def _fit(groups: DataFrame, load: dict[int, float], kept: DataFrame, share: float, rows: int, tables: Tables) -> tuple[DataFrame, dict[int, float], DataFrame]:
    """Put groups (grp, total) whole into shards with room for them, until none is left that fits anywhere.

    Returns the groups that are left, the loads, and ``kept`` (grp, total, shard) with the groups put."""
    r = 0
    while True:
        room = F.array(*(F.struct(F.lit(s).alias("shard"), F.lit(math.ceil(share) - load[s]).alias("room")) for s in sorted(load)))
        wants = groups.withColumn("open", F.filter(room, lambda x: x["room"] >= F.col("total"))).where("size(open) > 0")
        wants = wants.withColumn("shard", F.col("open")[F.pmod(F.xxhash64("grp", F.lit(r)), F.size("open")).cast("int")]["shard"]).drop("open")
        left = {s: math.ceil(share) - load[s] for s in load}
        taken = running_sum(wants, "total", ["shard"], ["grp"], rows, r).where(F.col("before") + F.col("total") <= _of(left, "shard"))
        taken = tables.write(taken.select("grp", "total", "shard"), f"fit{r}")
        if taken.isEmpty():
            return groups, load, kept
        new = _loads(taken, "total", len(load))
        load = {s: load[s] + new[s] for s in load}
        kept = kept.unionByName(taken)
        groups = tables.write(groups.join(taken.select("grp"), "grp", "left_anti"), f"unfit{r}")
        r += 1


def shard_documents(docs: DataFrame, shards: int = 16, even: str = "bytes") -> DataFrame:
    """Put every document into a shard so that sizes are even and equal texts lie together.

    ``even`` is what the shards have equal sums of: "bytes" (UTF-8 bytes of
    the text plus 1 for each document) or "rows".

    Returns doc_id, size, text_crc32 (unsigned, of the UTF-8 text), shard and
    slot (the document's place in its shard, from 0 without gaps), and linked
    (whether another document has the same text).

    NULL and empty texts have size 1 and count as one text. Rows that share a
    doc_id are separate rows; equal rows are told apart by nothing and keep
    their number. NULL doc_ids are allowed. Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    tables = Tables(spark, "sharding")
    text = F.coalesce("text", F.lit(""))
    classes = max(CELLS, CELLS_PER_SHARD * shards)
    own = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("grp"),
        F.pmod(F.xxhash64("doc_id"), F.lit(classes)).cast("int").alias("cell"),
    )
    own = tables.write(own.withColumn("weight", F.col("size") if even == "bytes" else F.lit(1).cast("long")), "documents")
    rows, total = own.agg(F.count("*"), F.sum("weight")).first()
    share = (total or 0) / shards
    cells = own.groupBy("grp", "cell").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    linked = cells.groupBy("grp").agg(F.sum("n").alias("docs"), F.sum("weight").alias("total")).where("docs > 1").select("grp", "total")
    cells = tables.write(cells.join(linked, "grp"), "cells")
    every = cells.select("grp", "cell")
    hot = tables.write(_hot(cells, shards, share, rows), "hot")
    base = _loads(hot, "weight", shards)
    room = [max(share - base[s], 0.0) for s in range(shards)]
    start = _dealt(F.col("cell") + 0.5, room, classes, shards - 1)
    cells = cells.where(F.col("total") <= share).withColumn("shard", start)
    whole, cut = _propagate(cells, base, share, rows, tables)
    kept = running_sum(whole, "total", ["shard"], ["grp"], rows)
    kept = tables.write(kept.where(F.col("before") + F.col("total") <= _of({s: math.ceil(share) - base[s] for s in base}, "shard")).select("grp", "total", "shard"), "kept")
    # groups without a shard: whole where that leaves the shards even
    load = _loads(kept, "total", shards)
    alone = own.join(every, ["grp", "cell"], "left_anti")
    smaller, fill = _classes(alone, "weight"), []
    lost = whole.join(kept.select("grp"), "grp", "left_anti").select("grp", "total")
    lost = tables.write(lost.unionByName(cut.select("grp", "total")), "lost")
    for c in _classes(lost, "total"):
        most = 2 ** ((c + 1) / CLASSES)
        if most <= SMALL * share or shards * most <= sum(w for x, w in smaller.items() if x < c):
            fill.append(c)
    units = lost.where(_class("total").isin(fill))
    large, load, kept = _fit(lost.where(~_class("total").isin(fill)), {s: base[s] + load[s] for s in base}, kept, share, rows, tables)
    pieces = cut.join(large.select("grp"), "grp", "left_semi").select("grp", F.inline("pieces"))
    pieces = running_sum(pieces, "weight", ["shard"], ["grp"], rows, 1)
    pieces = pieces.where(F.col("before") + F.col("weight") <= _of({s: math.ceil(share) - load[s] for s in load}, "shard")).select("grp", "shard")
    homes = cells.drop("shard").join(kept.select("grp", "shard"), "grp").select("grp", "cell", "shard", F.lit(False).alias("unit"))
    homes = homes.unionByName(cells.join(pieces, ["grp", "shard"]).select("grp", "cell", "shard", F.lit(False).alias("unit")))
    homes = homes.unionByName(cells.join(units.select("grp"), "grp").select("grp", "cell", F.lit(None).cast("int").alias("shard"), F.lit(True).alias("unit")))
    homes = homes.unionByName(hot.select("grp", "cell", "shard", F.lit(False).alias("unit")))
    # by cell, so that no group is a hot key of the documents
    placed = own.join(every.join(homes, ["grp", "cell"], "left").withColumn("linked", F.lit(True)), ["grp", "cell"], "left")
    placed = tables.write(placed.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("unit", "linked")}), "placed")
    placed = _fill(placed, shards, share, rows, tables)
    done = running_sum(placed.withColumn("one", F.lit(1)), "one", ["shard"], ["doc_id", "grp"], rows)
    done = done.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.col("before").cast("long").alias("slot"), "linked")
    done = done.checkpoint()
    tables.drop()
    return done


def _fill(placed: DataFrame, shards: int, share: float, rows: int, tables: Tables) -> DataFrame:
    """Deal documents without a shard out to what the shards lack, those of a unit together."""
    free = placed.where("shard IS NULL AND NOT unit").select("doc_id", "size", "text_crc32", "grp", "weight", "linked", "unit")
    units = placed.where("unit").groupBy("grp").agg(F.sum("weight").alias("weight"), F.lit(True).alias("unit"))
    free = free.unionByName(units, allowMissingColumns=True)
    classes = sorted(_classes(free, "weight").items(), reverse=True)
    total, seen, cuts, at = sum(w for _, w in classes), 0.0, [], 0
    for part in WAVES:  # each wave: the classes that reach its share of the bytes
        wave = []
        while at < len(classes) and (seen < part * total or part == 1.0):
            seen += classes[at][1]
            wave.append(classes[at])
            at += 1
        if wave:
            cuts.append((wave[0][0], wave[-1][0], sum(w for _, w in wave)))
    load = _loads(placed, "weight", shards)
    columns = ["doc_id", "size", "text_crc32", "grp", "linked", "shard"]
    done = [placed.where("shard IS NOT NULL").select(columns)]
    for k, (high, low, weight) in enumerate(cuts):
        lack = {s: max(share - load[s], 0.0) for s in load}
        wave = running_sum(free.where(_class("weight").between(low, high)), "weight", [], ["doc_id", "grp"], rows, 100 + k)
        middle = F.col("before") + F.col("weight") / 2
        shard = _dealt(middle, [lack[s] for s in range(shards)], weight, max((s for s in lack if lack[s] > 0), default=shards - 1))
        wave = tables.write(wave.withColumn("shard", shard).select(*columns, "weight", "unit"), f"wave{k}")
        new = _loads(wave, "weight", shards)
        load = {s: load[s] + new[s] for s in load}
        done.append(wave.where("NOT unit").select(columns))
        homes = wave.where("unit").select("grp", "shard")
        done.append(placed.where("unit").drop("shard").join(homes, "grp").select(columns))
    out = done[0]
    for wave in done[1:]:
        out = out.unionByName(wave)
    return out
