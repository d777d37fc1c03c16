"""Sharding by sampled splitters: shards of near equal bytes, equal texts next to one another.

Records are ordered by (hash of the text, text's digest, doc_id). A bounded sample of keys, drawn by size, gives quantile
boundaries that cut this order into many more ranges than shards. A boundary stands at the edge of a group of equal texts,
unless the group is so large that several boundaries fall into it: then they stand inside the group, by doc_id. Ranges that
turn out overfull are subdivided by a new sample of their own. Sizes of ranges are then summed exactly, so each record knows the bytes before it in the
whole order, and that place divided by the bytes of a shard is its shard. A group of equal texts that is small against a
shard goes where it begins, whole; a large one is cut where a shard is full.

Defined results: a null text has no bytes, and weighs its overhead alone. Null ids come first. Rows that are equal in id and
text are placed one after another; which of them is which doesn't show. Fewer records than shards leave shards empty. An
empty table has no rows. Other columns are kept; names of the result's columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import ID, TEXT, clear, discard, pick, stored

OVERHEAD = 16  # bytes a record weighs besides its text
DRAWS_PER_RANGE = 24
ROWS_PER_RANGE, MOST_RANGES = 200_000, 4096  # ranges, and so the sample of their boundaries, stay few at any size
OVERFULL = 3.0  # times the mean
WHOLE = 1 / 64  # of a shard: a group of equal texts up to this size is kept in one shard


_OWN = ["_h", "_id", "_range", "_base", "_at", "_group", "_first", "_slot"]


def _key_columns(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({
        "_h": F.xxhash64(F.coalesce(F.col(text).isNotNull(), F.lit(False)), body), "_id": F.coalesce(F.xxhash64(F.lit(7), F.col(id_col)), F.lit(0)),
        "size": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + OVERHEAD,
    })


def _range_of(splitters: np.ndarray) -> Column:
    """Number of splitters at or below a record's (hash, id)."""

    @F.pandas_udf("int")
    def placed(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for h, i in parts:
            keys = np.empty(len(h), dtype=splitters.dtype)
            keys["h"], keys["i"] = h.to_numpy(), i.to_numpy()
            # by hash first; among splitters of the same hash by id
            low, high = np.searchsorted(splitters["h"], keys["h"], "left"), np.searchsorted(splitters["h"], keys["h"], "right")
            for first in np.unique(low[high > low]):
                rows = np.flatnonzero((low == first) & (high > low))
                low[rows] += np.searchsorted(splitters["i"][first : high[rows[0]]], keys["i"][rows], "right")
            yield pd.Series(low.astype("int32"))

    return placed("_h", "_id")


_KEY = np.dtype([("h", "<i8"), ("i", "<i8")])
_LOWEST = np.iinfo("i8").min


def _splitters(sample: list[tuple[int, int]], ranges: int) -> list[tuple[int, int]]:
    """Quantiles of a sample. A hash that holds one quantile splits at its edge, one that holds several at ids inside."""
    sample = sorted(sample)
    picked = [sample[len(sample) * k // ranges] for k in range(1, ranges)] if sample else []
    hashes: dict[int, list[int]] = {}
    for h, i in picked:
        hashes.setdefault(h, []).append(i)
    return [(h, i) for h, ids in hashes.items() for i in ([_LOWEST] if len(ids) == 1 else sorted({_LOWEST, *ids}))]


def _drawn(keyed: DataFrame, mean: float) -> list[tuple[int, int]]:
    """Keys drawn with a chance in proportion to size; a draw depends on the key alone, so a repeated task draws the same."""
    rolls = (F.pmod(F.xxhash64(F.lit(11), "_h", "_id"), F.lit(1 << 53)) / float(1 << 53)).alias("u")
    times = F.floor(F.col("size") / mean + rolls).cast("int")
    drawn = keyed.select("_h", "_id", times.alias("n")).filter("n > 0")
    return [(r._h, r._id) for r in drawn.collect() for _ in range(r.n)]


def assign_shards(docs: DataFrame, shards: int, id_col: str = ID, text: str = TEXT, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``docs`` with size, shard and slot (gapless within the shard)."""
    docs = clear(docs, id_col, text, reserved=_OWN)
    keyed = _key_columns(docs, id_col, text)
    narrow = stored(keyed.select("_h", "_id", "size"), "sizes")  # texts are read here, and once more for the result
    total, rows = narrow.agg(F.sum("size"), F.count("*")).first()
    if not rows:
        return docs.select("*", F.lit(0).cast("long").alias("size"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)
    ranges = max(4 * shards, min(rows // rows_per_range, MOST_RANGES))
    cuts = _splitters(_drawn(narrow, total / (ranges * DRAWS_PER_RANGE)), ranges)
    counts: dict[int, tuple[int, int]] = {}
    while True:
        splitters = np.array(sorted(set(cuts)), dtype=_KEY)
        ranged = narrow.withColumn("_range", _range_of(splitters))
        found = ranged.groupBy("_range").agg(F.sum("size"), F.count("*"), F.min(F.struct("_h", "_id")), F.max(F.struct("_h", "_id"))).collect()
        counts = {r[0]: (r[1], r[2]) for r in found}
        over = {r[0]: r[1] for r in found if r[1] > OVERFULL * total / ranges and r[3] != r[4]}
        if not over:
            break
        # Each overfull range gets boundaries from a sample of its own.
        mean = total / ranges / DRAWS_PER_RANGE
        inner = ranged.filter(F.col("_range").isin(list(over)))
        by: dict[int, list[tuple[int, int]]] = {k: [] for k in over}
        for key in _drawn(inner, mean):
            by[int(np.searchsorted(splitters, np.array([key], _KEY), "right")[0])].append(key)
        more = [c for k, size in over.items() for c in _splitters(by[k], int(size * ranges // total) + 1)]
        if set(more) <= set(cuts):
            break  # single records that are larger than a range
        cuts += more
    base, before = {}, 0
    for k in sorted(counts):
        base[k] = before
        before += counts[k][0]
    share = total / shards

    spark = docs.sparkSession
    bases = spark.createDataFrame(sorted(base.items()), "_range int, _base long")  # one row per range
    in_range = Window.partitionBy("_range").orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("_range", "_h")

    def sharded(df: DataFrame) -> DataFrame:
        at = df.withColumn("_range", _range_of(splitters)).join(F.broadcast(bases), "_range")
        at = at.withColumn("_at", F.col("_base") + F.sum("size").over(in_range) - F.col("size"))
        at = at.withColumns({"_group": F.sum("size").over(group), "_first": F.min("_at").over(group)})
        place = F.when(F.col("_group") <= share * WHOLE, F.col("_first")).otherwise(F.col("_at") + F.col("size") / 2)
        return at.withColumn("shard", F.least(F.floor(place / share), F.lit(shards - 1)).cast("int"))

    filled = sharded(narrow).groupBy("_range", "shard").count().collect()
    discard(narrow)
    next_slot: dict[int, int] = {}
    slots = []
    for r in sorted(filled, key=lambda r: (r["shard"], r["_range"])):
        slots.append((r["_range"], r["shard"], next_slot.get(r["shard"], 0)))
        next_slot[r["shard"]] = next_slot.get(r["shard"], 0) + r["count"]
    firsts = spark.createDataFrame(slots, "_range int, shard int, _slot long")  # one row per range and shard it reaches
    order = Window.partitionBy("_range", "shard").orderBy("_h", "_id")
    out = sharded(keyed.drop("shard", "slot")).join(F.broadcast(firsts), ["_range", "shard"])
    out = out.withColumn("slot", F.col("_slot") + F.row_number().over(order) - 1)
    return out.select(*[c for c in docs.columns if c not in ("size", "shard", "slot")], "size", "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within a file."""
    sharded.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_report(docs: DataFrame, shards: int) -> DataFrame:
    """Place of each document by the law ``bytes``."""
    narrow = pick(docs, ID, TEXT).withColumn("text_crc32", F.crc32(F.coalesce(TEXT, F.lit(""))))
    return assign_shards(narrow, shards).select(
        ID, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
