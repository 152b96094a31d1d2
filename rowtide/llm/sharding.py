"""Shards balanced in bytes, tokens and rows at once, by vector bin packing.

Equal texts form a group. Large groups are packed one by one, the many small ones as cells
of a hash, so the number of things to pack is fixed and only their totals reach the driver.
Largest first, each goes where the dot product of its sizes with the shard's residual
capacity is highest. A group beyond a whole shard's share is the one case that is split.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import stored

SHARDS = 16
CELLS = 1 << 14
# A group of more than this part of the total, in any dimension, is packed by itself.
LARGE_PART = 1 / 1024
# Rows of one unit that are numbered in one task: at most about this part of all rows.
NUMBERED_PART = 1 / 256
TOKEN = r"[^\x20\x09-\x0D]+"


def pack(sizes: np.ndarray, shards: int = SHARDS) -> np.ndarray:
    """The shard of each row of `sizes` (a column per dimension, not negative).

    Dimensions are measured in shares of their total. Ties go to the lower shard.
    """
    totals = sizes.sum(axis=0)
    share = sizes / np.where(totals > 0, totals, 1)
    order = np.lexsort((np.arange(len(share)), -share.max(axis=1, initial=0.0)))
    residual = np.full((shards, sizes.shape[1]), 1.0 / shards)
    out = np.zeros(len(share), np.int64)
    for i in order:
        out[i] = best = int(np.argmax(residual @ share[i]))
        residual[best] -= share[i]
    return out


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: id, size (UTF-8 bytes and one), text_crc32, tokens, shard, slot.

    A null text has no bytes and no tokens. Slots number a shard's rows from 0 without
    gaps; rows that agree in id and text take theirs in any order. Other columns are not
    read. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.regexp_count(text, F.lit(TOKEN)).cast("long").alias("tokens"),
            F.xxhash64(text).alias("group"),
            F.xxhash64(F.col(id_col).cast("string"), F.lit("slot")).alias("salt"),
        )
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    totals = np.array([x or 0 for x in rows.agg(*sums).first()], float)
    least = np.maximum(totals * LARGE_PART, 1)
    groups = rows.groupBy("group").agg(*sums)
    dims = ("size", "tokens", "rows")
    # At most 1024 groups pass in each dimension.
    large = groups.where(F.greatest(*[F.col(c) > float(n) for c, n in zip(dims, least)])).collect()
    table = [(r["group"], *_parts([r[c] for c in dims], totals, shards)) for r in large]
    spark = docs.sparkSession
    known = spark.createDataFrame(table, "group long, pieces int, subs int")
    unit = [
        F.coalesce("group_known", F.pmod("group", F.lit(CELLS))).alias("unit"),
        F.col("group_known").isNotNull().alias("alone"),
        F.pmod("salt", F.coalesce("pieces", F.lit(1))).cast("int").alias("piece"),
        F.pmod(F.shiftright("salt", 20), F.coalesce("subs", F.lit(1))).cast("int").alias("sub"),
    ]
    known = F.broadcast(known.withColumnRenamed("group", "group_known"))
    placed = rows.join(known, F.col("group") == F.col("group_known"), "left").select("*", *unit)
    key = ["alone", "unit", "piece", "sub"]
    counts = placed.groupBy(*key).agg(*sums).toPandas().sort_values(key, ignore_index=True)
    plan = F.broadcast(spark.createDataFrame(_plan(counts, key, dims, shards), _PLAN))
    within = F.row_number().over(Window.partitionBy(*key).orderBy("id", "group"))
    return placed.withColumn("n", within).join(plan, key).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "tokens",
        "shard",
        (F.col("offset") + F.col("n") - 1).alias("slot"),
    )


_PLAN = "alone boolean, unit long, piece int, sub int, shard int, offset long"


def _parts(sizes: list[int], totals: np.ndarray, shards: int) -> tuple[int, int]:
    """Pieces a group is split into (1: it stays whole), and parts its rows are numbered in."""
    share = max(s / t for s, t in zip(sizes, totals) if t)
    pieces = math.ceil(4 * shards * share) if share > 1 / shards else 1
    return pieces, max(1, math.ceil(sizes[2] / totals[2] / NUMBERED_PART / pieces))


def _plan(counts, key: list[str], dims: tuple[str, ...], shards: int) -> list[tuple]:
    """Shard and first slot of every unit's part: a few tens of thousands at the most."""
    if not len(counts):
        return []
    unit = counts.groupby(key[:3], sort=False).ngroup().to_numpy()
    sizes = np.zeros((unit.max() + 1, len(dims)))
    np.add.at(sizes, unit, counts[list(dims)].to_numpy(float))
    shard = pack(sizes, shards)[unit]
    order = np.argsort(shard, kind="stable")
    rows = counts["rows"].to_numpy()[order]
    before = np.cumsum(rows) - rows
    first = np.concatenate([[True], np.diff(shard[order]) > 0])
    offset = np.zeros(len(counts), np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
    kinds = (bool, int, int, int)
    keys = zip(*(map(k, counts[c]) for k, c in zip(kinds, key)))
    return [(*k, int(s), int(o)) for k, s, o in zip(keys, shard, offset)]
