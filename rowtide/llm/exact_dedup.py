"""Exact duplicates by content sort, in DataFrame operations only.

Sampled splitters range-partition the texts by their first characters and then a hash, an
external sort places equal ones side by side, and each row is compared in full with its
neighbour. The hash keeps texts with one common beginning apart, and splitters are short
however long the texts. A text that holds a good part of all rows is never sorted: its
copies are reduced to one row in each task first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import shuffle_partitions

# The most texts that may count as hot.
HOT_TEXTS = 1024
# Characters of a text that its splitters show.
LEAD_CHARS = 16


def _hot_hashes(rows: DataFrame) -> list[int]:
    """Hashes of the texts that alone would fill a quarter of an even partition.

    Counted over all rows, by hash and map-side first: a few bytes for each text. The list
    only decides which way a text takes; either way gives the same result.
    """
    even = rows.count() / (4 * shuffle_partitions(rows))
    counts = rows.groupBy("_hash").count().where(F.col("count") > max(even, 2))
    return [r["_hash"] for r in counts.orderBy(F.desc("count"), "_hash").limit(HOT_TEXTS).collect()]


def _texts(docs: DataFrame, id_col: str, text_col: str, normalise) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("_id"),
        (normalise(text) if normalise else text).alias("_text"),
        F.struct("*").alias("_row"),
    )


def _order(keep: str) -> Column:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    return F.col("_id").asc_nulls_last() if keep == "smallest" else F.col("_id").desc_nulls_last()


def _cold_and_hot(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = rows.withColumn("_hash", F.xxhash64("_text"))
    hot = F.col("_hash").isin(_hot_hashes(rows))
    cold = rows.where(~hot).withColumn("_lead", F.substring("_text", 1, LEAD_CHARS))
    return cold.repartitionByRange("_lead", "_hash"), rows.where(hot)


def _equal_texts(keep: str):
    """Rows of one text; the range partitioning above already holds them together."""
    return Window.partitionBy("_lead", "_hash", "_text").orderBy(_order(keep))


def duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise=None,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised forms are (`normalise`: Column -> Column, default
    no change). A null text counts as empty. Of a group the smallest (or largest) id stays;
    null ids come last. When the winning id occurs more than once in its group, one of
    those rows is kept. Other columns are not read. An empty table gives no rows.
    """
    rows = _texts(docs, id_col, text_col, normalise).drop("_row")
    cold, hot = _cold_and_hot(rows)
    near = _equal_texts(keep)
    whole = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    digest = F.sha2(F.col("_text"), 256)
    out = [
        F.col("_id").alias(id_col),
        F.col("keep_id"),
        F.col("group_size"),
        F.col("kept"),
        F.col("text_sha256"),
    ]
    sorted_rows = cold.select(
        "_id",
        F.first("_id").over(whole).alias("keep_id"),
        F.count("*").over(whole).alias("group_size"),
        (F.row_number().over(near) == 1).alias("kept"),
        digest.alias("text_sha256"),
    ).select(*out)
    best = F.min("_id") if keep == "smallest" else F.max("_id")
    groups = hot.groupBy("_text").agg(best.alias("keep_id"), F.count("*").alias("group_size"))
    # At most HOT_TEXTS rows of fixed width: safe to broadcast.
    groups = F.broadcast(groups.select(digest.alias("text_sha256"), "keep_id", "group_size"))
    copies = hot.select("_id", digest.alias("text_sha256")).join(groups, "text_sha256")
    wins = F.col("_id").eqNullSafe(F.col("keep_id"))
    losers = copies.where(~wins).withColumn("kept", F.lit(False))
    # Only rows with the winning id meet here: one per group unless ids repeat.
    first = F.row_number().over(Window.partitionBy("text_sha256").orderBy("_id")) == 1
    winners = copies.where(wins).withColumn("kept", first)
    return sorted_rows.unionByName(losers.select(*out)).unionByName(winners.select(*out))


def drop_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise=None,
) -> DataFrame:
    """The rows of `docs` that stay, one per distinct text, with all their columns.

    Equality, nulls and ties are as in `duplicate_groups`.
    """
    rows = _texts(docs, id_col, text_col, normalise)
    cold, hot = _cold_and_hot(rows)
    rank = F.row_number().over(_equal_texts(keep))
    kept = cold.withColumn("_rank", rank).where("_rank = 1").select("_row.*")
    # Map-side, each task sends one row per hot text.
    nulls = F.col("_id").isNull()
    if keep == "smallest":
        best = F.min_by("_row", F.struct(nulls, F.col("_id")))
    else:
        best = F.max_by("_row", F.struct(~nulls, F.col("_id")))
    reduced = hot.groupBy("_text").agg(best.alias("_row"))
    return kept.unionByName(reduced.select("_row.*"))
