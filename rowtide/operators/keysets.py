"""Key sets as bitmaps: which keys one table has and another lacks, without sending keys around.

Whole-number keys fall into buckets of 32,768. Each task sets one bit for each key of a bucket,
and only the 4 kB bitmaps travel: a key costs one bit where keys are dense, and a key that
occurs in a task many times costs no more than once. Sparse keys (fewer than some 500 in a
bucket) are better off with the anti join of `reconcile.missing_keys`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.schemas import TableSpec

BUCKET_KEYS = 32_768
_BYTES = BUCKET_KEYS // 8


def key_set(table: DataFrame, key: str) -> DataFrame:
    """(bucket, bits): a bitmap of the keys in each bucket. Null keys are in none."""
    keys = table.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("k"))
    placed = keys.select(F.bitmap_bucket_number("k").alias("bucket"), F.bitmap_bit_position("k").alias("bit"))
    return placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def united(*sets: DataFrame) -> DataFrame:
    """The keys that any of the sets has."""
    rows = sets[0]
    for other in sets[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def size(keys: DataFrame) -> DataFrame:
    """One row: the number of keys in a set."""
    return keys.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def _byte(bits: Column, at: Column) -> Column:
    return F.coalesce(F.conv(F.hex(F.substring(bits, at + 1, 1)), 16, 10).cast("int"), F.lit(0))


def difference(left: DataFrame, right: DataFrame, name: str = "key") -> DataFrame:
    """The keys of `left` that `right` lacks: bitmaps meet by bucket, keys are read off the bits.

    Buckets with equal bitmaps are passed over; of the others each byte is looked at once.
    """
    other = right.select(F.col("bucket").alias("b_bucket"), F.col("bits").alias("b_bits"))
    met = left.join(other, left["bucket"] == other["b_bucket"], "left").where("b_bits IS NULL OR bits <> b_bits")
    bytes_ = met.select("bucket", "bits", "b_bits", F.explode(F.sequence(F.lit(0), F.lit(_BYTES - 1))).alias("at"))
    lacking = _byte(F.col("bits"), F.col("at")).bitwiseAND(F.bitwise_not(_byte(F.col("b_bits"), F.col("at"))))
    bits = bytes_.select("bucket", "at", lacking.alias("lacking")).where("lacking <> 0")
    bits = bits.select("bucket", "at", "lacking", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("n"))
    place = F.col("at") * 8 + F.col("n")
    # Buckets from 1 on count up from their first key, the others down from zero.
    up = (F.col("bucket") - 1) * BUCKET_KEYS + place + 1
    key = F.when(F.col("bucket") > 0, up).otherwise(F.col("bucket") * BUCKET_KEYS - place)
    return bits.where(F.expr("(lacking & shiftleft(1, n)) <> 0")).select(key.cast("bigint").alias(name))


def missing_by_bitmap(source: DataFrame, target: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of the source that the target lacks, in order, as `missing_keys` gives them."""
    lacking = difference(key_set(source, spec.key), key_set(target, spec.key), spec.key)
    return lacking.orderBy(spec.key)


def extra_by_bitmap(source: DataFrame, target: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of the target that the source lacks, in order."""
    return missing_by_bitmap(target, source, spec)
