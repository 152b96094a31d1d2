"""Helpers shared by the operators: stored intermediates, size checks, native text forms."""

from __future__ import annotations

import string
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.session import new_run_dir

# Bytes of one text that are split into words at a time.
TEXT_PART = 1 << 22


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the checkpoint folder all executors share.

    Later reads start from those files, so a lost executor costs no recomputation and
    a costly pass over the texts runs once however often its result is used.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(new_run_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def broadcast_if(df: DataFrame, limit: int) -> DataFrame:
    """Hint a broadcast when the (stored) rows are at most `limit`; else leave a shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character untouched (`lower` would change É too)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_parts(data: bytes, size: int | None = None, at: bytes = b" \t\n\r\x0b\x0c") -> Iterator[bytes]:
    """A long text in parts of about `size` bytes, each but the first beginning with a byte of `at`."""
    size, begin = size or TEXT_PART, 0
    while len(data) - begin > size:
        end = begin + size
        while end < len(data) and data[end] not in at:
            end += 1
        yield data[begin:end]
        begin = end
    yield data[begin:]
