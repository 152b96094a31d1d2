"""Keyed tables held in Spark's state store and read from there.

The state of a key is its newest change, since when the row is in the replica, and since when
it is in the valid table. Keys are kept in blocks of neighbours, so that what a call of the state
store and of a Python function costs is paid for a block and not for each key. A micro-batch that
is run again finds the state as it was before, so every change counts once; there are no table
files to number, fold or clean up.
"""

from __future__ import annotations

import json
import re
import time
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from rowtide.functions.rules import passes_all
from rowtide.operators.latest import FILE_NUMBER, order_columns, streaming_latest
from rowtide.operators.views import SOURCE_ORDER, own_fields
from rowtide.schemas import LONG, TableSpec, current_schema
from rowtide.session import DROP_SHUFFLES, settings

REPLICATED, VALIDATED = "replicated_at", "validated_at"
# The replica's and the valid table's changes in the feed of changes.
REPLICA, VALID = "replica", "valid"
# Keys of a block, 64 at most: a block's rows (some 20 kB, a sixth of it when packed) are read and
# stored together, however few of them change.
BLOCK_BITS = 6


def change_schema(spec: TableSpec) -> T.StructType:
    """A typed change: its kind, the row, and where in the log and the source it stands."""
    lineage = zip(SOURCE_ORDER, [T.LongType(), T.StringType(), T.LongType(), T.IntegerType()])
    return T.StructType(
        [T.StructField("row_kind", T.StringType())]
        + current_schema(spec).fields
        + [T.StructField(name, kind) for name, kind in lineage]
    )


# The keys of a block and, packed, what is known of each. The store keeps a block in the log of
# each batch that touched it, in its files and in copies of these: unpacked that fills disks.
_STATE = "keys array<string>, rows binary"
# One column to and from Python; each column costs as much as all these values together.
_CHANGE = T.StructType([T.StructField("change", T.ArrayType(T.StringType()))])


def _state_names(spec: TableSpec) -> list[str]:
    return [*change_schema(spec).names, REPLICATED, VALIDATED]


def emitted_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField("table_name", T.StringType())] + change_schema(spec).fields)


def packed(rows: Iterable[Sequence[str | None]]) -> bytes:
    """Rows of texts column by column, where like stands beside like, as deflated JSON."""
    return zlib.compress(json.dumps([*zip(*rows)]).encode(), level=1)


def unpacked(block: bytes) -> list[list[str | None]]:
    """The columns of packed rows."""
    return json.loads(zlib.decompress(block))


def _file_number(name: str | None) -> int | None:
    number = re.search("([0-9]+)$", name or "")
    return int(number[1]) if number and int(number[1]) < 1 << 63 else None


class KeyedTables(StatefulProcessor):
    """Keeps the newest change of each key of a block and tells what it means for both tables.

    A table's row is inserted when the key enters the table, updated while it stays and
    deleted when it leaves. A key that was never in a table is never deleted from it: an
    invalid new row, or the delete of an unknown key, says nothing. Changes older than the
    newest known one do nothing.

    A deleted key's state stays as a marker, so that an older change which comes again does not
    bring the key back. With `keep_deleted` false the state goes with the delete: for logs that
    never hand out a key's records out of order, where state should follow the living keys.
    """

    def __init__(self, spec: TableSpec, order_by: str, keep_deleted: bool, told: tuple[str, ...]):
        self.told = told
        self.names = change_schema(spec).names
        self.key, self.kind = self.names.index(spec.key), self.names.index("row_kind")
        file = self.names.index("source_file")
        number = {FILE_NUMBER: (file, _file_number), "source_file": (file, str)}
        self.order = [number[c] if c in number else (self.names.index(c), int) for c in order_columns(order_by)]
        self.keep_deleted = keep_deleted

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("newest", _STATE)

    def _place(self, row: list) -> tuple:
        """The row's place in the order of changes; NULLs come first, as in Spark's own order."""
        values = [None if row[at] is None else read(row[at]) for at, read in self.order]
        return tuple((v is not None, v) for v in values)

    def _newest(self, rows: Iterator[Row]) -> dict[str, tuple[tuple, list]]:
        """The newest change of each key, with its place."""
        newest: dict[str, tuple[tuple, list]] = {}
        for row in rows:
            change = row["change"]
            place, known = self._place(change), newest.get(change[self.key])
            if known is None or place > known[0]:
                newest[change[self.key]] = place, change
        return newest

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._state.get()
        state = dict(zip(held[0], zip(*unpacked(held[1])))) if held else {}
        now, changed = str(time.time_ns() // 1000), False
        for own, (place, (*change, valid)) in self._newest(rows).items():
            before = state.get(own)
            if before and self._place(before) >= place:
                continue
            changed = True
            lives = {REPLICA: change[self.kind] != "DELETE", VALID: valid == "true"}
            stamps = []
            for table, at in ((REPLICA, -2), (VALID, -1)):
                since = before[at] if before else None
                stamps.append((since or now) if lives[table] else None)
                if table in self.told and (lives[table] or since):
                    kind = "DELETE" if not lives[table] else "UPDATE" if since else "INSERT"
                    yield Row(change=[table, *change[: self.kind], kind, *change[self.kind + 1 :]])
            if lives[REPLICA] or self.keep_deleted:
                state[own] = (*change, *stamps)
            else:
                state.pop(own, None)
        if changed and state:
            self._state.update((list(state), packed(state.values())))
        elif changed and held:
            self._state.clear()

    def close(self) -> None:
        pass


def _block(spec: TableSpec) -> Column:
    """The block of a key, as text: neighbours among whole numbers, else the key alone."""
    key = F.col(spec.key)
    return (F.shiftright(key, BLOCK_BITS) if spec.columns[spec.key] == LONG else key).cast("string")


def table_changes(
    changes: DataFrame,
    spec: TableSpec,
    order_by: str = "position",
    keep_deleted: bool = True,
    told: tuple[str, ...] = (REPLICA, VALID),
) -> DataFrame:
    """Changes of the replica and the valid table (`table_name`) from a stream of typed changes.

    `row_kind` is the table's own: what enters is an INSERT, what leaves a DELETE. Only the
    tables in `told` are told of; the state has both.
    """
    valid = F.expr(f"row_kind <> 'DELETE' AND {passes_all(spec.rules, own_fields(spec))}")
    own = [F.col(name).cast("string") for name in change_schema(spec).names]
    change = F.array(*own, F.coalesce(valid, F.lit(False)).cast("string")).alias("change")
    processor = KeyedTables(spec, order_by, keep_deleted, told)
    emitted = changes.select(_block(spec).alias("block"), change).groupBy("block").transformWithState(
        processor, _CHANGE, outputMode="update", timeMode="none"
    )
    return emitted.select(*[F.col("change")[n].cast(f.dataType).alias(f.name) for n, f in enumerate(emitted_schema(spec))])


# What the reader of states says of a query that has not finished a batch yet.
_NOTHING_YET = ("STDS_COMMITTED_BATCH_UNAVAILABLE", "STDS_OFFSET_LOG_UNAVAILABLE")


def _state_rows(spark: SparkSession, checkpoint: str, **options: str) -> DataFrame | None:
    """The state of a query as of its last finished batch; None before the first."""
    try:
        return spark.read.format("statestore").options(**options).load(checkpoint)
    except PySparkException as error:
        if error.getCondition() in _NOTHING_YET:
            return None
        raise


# Blocks whose rows are handed on together.
_READ_BLOCKS = 256


def _rows_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of packed blocks, in columns of text."""
    for batch in batches:
        for at in range(0, batch.num_rows, _READ_BLOCKS):
            columns: list[list[str | None]] = [[] for _ in names]
            for block in batch.column(0).slice(at, _READ_BLOCKS):
                for column, more in zip(columns, unpacked(block.as_py())):
                    column += more
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)


def read_keyed(
    spark: SparkSession, spec: TableSpec, checkpoint: str, valid: bool = False, stamp: str | None = None
) -> DataFrame:
    """The replica, or the valid table, as the state store has it after the last finished batch."""
    stamps = [T.StructField(stamp, T.TimestampType())] if stamp else []
    schema = T.StructType(current_schema(spec).fields + stamps)
    rows = _state_rows(spark, checkpoint, stateVarName="newest")
    if rows is None:
        return spark.createDataFrame([], schema)
    since = VALIDATED if valid else REPLICATED
    names = _state_names(spec)
    texts = T.StructType([T.StructField(name, T.StringType()) for name in names])
    live = rows.select("value.rows").mapInArrow(lambda blocks: _rows_of(blocks, names), texts).where(F.col(since).isNotNull())
    own = [F.col(f.name).cast(f.dataType).alias(f.name) for f in current_schema(spec)]
    return live.select(*own, *([F.timestamp_micros(F.col(since).cast("bigint")).alias(stamp)] if stamp else []))


# Catching up goes in steps of minutes that touch much of the state. Each is kept as files of the
# store alone, not as a log of its changes as well, and the last two are kept. A job that runs by
# the clock logs its small steps and keeps Spark's 100, for readers slower than its batches.
CATCH_UP = {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
}


def started(rows: DataFrame, writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """The stream of `rows` begun: a micro-batch `every` interval, or all that is there and then stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    with settings(rows.sparkSession, DROP_SHUFFLES if every else DROP_SHUFFLES | CATCH_UP):
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_latest_state(
    changes: DataFrame, spec: TableSpec, checkpoint: str, order_by: str = "position", every: str | None = "10 seconds"
) -> StreamingQuery:
    """The replica alone, as an aggregation: no Python, no stamps, delete markers for ever.

    The state is the table: nothing is written beside the checkpoint.
    """
    newest = streaming_latest(changes, spec, order_by)
    return started(newest, newest.writeStream.outputMode("update").format("noop"), checkpoint, every)


def read_latest_state(spark: SparkSession, spec: TableSpec, checkpoint: str) -> DataFrame:
    """The replica that `start_latest_state` keeps, read from its state store."""
    rows = _state_rows(spark, checkpoint)
    if rows is None:
        return spark.createDataFrame([], current_schema(spec))
    newest = "value.valueWithExtremumOrdering"
    fields = {name: f"{newest}.{name}" for name in current_schema(spec).names}
    live = rows.where(F.col(f"{newest}.row_kind") != "DELETE")
    return live.select(*[F.col(f"key.{n}" if n == spec.key else f).alias(n) for n, f in fields.items()])
