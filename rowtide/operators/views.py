"""Projections from decoded events to the output tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.lineage import (
    EVENT_ID,
    operation_name,
    state_digest,
    whole_second_millis,
)
from rowtide.functions.rules import first_failing, passes_all, verdict_of
from rowtide.functions.values import cut_to_millis, to_money, wall_clock
from rowtide.operators.decode import image_fields, source_field
from rowtide.schemas import (
    AMOUNT,
    EVENT_AUDIT,
    INSTANT,
    RAW_EVENTS,
    REJECTS,
    TableSpec,
    current_schema,
)

# Fields of the source block that follow an event into the audit.
LINEAGE = {
    "file": "source_file",
    "pos": "source_position",
    "row": "source_row",
    "gtid": "source_gtid",
    "ts_ms": "source_ts_ms",
}


def raw_events(text: DataFrame) -> DataFrame:
    """Every record verbatim, tombstones included."""
    return text.selectExpr(
        f"{EVENT_ID} AS event_id",
        "topic_name",
        "kafka_partition",
        "kafka_offset",
        f"{wall_clock(cut_to_millis('kafka_timestamp'))} AS kafka_timestamp",
        "payload",
        "payload IS NULL AS is_tombstone",
    ).select(RAW_EVENTS.names)


def unique_positions(raw: DataFrame) -> DataFrame:
    """One row per log position, for feeds that may hand out a record twice.

    A broker never does, so a feed read from one needs no such shuffle.
    """
    return raw.dropDuplicates(["topic_name", "kafka_partition", "kafka_offset"])


def enriched_events(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """Operation, lineage, verdict and digests of every event that could be decoded.

    Only the fields the view shows are cast, straight from the decoded envelope.
    """

    before, after = image_fields("before", spec), image_fields("after", spec)
    raw_fields = [name for name in ("amount", "status", "currency") if name in spec.columns]
    judged = decoded.filter("op IS NOT NULL").selectExpr(
        "topic_name",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "op",
        f"coalesce({after[spec.key]}, {before[spec.key]}) AS {spec.key}",
        *[f"{source_field(name)} AS {alias}" for name, alias in LINEAGE.items()],
        f"{first_failing(spec.rules, 'op', after)} AS validation_reason",
        f"{state_digest(spec.digest, before)} AS before_state",
        f"{state_digest(spec.digest, after)} AS after_state",
        *[f"{after[name]} AS {name}_raw" for name in raw_fields],
    )
    return judged.selectExpr(
        f"{EVENT_ID} AS event_id",
        "topic_name",
        "kafka_partition",
        "kafka_offset",
        f"{operation_name('op')} AS operation",
        spec.key,
        *LINEAGE.values(),
        f"{whole_second_millis('kafka_timestamp')} AS kafka_ts_ms",
        f"{verdict_of('validation_reason')} AS validation_status",
        "validation_reason",
        "before_state",
        "after_state",
        *[f"{name}_raw" for name in raw_fields],
    )


def event_audit(enriched: DataFrame) -> DataFrame:
    return enriched.select(EVENT_AUDIT.names)


def rejects(enriched: DataFrame) -> DataFrame:
    failed = enriched.filter(F.col("validation_status") == "FAIL")
    return failed.withColumnRenamed("validation_reason", "reason").select(REJECTS.names)


def source_metadata(changelog: DataFrame, spec: TableSpec) -> DataFrame:
    """Where each change comes from: log position, source time and the source block."""
    return changelog.selectExpr(
        spec.key,
        "topic_name",
        "kafka_partition",
        "kafka_offset",
        f"{wall_clock(cut_to_millis('kafka_timestamp'))} AS kafka_timestamp",
        f"{wall_clock('source_event_ts')} AS source_event_ts",
        "source_database",
        "source_table",
        "source_properties",
    )


SOURCE_ORDER = ["source_ts_ms", "source_file", "source_position", "source_row"]


def typed_changes(changelog: DataFrame, spec: TableSpec) -> DataFrame:
    """Changes with amounts as decimals and times without a zone, in log lineage."""
    casts = {AMOUNT: to_money, INSTANT: wall_clock}
    return changelog.selectExpr(
        "row_kind",
        *[f"{casts.get(kind, str)(name)} AS {name}" for name, kind in spec.columns.items()],
        f"{wall_clock('source_event_ts')} AS source_event_ts",
        "kafka_partition",
        "kafka_offset",
        *SOURCE_ORDER,
    )


def own_fields(spec: TableSpec) -> dict[str, str]:
    """Rule placeholders read straight from a table's own columns."""
    return {name: name for name in spec.columns}


def valid_rows(state: DataFrame, spec: TableSpec) -> DataFrame:
    return state.filter(passes_all(spec.rules, own_fields(spec)))


def current_rows(latest: DataFrame, spec: TableSpec) -> DataFrame:
    """Live rows of a latest-state table in their published columns."""
    return latest.filter(F.col("row_kind") != "DELETE").select(current_schema(spec).names)
