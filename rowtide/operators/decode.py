"""Envelope text to columns: one tolerant reading and one strict one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.values import to_instant, to_long
from rowtide.schemas import (
    INSTANT,
    LONG,
    SOURCE_FIELDS,
    TableSpec,
    envelope_body,
    envelope_schema,
)

POSITION = ["topic_name", "kafka_partition", "kafka_offset", "kafka_timestamp"]


def read_text(feed: DataFrame) -> DataFrame:
    """The record's position and its value as text, uninterpreted."""
    return feed.selectExpr(
        "topic AS topic_name",
        "partition AS kafka_partition",
        "offset AS kafka_offset",
        "timestamp AS kafka_timestamp",
        "CAST(value AS STRING) AS payload",
    )


def decode_envelope(feed: DataFrame, spec: TableSpec, envelope: str = "auto") -> DataFrame:
    """Parse every record once; fields that are missing or unreadable become NULL.

    The parsed value passes through a generator (`inline` of a one-element array).
    Catalyst does not copy expressions across a generator, so the filters and
    projections built on top share one JSON parse instead of repeating it.
    """
    schema = envelope_schema(spec, envelope)
    parsed = (
        read_text(feed)
        .withColumnRenamed("payload", "text")
        .select("*", F.inline(F.array(F.from_json("text", schema))))
    )
    body = {name: name for name in envelope_body(spec).names}
    if envelope == "wrapped":
        body = {name: f"payload.{name}" for name in body}
    elif envelope == "auto":
        body = {name: f"IF(payload IS NOT NULL, payload.{name}, {name})" for name in body}
    return parsed.selectExpr(
        *POSITION, "text AS payload", *[f"{read} AS {name}" for name, read in body.items()]
    )


def source_field(name: str) -> str:
    """One typed field of a decoded event's source block."""
    return f"try_cast(source['{name}'] AS {SOURCE_FIELDS[name]})"


def image_fields(image: str, spec: TableSpec) -> dict[str, str]:
    """The fields of a decoded event's `before` or `after`: whole numbers as numbers,
    amounts and times as the text they arrived in."""
    return {
        name: to_long(f"{image}.{name}") if kind == LONG else f"{image}.{name}"
        for name, kind in spec.columns.items()
    }


def _struct(fields: dict[str, str]) -> str:
    return "struct(" + ", ".join(f"{read} AS {name}" for name, read in fields.items()) + ")"


def decode_structured(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """Tolerant reading: nested before / after / source, NULL where a field is bad."""
    images = [
        f"IF({image} IS NULL, NULL, {_struct(image_fields(image, spec))}) AS {image}"
        for image in ("before", "after")
    ]
    source = _struct({name: source_field(name) for name in SOURCE_FIELDS})
    return decoded.selectExpr(
        *POSITION, *images, f"{source} AS source", "op", f"{to_long('ts_ms')} AS ts_ms"
    )


def _readable(image: str, spec: TableSpec) -> str:
    """The key is there and every present field of the image survives its cast."""
    checks = [f"{to_long(f'{image}.{spec.key}')} IS NOT NULL"]
    for cast, kind in ((to_long, LONG), (to_instant, INSTANT)):
        for name in spec.of_kind(kind):
            if name != spec.key:
                text = f"{image}.{name}"
                checks.append(f"({text} IS NULL) = ({cast(text)} IS NULL)")
    return f"({image} IS NULL OR ({' AND '.join(checks)}))"


def _well_formed(spec: TableSpec) -> str:
    """A known operation, the images it needs, and nothing unreadable in either."""
    needed = """CASE WHEN op IN ('c', 'r') THEN after IS NOT NULL
        WHEN op = 'u' THEN before IS NOT NULL AND after IS NOT NULL
        WHEN op = 'd' THEN before IS NOT NULL ELSE false END"""
    return f"({needed}) AND {_readable('before', spec)} AND {_readable('after', spec)}"


def decode_changelog(
    decoded: DataFrame, spec: TableSpec, on_bad_record: str = "fail"
) -> DataFrame:
    """Strict reading: one keyed row change per record, tombstones left out.

    `row_kind` is INSERT, UPDATE or DELETE and the row is `after`, or `before` for a
    delete. With `on_bad_record="fail"` a record that is not a well-formed change
    ends the job; the check sits in the filter, where no pruning can remove it.
    """
    if on_bad_record == "fail":
        otherwise = """raise_error(concat_ws('|', 'not a row change: ' || topic_name,
            kafka_partition, kafka_offset))"""
    elif on_bad_record == "skip":
        otherwise = "false"
    else:
        raise ValueError(f"on_bad_record must be fail or skip, not {on_bad_record!r}")
    keep = f"""CASE WHEN payload IS NULL THEN false WHEN {_well_formed(spec)} THEN true
        ELSE {otherwise} END"""
    casts = {LONG: to_long, INSTANT: to_instant}
    columns = [
        f"{casts.get(kind, str)(f'row.{name}')} AS {name}" for name, kind in spec.columns.items()
    ]
    return (
        decoded.filter(keep)
        .withColumn("row", F.expr("IF(op = 'd', before, after)"))
        .selectExpr(
            "CASE op WHEN 'd' THEN 'DELETE' WHEN 'u' THEN 'UPDATE' ELSE 'INSERT' END AS row_kind",
            *columns,
            f"timestamp_millis({source_field('ts_ms')}) AS source_event_ts",
            "source['db'] AS source_database",
            "source['table'] AS source_table",
            "source AS source_properties",
            *POSITION,
            f"{source_field('ts_ms')} AS source_ts_ms",
            f"{source_field('file')} AS source_file",
            f"{source_field('pos')} AS source_position",
            f"{source_field('row')} AS source_row",
        )
    )
