"""What the envelopes of a feed have beyond the fields the tables are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowtide.operators.decode import read_text
from rowtide.schemas import SOURCE_FIELDS, TableSpec, envelope_body

# Where in an envelope's body fields are looked for; the body itself is the empty path.
_PLACES = {"envelope": "", "source": ".source", "before": ".before", "after": ".after"}


def _known(spec: TableSpec) -> dict[str, list[str]]:
    image = list(spec.columns)
    return {"envelope": envelope_body(spec).names, "source": list(SOURCE_FIELDS), "before": image, "after": image}


def unknown_fields(feed: DataFrame, spec: TableSpec) -> DataFrame:
    """(place, field, type, records, first_partition, first_offset) of fields nobody asked for.

    A field that a producer adds changes no table: decoding reads the fields it knows. This
    report tells of it, with the type each value has and the first position it stands at.
    Values are read as VARIANT, so nothing has to be declared; a value that is no JSON
    object has no fields. Each record is taken apart once; only unknown fields are grouped.
    """
    known = _known(spec)
    listed = " WHEN ".join(
        f"'{place}' THEN f.key IN ({', '.join(repr(name) for name in names)})" for place, names in known.items()
    )
    parts = ", ".join(
        f"named_struct('place', '{place}', 'part', {'body' if not path else f'try_variant_get(body, {chr(39)}${path}{chr(39)}, {chr(39)}variant{chr(39)})'})"
        for place, path in _PLACES.items()
    )
    spark = feed.sparkSession
    return spark.sql(
        f"""
        WITH bodies AS (
            SELECT kafka_partition, kafka_offset,
                   coalesce(try_variant_get(whole, '$.payload', 'variant'), whole) AS body
            FROM (SELECT *, try_parse_json(payload) AS whole FROM {{records}})
        ), parts AS (
            SELECT kafka_partition, kafka_offset, inline(array({parts})) FROM bodies WHERE body IS NOT NULL
        ), extra AS (
            SELECT place, f.key AS field, schema_of_variant(f.value) AS type, kafka_partition, kafka_offset
            FROM parts, LATERAL variant_explode(part) AS f
            WHERE NOT CASE place WHEN {listed} END
        )
        SELECT place, field, type, count(*) AS records,
               min(struct(kafka_partition, kafka_offset)).kafka_partition AS first_partition,
               min(struct(kafka_partition, kafka_offset)).kafka_offset AS first_offset
        FROM extra GROUP BY place, field, type
        """,
        records=read_text(feed),
    )
