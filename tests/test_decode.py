"""Tolerant and strict reading of envelopes."""

import datetime as dt
import json

import pytest
from conftest import Log, envelope, golden, order, rows
from pyspark.sql import functions as F

from rowtide.operators.decode import decode_changelog, decode_envelope, decode_structured, read_text
from rowtide.operators.views import enriched_events, raw_events, source_metadata, unique_positions
from rowtide.schemas import EVENT_AUDIT, ORDERS, RAW_EVENTS, REJECTS, SOURCE_FIELDS
from rowtide.operators.views import event_audit, rejects

UNREADABLE = ["hello", '{"payload": {"op"', "[]", "", '{"payload":"x"}', "{}", "null"]


def decoded(log):
    return decode_envelope(log.feed(), ORDERS)


def structured(log):
    return decode_structured(decoded(log), ORDERS)


def changelog(log, **options):
    return decode_changelog(decoded(log), ORDERS, **options)


def audit(log):
    return event_audit(enriched_events(decoded(log), ORDERS))


def test_wrapped_and_flat_read_the_same(log):
    log.add(envelope("c", None, order(1), wrapped=True)).add(envelope("c", None, order(1), wrapped=False))
    a, b = structured(log).drop("kafka_offset", "kafka_timestamp").collect()
    assert a == b
    assert a.after.order_id == 1 and a.before is None and a.op == "c" and a.source.pos == 0


@pytest.mark.parametrize("mode,offset", [("wrapped", 0), ("flat", 1)])
def test_envelope_can_be_fixed(log, mode, offset):
    log.add(envelope("c", None, order(1), wrapped=True)).add(envelope("c", None, order(1), wrapped=False))
    read = decode_envelope(log.feed(), ORDERS, mode).filter("op IS NOT NULL")
    assert rows(read, "kafka_offset") == [(offset,)]


def test_unknown_envelope_mode_is_refused(log):
    with pytest.raises(ValueError):
        decode_envelope(log.add(None).feed(), ORDERS, "avro")


def test_missing_extra_and_bad_fields(log):
    image = {"order_id": "abc", "customer_id": 5, "colour": "red"}
    log.add(json.dumps({"after": image, "op": "c"}))
    row = structured(log).first()
    assert row.after.order_id is None and row.after.customer_id == 5
    assert row.after.status is None and row.source.file is None and row.ts_ms is None


def test_quoted_whole_numbers(log):
    log.add(envelope("c", None, order("77", customer_id="1002")))
    assert structured(log).first().after.order_id == 77
    assert changelog(log).first().order_id == 77


@pytest.mark.parametrize("text", ["1.0", "1e3", "seven", ""])
def test_not_a_whole_number(log, text):
    log.add(envelope("c", None, order(text)))
    assert structured(log).first().after.order_id is None


def test_unreadable_records_stay_raw_only(log):
    for value in UNREADABLE:
        log.add(value)
    log.add(None)
    assert audit(log).count() == 0
    raw = raw_events(read_text(log.feed()))
    assert raw.schema.names == RAW_EVENTS.names
    assert rows(raw.filter("NOT is_tombstone"), "payload") == sorted(((v,) for v in UNREADABLE), key=repr)
    assert raw.filter("is_tombstone").count() == 1


@pytest.mark.parametrize("value", UNREADABLE)
def test_strict_reading_fails_on_unreadable(log, value):
    log.add(envelope("c", None, order(1))).add(value)
    with pytest.raises(Exception, match="not a row change: mysql.shop.orders.0.1"):
        changelog(log).collect()
    # Pruning every column must not remove the check.
    with pytest.raises(Exception, match="not a row change"):
        changelog(log).count()
    assert rows(changelog(log, on_bad_record="skip"), "order_id") == [(1,)]


@pytest.mark.parametrize(
    "value",
    [
        envelope("t"),
        envelope("u", None, order(1)),
        envelope("u", order(1), None),
        envelope("d", None, None),
        envelope("c", order(1), None),
        envelope("c", None, order("abc")),
        envelope("c", None, order(None)),
        envelope("c", None, order(1, customer_id="x")),
        envelope("c", None, order(1, created="yesterday")),
        envelope("u", order(1, updated="never"), order(1)),
    ],
)
def test_strict_reading_fails_on_malformed_changes(log, value):
    log.add(value)
    with pytest.raises(Exception, match="not a row change"):
        changelog(log).collect()
    assert changelog(log, on_bad_record="skip").count() == 0


def test_strict_reading_lets_business_errors_through(log):
    log.add(envelope("c", None, order(1, customer_id=None, amount="abc", status=None, currency="GBP")))
    assert rows(changelog(log), "row_kind", "order_id", "amount") == [("INSERT", 1, "abc")]


def test_on_bad_record_is_checked(log):
    with pytest.raises(ValueError):
        changelog(log.add(None), on_bad_record="ignore")


def test_row_kinds_and_images(log):
    golden(log)
    kinds = rows(changelog(log), "kafka_offset", "row_kind", "order_id")
    assert kinds == [
        (0, "INSERT", 5001), (1, "INSERT", 5002), (2, "INSERT", 5003), (3, "INSERT", 6001),
        (4, "UPDATE", 6001), (5, "DELETE", 5003), (7, "INSERT", 6002), (8, "INSERT", 6003),
        (9, "UPDATE", 5001),
    ]


def test_times_are_instants_cut_to_milliseconds(log):
    log.add(envelope("c", None, order(1, created="2026-09-16T12:30:00.123987+02:00")))
    row = changelog(log).first()
    assert row.created_at == dt.datetime(2026, 9, 16, 10, 30, 0, 123000)


def test_source_metadata(log):
    log.add(envelope("c", None, order(1), pos=7))
    row = source_metadata(changelog(log), ORDERS).first()
    assert set(row.source_properties) == set(SOURCE_FIELDS)
    assert row.source_properties["pos"] == "7" and row.source_properties["gtid"] is None
    assert (row.source_database, row.source_table) == ("shop", "orders")
    assert row.source_event_ts == dt.datetime.fromtimestamp(1_789_434_000, dt.UTC).replace(tzinfo=None)


def test_golden_event_tables(log):
    golden(log)
    raw = raw_events(read_text(log.feed()))
    assert raw.count() == 10 and raw.filter("is_tombstone").count() == 1
    seen = audit(log)
    assert seen.schema.names == EVENT_AUDIT.names
    assert [f.dataType for f in seen.schema] == [f.dataType for f in EVENT_AUDIT]
    verdicts = rows(seen, "kafka_offset", "operation", "validation_status", "validation_reason")
    assert verdicts == [
        (0, "SNAPSHOT_READ", "PASS", "VALID"), (1, "SNAPSHOT_READ", "PASS", "VALID"),
        (2, "SNAPSHOT_READ", "PASS", "VALID"), (3, "CREATE", "PASS", "VALID"),
        (4, "UPDATE", "PASS", "VALID"), (5, "DELETE", "PASS", "DELETE_EVENT"),
        (7, "CREATE", "FAIL", "INVALID_STATUS"), (8, "CREATE", "FAIL", "NEGATIVE_AMOUNT"),
        (9, "UPDATE", "PASS", "VALID"),
    ]
    bad = rejects(enriched_events(decoded(log), ORDERS))
    assert bad.schema.names == REJECTS.names
    assert rows(bad, "order_id", "reason", "amount_raw", "status_raw") == [
        (6002, "INVALID_STATUS", "450.00", "BROKEN_STATUS"),
        (6003, "NEGATIVE_AMOUNT", "-10.00", "CREATED"),
    ]


def test_digests_spell_missing_fields_as_null(log):
    log.add(envelope("c", None, order(1, customer_id=None, amount=None)))
    row = audit(log).first()
    assert row.after_state == "order_id=1,customer_id=null,status=CREATED,amount=null,currency=INR"
    assert row.before_state == "order_id=null,customer_id=null,status=null,amount=null,currency=null"


def test_unknown_operation_is_audited_and_rejected(log):
    log.add(envelope("t"))
    row = audit(log).first()
    assert (row.operation, row.order_id) == ("t", None)
    assert (row.validation_status, row.validation_reason) == ("FAIL", "ORDER_ID_NULL")


def test_delete_is_described_by_its_before_image(log):
    log.add(envelope("d", order(9, amount="abc"), None))
    row = audit(log).first()
    assert (row.order_id, row.validation_status) == (9, "PASS")
    assert rejects(enriched_events(decoded(log), ORDERS)).count() == 0


def test_event_id_and_log_time(log):
    import hashlib

    log.add(envelope("c", None, order(1)), partition=3, offset=12)
    row = audit(log).first()
    assert row.event_id == hashlib.md5(b"mysql.shop.orders|3|12").hexdigest()
    at = dt.datetime(2026, 9, 16, 10, 30, 57, tzinfo=dt.UTC)
    assert row.kafka_ts_ms == int(at.timestamp()) * 1000


def test_same_event_at_two_offsets_gives_two_audit_rows(log):
    log.add(envelope("c", None, order(1))).add(envelope("c", None, order(1)))
    assert audit(log).select("event_id").distinct().count() == 2


def test_unique_positions(spark):
    log = Log(spark)
    log.add(envelope("c", None, order(1)), offset=0).add(envelope("c", None, order(1)), offset=0)
    log.add(None, partition=1, offset=0).add(None, partition=1, offset=0)
    raw = unique_positions(raw_events(read_text(log.feed())))
    assert rows(raw, "kafka_partition", "kafka_offset") == [(0, 0), (1, 0)]


def test_binary_values_read_as_text(spark, log):
    from rowtide.sources.feed import as_feed

    golden(log)
    binary = log.feed().withColumn("value", F.col("value").cast("binary"))
    assert rows(as_feed(binary), "offset", "value") == rows(log.feed(), "offset", "value")


def test_one_parse_per_record(log):
    golden(log)
    plan = audit(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "Python" not in plan and "Exchange" not in plan
