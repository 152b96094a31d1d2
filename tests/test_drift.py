"""Unknown fields of a feed, and log files that roll over."""

import json

from conftest import Log, envelope, order, rows

from rowtide.operators.decode import decode_changelog, decode_envelope
from rowtide.operators.drift import unknown_fields
from rowtide.operators.latest import current, streaming_latest
from rowtide.operators.views import typed_changes
from rowtide.schemas import ORDERS


def test_unknown_fields_have_place_type_and_first_position(spark):
    log = Log(spark)
    wide = {**order(1), "discount_code": "A", "tags": [1, 2]}
    log.add(envelope("c", None, order(1)))
    log.add(envelope("u", order(1), wide), partition=2, offset=9)
    log.add(envelope("u", {**order(1), "discount_code": None}, wide, wrapped=False), partition=2, offset=4)
    log.add(envelope("d", order(1), None, transaction={"id": "x"}), partition=3, offset=0)
    for odd in (None, "", "hello", "[]", "7", json.dumps({"payload": None}), json.dumps({"payload": {"after": 5}})):
        log.add(odd, partition=4)
    got = rows(unknown_fields(log.feed(), ORDERS), "place", "field", "type", "records", "first_partition", "first_offset")
    assert [r for r in got if r[0] != "envelope"] == [
        ("after", "discount_code", "STRING", 2, 2, 4),
        ("after", "tags", "ARRAY<BIGINT>", 2, 2, 4),
        ("before", "discount_code", "VOID", 1, 2, 4),
    ]
    assert ("envelope", "transaction", "OBJECT<id: STRING>", 1, 3, 0) in got
    assert unknown_fields(log.feed([]), ORDERS).count() == 0


def test_files_are_ordered_by_number(spark):
    log = Log(spark)
    for n, (name, city) in enumerate((("b.1000000", "new"), ("b.999999", "old"), ("b", "none"))):
        body = json.loads(envelope("c" if n else "u", None if n else order(1), order(1, city=city)))
        body["payload"]["source"]["file"] = name
        log.add(json.dumps(body))
    changes = typed_changes(decode_changelog(decode_envelope(log.feed(), ORDERS), ORDERS), ORDERS)
    assert rows(current(changes, ORDERS, order_by="source"), "shipping_address") == [("new",)]
    assert rows(streaming_latest(changes, ORDERS, "source"), "shipping_address") == [("new",)]
