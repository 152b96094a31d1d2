"""The newest change per key."""

import random

import pytest
from conftest import Log, envelope, golden, order, rows, same_rows

from rowtide.operators.decode import decode_changelog, decode_envelope
from rowtide.operators.latest import current, latest_changes, valid_current
from rowtide.operators.views import typed_changes
from rowtide.schemas import CUSTOMERS, ORDERS, current_schema


def typed(log, rows_=None):
    decoded = decode_envelope(log.feed(rows_), ORDERS)
    return typed_changes(decode_changelog(decoded, ORDERS), ORDERS)


def test_golden_state(log):
    golden(log)
    replica, valid = current(typed(log), ORDERS), valid_current(typed(log), ORDERS)
    assert replica.schema.names == current_schema(ORDERS).names
    assert [f.dataType for f in replica.schema] == [f.dataType for f in current_schema(ORDERS)]
    assert rows(replica, "order_id") == [(5001,), (5002,), (6001,), (6002,), (6003,)]
    assert [(r[0], r[1], str(r[2])) for r in rows(valid, "order_id", "status", "amount")] == [
        (5001, "CREATED", "1250.00"), (5002, "PAID", "2599.50"), (6001, "PAID", "849.00"),
    ]


def test_delete_of_an_unknown_key_is_no_row(log):
    log.add(envelope("d", order(1), None))
    assert current(typed(log), ORDERS).count() == 0


def test_recreated_key_is_back(log):
    log.add(envelope("c", None, order(1))).add(envelope("d", order(1), None)).add(None)
    log.add(envelope("c", None, order(1, city="Delhi")))
    assert rows(current(typed(log), ORDERS), "order_id", "shipping_address") == [(1, "Delhi")]


def test_changed_primary_key_is_delete_plus_create(log):
    log.add(envelope("c", None, order(1))).add(envelope("d", order(1), None)).add(None)
    log.add(envelope("c", None, order(2)))
    assert rows(current(typed(log), ORDERS), "order_id") == [(2,)]


def test_redelivery_keeps_the_later_offset(log):
    log.add(envelope("c", None, order(1))).add(envelope("c", None, order(1)))
    assert rows(current(typed(log), ORDERS), "order_id", "kafka_offset") == [(1, 1)]


def test_source_order_survives_a_repartitioned_topic(spark):
    """The key moved to a lower partition: the log position is wrong, the source position right."""
    log = Log(spark)
    log.add(envelope("c", None, order(1, city="old"), pos=10), partition=5, offset=3)
    log.add(envelope("u", order(1), order(1, city="new"), pos=20), partition=2, offset=0)
    by = lambda how: rows(current(typed(log), ORDERS, order_by=how), "shipping_address")
    assert by("position") == [("old",)] and by("source") == [("new",)]


def test_order_by_is_checked(log):
    golden(log)
    with pytest.raises(ValueError):
        current(typed(log), ORDERS, order_by="time")


def brute_force(events):
    held = {}
    for op, key, city in events:
        if op == "d":
            held.pop(key, None)
        else:
            held[key] = city
    return sorted(held.items())


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force_with_a_hot_key(spark, seed):
    rng, log, events = random.Random(seed), Log(spark), []
    for i in range(300):
        key = 7 if rng.random() < 0.4 else rng.randrange(20)
        op, city = rng.choice("ccuud"), f"city{i}"
        events.append((op, key, city))
        image = order(key, city=city)
        log.add(envelope(op, None if op == "c" else image, None if op == "d" else image), partition=key % 3)
    shuffled = log.rows[:]
    rng.shuffle(shuffled)
    got = rows(current(typed(log, shuffled), ORDERS), "order_id", "shipping_address")
    assert got == sorted(brute_force(events), key=repr)
    # Replaying any suffix changes nothing.
    replayed = log.rows + log.rows[rng.randrange(300):]
    same_rows(current(typed(log, replayed), ORDERS), current(typed(log), ORDERS))


def test_hot_keys_are_reduced_before_the_shuffle(log):
    golden(log)
    plan = latest_changes(typed(log), ORDERS)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial  # the plan prints parents first
    assert plan.count("Exchange") == 1 and plan.count("from_json(") == 1


def test_second_table_needs_only_a_description(spark):
    import json

    image = {"customer_id": 1, "full_name": "A", "email": None, "country_code": "IN",
             "created_at": "2026-01-01T00:00:00.000Z", "updated_at": "2026-01-01T00:00:00.000Z"}
    log = Log(spark)
    log.add(json.dumps({"before": None, "after": image, "op": "c", "source": {"ts_ms": 5}}))
    decoded = decode_envelope(log.feed(), CUSTOMERS)
    replica = current(typed_changes(decode_changelog(decoded, CUSTOMERS), CUSTOMERS), CUSTOMERS)
    assert rows(replica, "customer_id", "full_name") == [(1, "A")]
