"""Rule order, three-valued logic and amount spellings."""

from decimal import Decimal

import pytest
from conftest import envelope, order, rows
from pyspark.sql import functions as F

from rowtide.functions.rules import ORDER_RULES, first_failing, passes_all, verdict_of
from rowtide.functions.values import to_money
from rowtide.operators.decode import decode_changelog, decode_envelope
from rowtide.operators.latest import current, valid_current
from rowtide.operators.views import own_fields, typed_changes
from rowtide.schemas import ORDERS

# Images that break several rules at once; the first rule in order is reported.
CASES = [
    (dict(order_id=None, customer_id=None, amount="abc"), "ORDER_ID_NULL"),
    (dict(customer_id=None, amount="abc", currency="GBP"), "CUSTOMER_ID_NULL"),
    (dict(amount="abc", currency="GBP", status="LOST"), "AMOUNT_NOT_NUMERIC"),
    (dict(amount=None, currency="GBP"), "AMOUNT_NOT_NUMERIC"),
    (dict(amount="-1", currency="GBP", status="LOST"), "NEGATIVE_AMOUNT"),
    (dict(currency="GBP", status="LOST"), "INVALID_CURRENCY"),
    (dict(status="LOST"), "INVALID_STATUS"),
    (dict(currency=None, status="LOST"), "INVALID_STATUS"),
    (dict(currency=None), "VALID"),
    (dict(status=None), "VALID"),
    (dict(currency="inr"), "INVALID_CURRENCY"),
    (dict(), "VALID"),
]


FIELDS = own_fields(ORDERS)


def frame(spark, changes, op="c"):
    base = dict(order_id=1, customer_id=2, status="PAID", amount="5.00", currency="INR")
    row = {**base, **changes, "op": op}
    schema = "order_id long, customer_id long, status string, amount string, currency string, op string"
    return spark.createDataFrame([row], schema)


@pytest.mark.parametrize("changes,reason", CASES)
def test_first_failing_rule(spark, changes, reason):
    found = F.expr(first_failing(ORDER_RULES, "op", FIELDS))
    row = frame(spark, changes).select(found.alias("reason")).withColumn("v", F.expr(verdict_of("reason"))).first()
    assert row.reason == reason
    assert row.v == ("PASS" if reason == "VALID" else "FAIL")


@pytest.mark.parametrize("changes,_", CASES)
def test_deletes_always_pass(spark, changes, _):
    found = F.expr(first_failing(ORDER_RULES, "op", FIELDS))
    assert frame(spark, changes, op="d").select(found).first()[0] == "DELETE_EVENT"


@pytest.mark.parametrize("status", ["CREATED", "PAID", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED"])
@pytest.mark.parametrize("currency", ["INR", "USD", "EUR"])
def test_accepted_values(spark, status, currency):
    row = frame(spark, dict(status=status, currency=currency))
    assert row.filter(passes_all(ORDER_RULES, FIELDS)).count() == 1


@pytest.mark.parametrize(
    "text,money",
    [
        ("", None), (" 12.5 ", "12.50"), ("1e3", "1000.00"), ("12.345", "12.35"), ("-0.001", "0.00"),
        ("-0.005", "-0.01"), ("9999999999.99", "9999999999.99"), ("9999999999.995", None),
        ("NaN", None), ("0x10", None), ("1_0", None), (None, None),
    ],
)
def test_amounts(spark, text, money):
    got = spark.createDataFrame([(text,)], "t string").selectExpr(to_money("t")).first()[0]
    assert got == (Decimal(money) if money else None)


def state(log):
    changes = typed_changes(decode_changelog(decode_envelope(log.feed(), ORDERS), ORDERS), ORDERS)
    return current(changes, ORDERS), valid_current(changes, ORDERS)


@pytest.mark.parametrize("hole", [dict(currency=None), dict(status=None)])
def test_null_currency_or_status_is_in_neither_table(log, hole):
    """The verdict is VALID, yet the row is not known to be valid."""
    log.add(envelope("c", None, order(1, **hole)))
    replica, valid = state(log)
    assert replica.count() == 1 and valid.count() == 0


def test_row_leaves_and_reenters_the_valid_table(log):
    good, bad = order(1), order(1, status="BROKEN_STATUS")
    seen = []
    for before, after in ((None, good), (good, bad), (bad, good)):
        log.add(envelope("u" if before else "c", before, after))
        seen.append(state(log)[1].count())
    assert seen == [1, 0, 1]


def test_tiny_negative_amount_rounds_to_zero_and_is_valid(log):
    log.add(envelope("c", None, order(1, amount="-0.001"))).add(envelope("c", None, order(2, amount="-0.005")))
    assert rows(state(log)[1], "order_id") == [(1,)]
