import datetime as dt
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowtide.schemas import FEED, ORDERS  # noqa: E402
from rowtide.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


def order(order_id, customer_id=1001, status="CREATED", amount="10.00", currency="INR", city="Kolkata",
          created="2026-09-16T10:00:00.000Z", updated="2026-09-16T10:00:00.000Z"):
    return {
        "order_id": order_id, "customer_id": customer_id, "status": status, "amount": amount,
        "currency": currency, "shipping_address": city, "created_at": created, "updated_at": updated,
    }


def envelope(op, before=None, after=None, pos=0, wrapped=True, ts_ms=1_789_434_000_000, **extra):
    source = {
        "version": "3.6.0", "connector": "mysql", "name": "mysql", "ts_ms": ts_ms,
        "snapshot": "true" if op == "r" else "false", "db": "shop", "table": "orders",
        "server_id": 223344, "gtid": None, "file": "mysql-bin.000001", "pos": pos, "row": 0,
    }
    body = {"before": before, "after": after, "source": source, "op": op, "ts_ms": ts_ms + 250, **extra}
    return json.dumps({"schema": None, "payload": body} if wrapped else body)


class Log:
    """A hand-made feed: values are appended at growing offsets."""

    def __init__(self, spark, partitions=1):
        self.spark, self.partitions, self.rows = spark, partitions, []

    def add(self, value, partition=0, offset=None):
        offset = len(self.rows) if offset is None else offset
        at = dt.datetime(2026, 9, 16, 10, 30, 45, 987000) + dt.timedelta(seconds=offset)
        self.rows.append((ORDERS.topic, partition, offset, at, None, value))
        return self

    def feed(self, rows=None):
        return self.spark.createDataFrame(self.rows if rows is None else rows, FEED)


@pytest.fixture
def log(spark):
    return Log(spark)


# The rows of the golden scenario.
def golden(log):
    """Three snapshot rows, then an insert, its update, a delete, two bad rows, a wider row."""
    log.add(envelope("r", None, order(5001, 1001, "CREATED", "1250.00", "INR", "Kolkata")))
    log.add(envelope("r", None, order(5002, 1002, "PAID", "2599.50", "INR", "Bengaluru")))
    log.add(envelope("r", None, order(5003, 1003, "SHIPPED", "899.00", "INR", "Chennai")))
    placed = order(6001, 1001, "CREATED", "799.00", "INR", "Kolkata")
    log.add(envelope("c", None, placed))
    log.add(envelope("u", placed, {**placed, "status": "PAID", "amount": "849.00"}, wrapped=False))
    log.add(envelope("d", order(5003, 1003, "SHIPPED", "899.00", "INR", "Chennai"), None))
    log.add(None)
    log.add(envelope("c", None, order(6002, 1002, "BROKEN_STATUS", "450.00", "INR", "Bengaluru")))
    log.add(envelope("c", None, order(6003, 1003, "CREATED", "-10.00", "INR", "Chennai")))
    first = order(5001, 1001, "CREATED", "1250.00", "INR", "Kolkata")
    log.add(envelope("u", {**first, "discount_code": None}, {**first, "discount_code": "WELCOME10"}))
    return log


def rows(df, *columns):
    """Sorted tuples of the given (or all) columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert rows(a, *columns) == rows(b, *columns)
