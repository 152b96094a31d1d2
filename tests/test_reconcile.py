"""Comparing a source with its replica."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowtide.functions.values import canonical_text
from rowtide.operators.reconcile import (
    classify,
    extra_keys,
    mismatched_rows,
    missing_keys,
    reconcile,
    run_until_converged,
)
from rowtide.schemas import LONG, ORDERS, RECONCILIATION, TEXT, TableSpec

TINY = TableSpec("shop", "orders", "order_id", {"order_id": LONG, "status": TEXT, "amount": TEXT})


def table(spark, *data):
    return spark.createDataFrame(list(data), "order_id long, status string, amount string")


def one_text(spark, value):
    df = spark.createDataFrame([(value,)], ["v"])
    dtype = dict(df.dtypes)["v"]
    return df.selectExpr(canonical_text("v", dtype)).first()[0]


def test_text_of_decimal(spark):
    df = spark.sql("SELECT CAST('1250.00' AS DECIMAL(12,2)) AS v")
    assert df.selectExpr(canonical_text("v", "decimal(12,2)")).first()[0] == "1250.00"


def test_text_of_moment(spark):
    moment = dt.datetime(2026, 9, 16, 10, 30, 45, 123999)
    assert one_text(spark, moment) == "2026-09-16T10:30:45.123"


def test_text_of_day(spark):
    assert one_text(spark, dt.date(2026, 9, 16)) == "2026-09-16"


def test_text_of_others(spark):
    assert one_text(spark, "x") == "x"
    assert spark.sql("SELECT CAST(NULL AS DECIMAL(12,2)) v").selectExpr(
        canonical_text("v", "decimal(12,2)")).first()[0] is None


def report(spark, source, target):
    return reconcile(source, target, TINY, {"valid_target_count": target}).first()


def test_equal_sides(spark):
    a = table(spark, (1, "PAID", "500.00"), (2, "CREATED", "750.00"))
    b = table(spark, (2, "CREATED", "750.00"), (1, "PAID", "500.00"))
    row = report(spark, a, b)
    assert (row.source_count, row.target_count, row.status) == (2, 2, "PASS")
    assert json.loads(row.details) == {"missing_ids": [], "extra_ids": [], "mismatch_ids": []}


def test_missing_row(spark):
    a, b = table(spark, (1, "a", "1"), (2, "b", "2")), table(spark, (1, "a", "1"))
    assert rows(missing_keys(a, b, TINY)) == [(2,)]
    row = report(spark, a, b)
    assert (row.missing_in_target, row.status, json.loads(row.details)["missing_ids"]) == (1, "FAIL", [2])


def test_extra_row(spark):
    a, b = table(spark, (1, "a", "1")), table(spark, (1, "a", "1"), (2, "b", "2"))
    assert rows(extra_keys(a, b, TINY)) == [(2,)]
    row = report(spark, a, b)
    assert (row.extra_in_target, row.status, json.loads(row.details)["extra_ids"]) == (1, "FAIL", [2])


def test_mismatched_row(spark):
    a, b = table(spark, (1, "PAID", "500.00")), table(spark, (1, "CREATED", "500.00"))
    row = mismatched_rows(a, b, TINY).first()
    assert (row.order_id, row.source_status, row.target_status) == (1, "PAID", "CREATED")
    assert json.loads(report(spark, a, b).details)["mismatch_ids"] == [1]


def test_nulls_are_equal_to_nulls_only(spark):
    a = table(spark, (1, None, None), (2, None, "1"))
    b = table(spark, (1, None, None), (2, "x", "1"))
    assert rows(classify(a, b, TINY)) == [(1, "MATCH"), (2, "MISMATCH")]


def test_empty_sides(spark):
    empty = table(spark, (1, "a", "1")).limit(0)
    row = report(spark, empty, empty)
    assert (row.source_count, row.target_count, row.status) == (0, 0, "PASS")


def test_types_and_scales_do_not_matter(spark):
    a = spark.sql("""SELECT 1L AS order_id, 2 AS customer_id, 'PAID' AS status, CAST(5 AS DECIMAL(20,4)) AS amount,
        'INR' AS currency, 'x' AS shipping_address, TIMESTAMP '2026-01-01 00:00:00.123456' AS created_at,
        TIMESTAMP_NTZ '2026-01-01 00:00:00' AS updated_at""")
    b = spark.sql("""SELECT 1 AS order_id, 2L AS customer_id, 'PAID' AS status, CAST('5.00' AS DECIMAL(12,2)) AS amount,
        'INR' AS currency, 'x' AS shipping_address, TIMESTAMP_NTZ '2026-01-01 00:00:00.123' AS created_at,
        TIMESTAMP '2026-01-01 00:00:00' AS updated_at""")
    assert rows(classify(a, b, ORDERS)) == [(1, "MATCH")]


def test_details_hold_the_first_hundred_ids_of_each_class(spark):
    ids = spark.range(1000).select(F.col("id").alias("order_id"), F.lit("s").alias("status"), F.lit("1").alias("amount"))
    source, target = ids.filter("id < 900"), ids.filter("id >= 300").withColumn("status", F.lit("t"))
    row = report(spark, source, target)
    assert (row.missing_in_target, row.extra_in_target, row.mismatched_rows) == (300, 100, 600)
    details = json.loads(row.details)
    assert details["missing_ids"] == list(range(100))
    assert details["extra_ids"] == list(range(900, 1000))
    assert details["mismatch_ids"] == list(range(300, 400))


def test_metrics_never_decide(spark):
    a = table(spark, (1, "a", "1"))
    row = reconcile(a, a, TINY, {"reject_count": a, "audit_count": a.limit(0)}).first()
    assert (row.reject_count, row.audit_count, row.raw_event_count, row.status) == (1, 0, 0, "PASS")


def test_samples_are_limited_before_the_shuffle(spark):
    a = table(spark, (1, "a", "1"))
    df = reconcile(a, a, TINY, {"reject_count": a})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 100, Partial" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


class Clock:
    def __init__(self):
        self.now, self.naps = 0.0, 0

    def time(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds
        self.naps += 1


@pytest.mark.parametrize("right_after,naps,status", [(1, 0, "PASS"), (3, 2, "PASS"), (99, 2, "FAIL")])
def test_run_until_converged(spark, tmp_path, right_after, naps, status):
    source, calls, clock = table(spark, (1, "a", "1")), [], Clock()

    def check():
        calls.append(1)
        target = source if len(calls) >= right_after else table(spark, (2, "a", "1"))
        return reconcile(source, target, TINY, {"raw_event_count": target})

    path = str(tmp_path / "log")
    result = run_until_converged(check, path, check_id=7, timeout_seconds=9, poll_seconds=3,
                                 clock=clock.time, sleep=clock.sleep)
    assert result.status == status and clock.naps == naps
    logged = spark.read.parquet(path)
    assert logged.schema.names == RECONCILIATION.names
    assert [f.dataType for f in logged.schema] == [f.dataType for f in RECONCILIATION]
    row = logged.first()
    assert logged.count() == 1 and (row.check_id, row.status) == (7, status) and row.checked_at is not None
