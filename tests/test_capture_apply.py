"""Snapshots, differences, applying them, and upserts."""

import json

import pytest
from conftest import SMALL, rows, same_rows
from pyspark.sql import functions as F

from rowtide.operators.apply import apply_feed, keyed_upsert
from rowtide.operators.capture import diff_feed, next_offset, snapshot_feed
from rowtide.operators.decode import decode_changelog, decode_envelope
from rowtide.operators.latest import current
from rowtide.operators.views import typed_changes
from rowtide.plans.inputs import final_orders, first_orders
from rowtide.schemas import FEED, ORDERS

AT = 1_790_000_000_000


def replica(feed):
    changes = typed_changes(decode_changelog(decode_envelope(feed, ORDERS), ORDERS), ORDERS)
    return current(changes, ORDERS).select(list(ORDERS.columns))


def awkward(spark):
    """Values that need escaping, NULLs, and a negative key."""
    return spark.sql("""
        SELECT * FROM VALUES
          (-7L, 1L, 'PA"ID', 1.50BD, 'INR', 'a\\nb', TIMESTAMP_NTZ'2026-01-01 00:00:00.001', TIMESTAMP_NTZ'2026-01-01'),
          (9007199254740993L, NULL, NULL, NULL, NULL, 'ünï', TIMESTAMP_NTZ'1969-12-31 23:59:59', NULL)
        AS t(order_id, customer_id, status, amount, currency, shipping_address, created_at, updated_at)
    """).withColumn("amount", F.col("amount").cast("decimal(12,2)"))


def test_snapshot_feed_gives_the_table_back(spark):
    for table in (awkward(spark), final_orders(spark, SMALL)):
        feed = snapshot_feed(table, ORDERS, AT)
        assert [f.dataType for f in feed.schema] == [f.dataType for f in FEED]
        same_rows(replica(feed), table)


def test_positions_are_unique_and_need_no_shuffle(spark):
    feed = snapshot_feed(first_orders(spark, SMALL), ORDERS, AT)
    assert feed.select("partition", "offset").distinct().count() == feed.count()
    assert feed.select("partition").distinct().count() == 6
    plan = snapshot_feed(awkward(spark), ORDERS, AT)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_snapshot_events(spark):
    row = snapshot_feed(first_orders(spark, SMALL).filter("order_id = 1"), ORDERS, AT).first()
    event = json.loads(row.value)["payload"]
    assert event["op"] == "r" and event["before"] is None and event["source"]["snapshot"] == "true"
    assert json.loads(row.key) == {"order_id": 1}


def test_difference_kinds(spark):
    old = spark.range(4).select(F.col("id").alias("order_id"), F.lit("a").alias("status"))
    fill = {c: F.lit(None) for c in ORDERS.columns if c not in ("order_id", "status")}

    def full(df):
        return df.withColumns(fill).select(list(ORDERS.columns))

    new = old.filter("order_id > 0").withColumn("status", F.expr("IF(order_id = 1, 'b', status)"))
    new = new.union(spark.sql("SELECT 9L, 'a'"))
    feed = diff_feed(full(old), full(new), ORDERS, AT)
    seen = {}
    for r in feed.orderBy("partition", "offset").collect():
        seen.setdefault(json.loads(r.key)["order_id"], []).append(r.value and json.loads(r.value)["payload"]["op"])
    assert seen == {0: ["d", None], 1: ["u"], 9: ["c"]}


def test_apply_of_difference_is_the_new_table(spark):
    old = first_orders(spark, SMALL).filter("order_id % 13 <> 1")
    new = final_orders(spark, SMALL)
    feed = diff_feed(old, new, ORDERS, AT)
    same_rows(apply_feed(old, feed, ORDERS), new)
    # Repeating the feed changes nothing, and an equal pair has no difference.
    same_rows(apply_feed(new, feed, ORDERS), new)
    assert diff_feed(new, new, ORDERS, AT).count() == 0


def test_snapshot_then_follow(spark):
    old, new = first_orders(spark, SMALL), final_orders(spark, SMALL)
    start = snapshot_feed(old, ORDERS, AT)
    follow = diff_feed(old, new, ORDERS, AT + 1000, base_offset=next_offset(start))
    same_rows(replica(start.union(follow)), new)


def customers(spark, *data):
    return spark.createDataFrame(list(data), "id long, name string, email string, created string, updated string")


def upsert(table, batch):
    now = F.lit("now")
    return keyed_upsert(table, batch, "id", ["name", "email"], touch={"updated": now},
                        defaults={"created": now, "updated": now})


def test_keyed_upsert(spark):
    table = customers(spark, (1, "a", "a@", "c", "u"), (2, "b", "b@", "c", "u"), (3, "c", None, "c", "u"))
    batch = spark.createDataFrame(
        [(2, "B", "b@"), (3, "c", None), (4, "d", "d@")], "id long, name string, email string")
    assert rows(upsert(table, batch)) == [
        (1, "a", "a@", "c", "u"), (2, "B", "b@", "c", "now"),
        (3, "c", None, "c", "u"), (4, "d", "d@", "now", "now"),
    ]


def test_keyed_upsert_is_repeatable_and_works_on_an_empty_table(spark):
    batch = spark.createDataFrame([(1, "a", "a@")], "id long, name string, email string")
    empty = customers(spark, (1, "", "", "", "")).limit(0)
    once = upsert(empty, batch)
    same_rows(upsert(once, batch), once)
    assert rows(once) == [(1, "a", "a@", "now", "now")]


def test_repeated_keys_take_the_last_row(spark):
    table = customers(spark, (1, "a", "a@", "c", "u"), (2, "b", "b@", "c", "u"))
    batch = spark.createDataFrame(
        [(1, "x", "x@", 1), (1, "y", "y@", 2), (3, "q", "q@", 5), (3, "p", "p@", 4), (-4, "n", "n@", 1)],
        "id long, name string, email string, seq int",
    )
    now = F.lit("now")
    got = keyed_upsert(table, batch, "id", ["name", "email"], touch={"updated": now},
                       defaults={"created": now, "updated": now}, order_by="seq")
    assert rows(got) == [
        (-4, "n", "n@", "now", "now"), (1, "y", "y@", "c", "now"),
        (2, "b", "b@", "c", "u"), (3, "q", "q@", "now", "now"),
    ]
    assert got.select("*")._jdf.queryExecution().executedPlan().toString().count("FullOuter") == 1
    with pytest.raises(Exception, match="occurs twice"):
        upsert(table, batch.drop("seq")).collect()


def test_negative_keys_follow_their_changes(spark):
    old = awkward(spark).withColumn("order_id", F.expr("-6000L - abs(order_id % 100)"))
    new = old.withColumn("status", F.lit("PAID"))
    start = snapshot_feed(old, ORDERS, AT)
    assert start.agg(F.min("offset")).first()[0] >= 0
    follow = diff_feed(old, new, ORDERS, AT + 1000, base_offset=next_offset(start))
    same_rows(replica(start.union(follow)), new)


def test_positions_of_both_signs_are_unique(spark):
    feed = snapshot_feed(spark.range(-100, 100).select(
        F.col("id").alias("order_id"), *[F.lit(None).alias(c) for c in ORDERS.columns if c != "order_id"]), ORDERS, AT)
    assert feed.select("partition", "offset").distinct().count() == 200


def test_untouched_rows_are_not_shuffled_when_changes_are_few(spark):
    table = first_orders(spark, SMALL)
    feed = diff_feed(table, table.where("order_id > 5"), ORDERS, AT)
    plan = apply_feed(table, feed, ORDERS)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
