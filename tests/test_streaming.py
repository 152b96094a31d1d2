"""The continuous job: splits, restarts, repeats, retractions, failures."""

import datetime as dt
import json
import os
import random
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import SMALL, Log, envelope, golden, order, rows, same_rows
from pyspark.sql import functions as F

from rowtide.operators.decode import decode_changelog, decode_envelope, read_text
from rowtide.operators.latest import current, valid_current
from rowtide.operators.views import enriched_events, event_audit, raw_events, rejects, typed_changes
from rowtide.plans.inputs import order_feed
from rowtide.schemas import FEED, ORDERS
from rowtide.sources.feed import log_options, read_feed_files
from rowtide.sources.tables import jdbc_options, merge_statements
from rowtide.streaming import keyed, taken
from rowtide.streaming.pipeline import (
    ALL_TABLES,
    AUDIT,
    CURRENT,
    RAW,
    REJECT,
    VALID,
    Pipeline,
    drain,
    event_counts,
    read_output,
    read_valid_changes,
    start,
    start_events,
    write_events,
)


def batch_twins(feed):
    """What each table must hold, computed in one go."""
    decoded = decode_envelope(feed, ORDERS)
    enriched = enriched_events(decoded, ORDERS)
    changes = typed_changes(decode_changelog(decoded, ORDERS), ORDERS)
    return {
        RAW: raw_events(read_text(feed)),
        AUDIT: event_audit(enriched),
        REJECT: rejects(enriched),
        CURRENT: current(changes, ORDERS),
        VALID: valid_current(changes, ORDERS),
    }


def assert_tables(spark, pipeline, feed):
    for table, expected in batch_twins(feed).items():
        same_rows(read_output(spark, pipeline, table), expected)


def deliver(feed, path):
    """Add records to the folder a file stream reads."""
    feed.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def small_feed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed") / "log")
    order_feed(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


def take_in(spark, source, pipeline, feed):
    """One delivery, and a run of the job over what is new."""
    deliver(feed, source)
    drain(read_feed_files(spark, source, streaming=True), pipeline)


@pytest.mark.parametrize("order", [((0,), (1,), (2, 3), (4, 5)), ((4, 5), (2, 3), (0, 1))])
def test_events_of_a_key_spread_over_batches(spark, tmp_path, small_feed, order):
    """Cut the log by step: updates, deletes and re-creations arrive batches later, or first."""
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"))
    for steps in order:
        take_in(spark, source, pipeline, small_feed.filter((F.col("offset") % 8).isin(*steps)))
    assert_tables(spark, pipeline, small_feed)


def test_tables_without_stamps(spark, tmp_path, small_feed):
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), stamps=False)
    for part in ("offset % 8 IN (1, 4, 5)", "offset % 8 IN (0, 2, 3)"):
        take_in(spark, source, pipeline, small_feed.filter(part))
    assert_tables(spark, pipeline, small_feed)
    with pytest.raises(ValueError):
        read_output(spark, pipeline, CURRENT, stamped=True)


def random_log(spark, seed, n=120):
    rng, log = random.Random(seed), Log(spark)
    for i in range(n):
        key, op = rng.randrange(12), rng.choice("ccuud")
        image = order(key, city=f"c{i}", status=rng.choice(["PAID", "LOST", None]))
        log.add(envelope(op, None if op == "c" else image, None if op == "d" else image))
    return rng, log


def test_random_split_with_repeats(spark, tmp_path):
    rng, log = random_log(spark, 5)
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"))
    cuts = sorted(rng.sample(range(1, 120), 3))
    for a, b in zip([0, *cuts], [*cuts, 120]):
        again = rng.sample(log.rows[:b], 5) + log.rows[a:b][:2]  # some of it handed out once more
        take_in(spark, source, pipeline, log.feed(log.rows[a:b] + again))
    assert_tables(spark, pipeline, log.feed())
    keys = rows(read_output(spark, pipeline, VALID), "order_id")
    assert set(keys) <= set(rows(read_output(spark, pipeline, CURRENT), "order_id"))


def test_valid_changes_follow_the_table(spark, tmp_path):
    """A delete only for a key that is in the table; an insert only for one that is not."""
    rng, log = random_log(spark, 8, 90)
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), tables=(VALID,))
    members = set()
    for a in range(0, 90, 30):
        before = set(read_valid_changes(spark, pipeline).collect()) if a else set()
        take_in(spark, source, pipeline, log.feed(log.rows[a : a + 30]))
        told = [r for r in read_valid_changes(spark, pipeline).collect() if r not in before]
        assert len({r.order_id for r in told}) == len(told)
        for r in told:
            assert (r.row_kind == "INSERT") == (r.order_id not in members)
            (members.discard if r.row_kind == "DELETE" else members.add)(r.order_id)
        assert members == {r.order_id for r in batch_twins(log.feed(log.rows[: a + 30]))[VALID].collect()}
    same_rows(read_output(spark, pipeline, VALID), batch_twins(log.feed())[VALID])


def test_a_key_that_was_never_valid_is_never_deleted(spark, tmp_path):
    bad = order(1, status="LOST")
    log = Log(spark)
    log.add(envelope("c", None, bad)).add(envelope("u", bad, bad)).add(envelope("d", bad, None))
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), tables=(VALID,))
    for n in range(3):
        take_in(spark, source, pipeline, log.feed(log.rows[n : n + 1]))
    assert read_valid_changes(spark, pipeline).count() == 0


@pytest.mark.parametrize("keep", [True, False])
def test_a_deleted_key_leaves_a_marker_or_nothing(spark, tmp_path, keep):
    log = Log(spark)
    log.add(envelope("c", None, order(1))).add(envelope("d", order(1), None))
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), tables=(CURRENT,), keep_deleted=keep)
    for n in (1, 0):  # the older change comes late
        take_in(spark, source, pipeline, log.feed(log.rows[n : n + 1]))
        if n:
            state = spark.read.format("statestore").option("stateVarName", "newest").load(pipeline.checkpoint("keyed"))
            assert state.count() == (1 if keep else 0)
    assert read_output(spark, pipeline, CURRENT).count() == (0 if keep else 1)


def test_restart_from_checkpoint(spark, tmp_path, small_feed):
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"))
    take_in(spark, source, pipeline, small_feed.filter("offset % 2 = 0"))
    before = rows(read_output(spark, pipeline, AUDIT, stamped=True), "event_id", "inserted_at")
    drain(read_feed_files(spark, source, streaming=True), pipeline)  # nothing new
    assert rows(read_output(spark, pipeline, AUDIT, stamped=True), "event_id", "inserted_at") == before
    take_in(spark, source, pipeline, small_feed.filter("offset % 2 = 1"))
    assert_tables(spark, pipeline, small_feed)


def test_a_running_job_takes_in_what_arrives(spark, tmp_path, small_feed):
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"))
    deliver(small_feed.filter("offset % 8 < 2"), source)
    queries = start(read_feed_files(spark, source, streaming=True), pipeline, every="1 second")
    try:
        for part in (None, "offset % 8 >= 2"):
            if part:
                deliver(small_feed.filter(part), source)
            for query in queries:
                query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert_tables(spark, pipeline, small_feed)


def test_event_tables_are_counted_once_as_they_are_written(spark, tmp_path):
    pipeline, sizes = Pipeline(str(tmp_path / "tables")), lambda: {r.name: r.n for r in event_counts(spark, pipeline).collect()}
    assert sizes() == {"raw_event_count": 0, "audit_count": 0, "reject_count": 0}
    feed = golden(Log(spark)).feed()
    for batch_id in (0, 0, 1):  # the first batch is run again
        write_events(pipeline, feed.where(f"(offset < 4) = ({batch_id} = 0)"), batch_id)
    assert sizes() == {
        "raw_event_count": read_output(spark, pipeline, RAW).count(),
        "audit_count": read_output(spark, pipeline, AUDIT).count(),
        "reject_count": read_output(spark, pipeline, REJECT).count(),
    }
    assert sizes()["raw_event_count"] == feed.count()


def test_a_batch_run_again_leaves_the_same_rows(spark, tmp_path):
    log, pipeline = golden(Log(spark)), Pipeline(str(tmp_path / "out"))
    for n, part in ((0, log.rows[:4]), (1, log.rows[4:]), (1, log.rows[4:])):
        write_events(pipeline, log.feed(part), n)
    for table in (RAW, AUDIT, REJECT):
        same_rows(read_output(spark, pipeline, table), batch_twins(log.feed())[table])


def test_bad_record_stops_the_keyed_tables_only(spark, tmp_path):
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"))
    log = golden(Log(spark)).add("hello")
    with pytest.raises(Exception, match="not a row change"):
        take_in(spark, source, pipeline, log.feed())
    assert [read_output(spark, pipeline, t).count() for t in (RAW, AUDIT, REJECT)] == [11, 9, 2]
    assert read_output(spark, pipeline, CURRENT).count() == 0
    # The operator lets the record pass: the same batch is run again and completes.
    lenient = Pipeline(pipeline.root, on_bad_record="skip")
    drain(read_feed_files(spark, source, streaming=True), lenient)
    assert read_output(spark, lenient, RAW).count() == 11
    assert read_output(spark, lenient, CURRENT).count() == 5


def test_tables_are_empty_before_the_first_batch(spark, tmp_path):
    pipeline = Pipeline(str(tmp_path / "out"))
    for table, expected in batch_twins(Log(spark).feed()).items():
        got = read_output(spark, pipeline, table)
        assert got.count() == 0 and got.columns == expected.columns
    assert keyed.read_latest_state(spark, ORDERS, str(tmp_path / "none")).count() == 0


def test_a_file_with_an_old_date_is_read(spark, tmp_path):
    source, pipeline, log = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), tables=(RAW,)), Log(spark)
    for n in range(2):
        log.add(envelope("c", None, order(n)))
        deliver(log.feed(log.rows[n:]), source)
        if n:
            for name in set(os.listdir(source)) - before:
                os.utime(f"{source}/{name}", (time.time() - 400 * 86400,) * 2)
        before = set(os.listdir(source))
        drain(read_feed_files(spark, source, streaming=True), pipeline)
    assert read_output(spark, pipeline, RAW).count() == 2


def test_a_new_checkpoint_reads_the_log_again_without_loss(spark, tmp_path, small_feed):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    lost = Pipeline(root)
    take_in(spark, source, lost, small_feed.filter("offset % 8 = 0"))
    first = rows(read_output(spark, lost, RAW, stamped=True), "event_id", "inserted_at")
    anew = Pipeline(root, checkpoint_name="_again")
    take_in(spark, source, anew, small_feed.filter("offset % 8 > 0"))
    assert_tables(spark, anew, small_feed)
    # What was in the table is not taken in a second time.
    assert set(first) <= set(rows(read_output(spark, anew, RAW, stamped=True), "event_id", "inserted_at"))


def test_load_stamp_is_kept_on_update_and_renewed_after_delete(spark, tmp_path):
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), tables=(CURRENT, VALID))
    good, bad = order(1), order(1, status="LOST")
    steps = [
        envelope("c", None, good), envelope("u", good, good), envelope("u", good, bad),
        envelope("u", bad, good), envelope("d", good, None), envelope("c", None, good),
    ]
    log, replicated, validated = Log(spark), [], []
    for n, step in enumerate(steps):
        log.add(step)
        take_in(spark, source, pipeline, log.feed(log.rows[n:]))
        for table, stamps in ((CURRENT, replicated), (VALID, validated)):
            row = read_output(spark, pipeline, table, stamped=True).first()
            stamps.append(row and row[-1])
    first, again = replicated[0], replicated[5]
    assert replicated == [first, first, first, first, None, again] and again > first
    renewed = validated[3]
    assert validated[:5] == [validated[0], validated[0], None, renewed, None]
    assert validated[0] < renewed < validated[5]


def test_source_order_in_the_pipeline(spark, tmp_path):
    log = Log(spark)
    log.add(envelope("c", None, order(1, city="old"), pos=10), partition=5, offset=3)
    log.add(envelope("u", order(1), order(1, city="new"), pos=20), partition=2, offset=0)
    pipeline = Pipeline(str(tmp_path / "out"), tables=(CURRENT,), order_by="source")
    for n in (1, 0):
        take_in(spark, str(tmp_path / "in"), pipeline, log.feed(log.rows[n : n + 1]))
    assert rows(read_output(spark, pipeline, CURRENT), "shipping_address") == [("new",)]


def test_latest_state_equals_batch_over_two_runs(spark, tmp_path, small_feed):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    for part in ("offset % 8 IN (0, 1)", "offset % 8 > 1"):
        deliver(small_feed.filter(part), source)
        decoded = decode_envelope(read_feed_files(spark, source, streaming=True), ORDERS)
        changes = typed_changes(decode_changelog(decoded, ORDERS), ORDERS)
        keyed.start_latest_state(changes, ORDERS, checkpoint, every=None).awaitTermination()
    same_rows(keyed.read_latest_state(spark, ORDERS, checkpoint), batch_twins(small_feed)[CURRENT])


def test_neighbouring_keys_share_their_state(spark, tmp_path):
    """One entry for a block of keys, whatever their values: none, a quote, microseconds."""
    log, keys = Log(spark), [0, 1, 5, 63, 64, -1]
    for key in keys:
        log.add(envelope("c", None, order(key, customer_id=None, city='a "b"\\ \u00e9', updated="2026-09-16T10:00:00.123456Z")))
    log.add(envelope("u", order(5), order(5, status=None, amount="-0.05"))).add(envelope("d", order(63), None))
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), tables=(CURRENT, VALID))
    for part in (log.rows[6:], log.rows[:3], log.rows[3:]):
        take_in(spark, source, pipeline, log.feed(part))
    twins = batch_twins(log.feed())
    for table in (CURRENT, VALID):
        same_rows(read_output(spark, pipeline, table), twins[table])
    state = spark.read.format("statestore").option("stateVarName", "newest").load(pipeline.checkpoint("keyed"))
    assert sorted(len(r.value["keys"]) for r in state.collect()) == [1, 1, 4]


def test_rows_of_a_block_are_kept_packed():
    rows = [[str(n), None if n % 3 else "x", "CREATED", f'{n}.00 "\u00e9"', "mysql-bin.000001"] for n in range(64)]
    block = keyed.packed(rows)
    assert [list(r) for r in zip(*keyed.unpacked(block))] == rows
    assert len(block) < len(json.dumps(rows)) / 4
    batch = pa.RecordBatch.from_arrays([pa.array([block] * 300)], ["rows"])
    got = list(keyed._rows_of(iter([batch]), list("abcde")))
    assert [b.num_rows for b in got] == [256 * 64, 44 * 64] and got[1].to_pylist()[1] == dict(zip("abcde", rows[1]))


def kept_files(spark, root):
    """Files of changes below a checkpoint, and shuffle files of the session."""
    shuffles = [f for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
                for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")]
    return [f for _, _, files in os.walk(root) for f in files if f.endswith(".changelog")], set(shuffles)


@pytest.mark.parametrize("stamps", [True, False])
def test_catching_up_leaves_no_logs_of_changes_and_no_shuffles(spark, tmp_path, small_feed, stamps):
    """A job that goes on by the clock takes over from there, and is taken over."""
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), tables=(CURRENT, VALID), stamps=stamps)
    before = kept_files(spark, pipeline.root)[1]
    for part in ("offset % 8 = 0", "offset % 8 = 1"):
        take_in(spark, source, pipeline, small_feed.filter(part))
    logs, shuffles = kept_files(spark, pipeline.root)
    assert not logs and not shuffles - before
    deliver(small_feed.filter("offset % 8 IN (2, 3)"), source)
    (query,) = start(read_feed_files(spark, source, streaming=True), pipeline, every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert kept_files(spark, pipeline.root)[0]
    take_in(spark, source, pipeline, small_feed.filter("offset % 8 > 3"))
    twins = batch_twins(small_feed)
    for table in (CURRENT, VALID):
        same_rows(read_output(spark, pipeline, table), twins[table])


def test_the_whole_job_leaves_no_shuffles_behind(spark, tmp_path, small_feed):
    """Nor logs of changes; a new checkpoint over the same tables neither."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    before = kept_files(spark, root)[1]
    for name, part in (("_checkpoint", "offset % 8 < 2"), ("_checkpoint", "offset % 8 > 1"), ("_anew", "offset < 80")):
        pipeline = Pipeline(root, stamps=False, checkpoint_name=name)
        take_in(spark, source, pipeline, small_feed.filter(part))
        logs, shuffles = kept_files(spark, root)
        assert not logs and not shuffles - before
    assert_tables(spark, pipeline, small_feed)


# Positions taken in


def test_records_without_a_position_stop_nothing(spark, tmp_path):
    """They have a place of their own; the offsets beside them stay whole numbers."""
    at = dt.datetime(9000, 1, 2, 3, 4, 5, 678901)
    records = [("t", 1, (1 << 53) + 1, at, None, "a"), ("t", None, 7, None, "k", None), ("t", 1, None, at, None, "b")]
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), tables=(RAW,))
    for part in (records, records[2:], records):
        deliver(spark.createDataFrame(part, FEED), source)
        got = taken.untaken(read_feed_files(spark, source, streaming=True)).writeStream.format("parquet")
        got.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(pipeline.root).awaitTermination()
    same_rows(spark.read.schema(FEED).parquet(pipeline.root), spark.createDataFrame(records, FEED))


def test_ranges_merge_and_answer():
    rng = random.Random(4)
    for _ in range(50):
        offsets = set(rng.sample(range(60), rng.randint(0, 60)))
        ranges = taken.merged((n, n) for n in offsets)
        assert [n for n in range(-2, 62) if taken.holds(ranges, n)] == sorted(offsets)
        assert all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
        more = taken.merged([*ranges, (10, 20)])
        assert [n for n in range(60) if taken.holds(more, n)] == sorted(offsets | set(range(10, 21)))


def test_a_block_with_many_gaps_is_kept_as_bits(spark, tmp_path):
    """It says the same, takes no more than a bit for each offset, and is ranges again once filled."""
    rng = random.Random(6)
    for block in (-1, 0, 3):
        for n in (0, 1, 100, 30_000, 65_536):
            offsets = sorted(rng.sample(range(block << 16, (block + 1) << 16), n))
            seen = np.zeros(1 << 16, bool)
            seen[np.array(offsets, int) - (block << 16)] = True
            ranges, bits = taken.kept_of(block, seen)
            plain = taken.merged((o, o) for o in offsets)
            assert (ranges, bits) == (plain, None) if len(plain) <= taken.MOST_RANGES else not ranges and len(bits) < 8300
            assert (taken.seen_of(block, ranges, bits) == seen).all()
    feed = spark.range(70_000).selectExpr("'t' topic", "0 partition", "id offset", "timestamp_millis(0) timestamp", "'k' key", "'v' value")
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    held = []
    for n, part in enumerate(("offset % 3 = 0", "offset % 3 < 2", "offset < 66000", "offset > 5")):
        pipeline = Pipeline(root, tables=(RAW,), checkpoint_name="_checkpoint" if n < 2 else "_anew")
        take_in(spark, source, pipeline, feed.where(part))
        state = spark.read.format("statestore").option("stateVarName", "taken").load(pipeline.checkpoint("events"))
        held.append(sorted((len(r.value.ranges), r.value.bits is None) for r in state.collect()))
    same_rows(read_output(spark, pipeline, RAW).select("kafka_offset"), feed.select(F.col("offset").alias("kafka_offset")))
    assert held == [[(0, False)] * 2] * 2 + [[(0, False), (1, True)], [(1, True)] * 2]


def test_known_positions_start_the_state_without_a_list_column(spark):
    """Arrow goes over a batch's nulls of a list column once more for each record beside it."""

    class Held:
        value = None

        def getValueState(self, name, schema):
            return self

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    job, held = taken.Taken(), Held()
    job.init(held)
    many = spark.range(600).selectExpr("'t' topic", "0 partition", "2 * id offset").where("offset < 1000")
    for positions, bits in ((many.where("offset < 4"), False), (many, True)):
        known = taken.ranges_of(positions).withColumn("ranges", F.to_json("ranges")).toPandas()
        job.handleInitialState(("t", 0, 0), known, None)
        assert bool(held.value[1]) == bits
        frame = pd.DataFrame([("t", 0, n, "0", "k", "v") for n in (1, 2, 1, 1000, 0)], columns=FEED.names)
        (got,) = job.handleInputRows(("t", 0, 0), iter([frame]), None)
        assert got["offset"].tolist() == [1, 1000]
        assert taken.seen_of(0, *held.value).sum() == positions.count() + 2


def test_ranges_of_a_table_equal_plain_ones(spark):
    rng = random.Random(3)
    positions = [("t", p, n + 65500 * (n % 2)) for p in range(3) for n in rng.sample(range(300), 200)]
    frame = spark.createDataFrame(positions + positions[:50], "topic string, partition int, offset long")
    got = {(r.partition, r.block): [tuple(x) for x in r.ranges] for r in taken.ranges_of(frame).collect()}
    want = {}
    for _, p, n in set(positions):
        want.setdefault((p, n >> 16), []).append((n, n))
    assert got == {k: taken.merged(v) for k, v in want.items()}


def test_a_dense_log_leaves_one_range_for_each_block(spark, tmp_path):
    feed = spark.range(40).selectExpr(
        "'t' topic", "CAST(id % 2 AS INT) partition", "id div 2 offset", "timestamp_millis(0) timestamp", "'k' key", "'v' value"
    )
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"), tables=(RAW,))
    for part in ("offset % 3 = 0", "offset < 15", "offset % 3 > 0 OR offset = 3"):
        deliver(feed.where(part), source)
        start_events(read_feed_files(spark, source, streaming=True), pipeline, every=None).awaitTermination()
    assert read_output(spark, pipeline, RAW).count() == 40
    state = spark.read.format("statestore").option("stateVarName", "taken").load(pipeline.checkpoint("events")).collect()
    assert sorted((r.key.partition, [tuple(x) for x in r.value.ranges]) for r in state) == [(p, [(0, 19)]) for p in (0, 1)]


def test_raw_is_audit_plus_tombstones_plus_undecodable(spark, tmp_path):
    log = golden(Log(spark)).add("hello").add("[]")
    pipeline = Pipeline(str(tmp_path / "out"), tables=(RAW, AUDIT, REJECT))
    take_in(spark, str(tmp_path / "in"), pipeline, log.feed())
    raw, audit = read_output(spark, pipeline, RAW), read_output(spark, pipeline, AUDIT)
    assert raw.count() == audit.count() + raw.filter("is_tombstone").count() + 2
    failed = audit.filter("validation_status = 'FAIL'")
    assert rows(failed, "event_id") == rows(read_output(spark, pipeline, REJECT), "event_id")


def test_all_tables_are_the_five():
    assert len(ALL_TABLES) == 5


def test_log_and_jdbc_options():
    assert log_options("broker:9092", ["a"], 2_000_000)["maxOffsetsPerTrigger"] == "2000000"
    options = log_options("broker:9092", ["a", "b"], maxOffsetsPerTrigger="10")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "a,b"
    assert options["kafka.isolation.level"] == "read_committed" and options["maxOffsetsPerTrigger"] == "10"
    jdbc = jdbc_options(ORDERS, "jdbc:x", "orders", 1, 100, 8)
    assert jdbc["partitionColumn"] == "order_id" and "shipping_address" in jdbc["dbtable"]


def test_merge_statements_keep_the_load_stamp():
    delete, upsert = merge_statements(ORDERS, "orders_current", "stage")
    assert "ON CONFLICT (order_id) DO UPDATE SET customer_id = EXCLUDED.customer_id" in upsert
    assert "replicated_at" not in upsert and "row_kind = 'DELETE'" in delete
