"""Every operator as a query over the test tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.values import wall_clock
from rowtide.operators.apply import apply_feed, keyed_upsert
from rowtide.operators.capture import TOPIC_PARTITIONS, diff_feed, log_position, next_offset, snapshot_feed
from rowtide.operators.chunks import chunked_changes, read_chunks
from rowtide.operators.digest import classify_by_digest, reconcile_by_digest
from rowtide.operators.decode import (
    decode_changelog,
    decode_envelope,
    decode_structured,
    read_text,
)
from rowtide.operators.drift import unknown_fields
from rowtide.operators.keysets import extra_by_bitmap, missing_by_bitmap
from rowtide.operators.latest import current, valid_current
from rowtide.operators.reconcile import (
    classify,
    event_metrics,
    extra_keys,
    mismatched_rows,
    missing_keys,
    read_findings,
    run_until_converged,
    store_findings,
    summarise,
    table_metrics,
)
from rowtide.operators.transactions import missing_transactions, transaction_set
from rowtide.operators.views import (
    enriched_events,
    event_audit,
    raw_events,
    rejects,
    source_metadata,
    typed_changes,
    unique_positions,
)
from rowtide.plans.inputs import (
    DELIVERIES,
    both_signs,
    customers,
    final_orders,
    first_orders,
    log_files,
    moved_log,
    odd_log,
    order_log,
    rolled_log,
)
from rowtide.schemas import CUSTOMERS, INSTANT, ORDERS, RECONCILIATION, SOURCE_FIELDS
from rowtide.session import new_run_dir, written
from rowtide.sources.feed import read_feed_files
from rowtide.sources.tables import key_cuts
from rowtide.streaming import keyed
from rowtide.streaming import pipeline as job

Query = Callable[[SparkSession, str], DataFrame]

# Times of the derived feeds, in milliseconds since the epoch.
SNAPSHOT_MS = 1_790_000_000_000
DIFF_MS = 1_790_000_060_000
UPSERT_TIME = "2026-10-01 12:00:00"


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_envelope(order_log(spark, sf_dir), ORDERS)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_events(_decoded(spark, sf_dir), ORDERS)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_changes(decode_changelog(_decoded(spark, sf_dir), ORDERS), ORDERS)


# Event tables


def cdc_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(read_text(order_log(spark, sf_dir)))


def raw_events_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that hands out every seventh offset twice still gives one row per position."""
    times = F.when(F.col("offset") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    repeated = order_log(spark, sf_dir).select("*", F.explode(times).alias("_time")).drop("_time")
    return unique_positions(raw_events(read_text(repeated)))


def cdc_event_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_audit(_enriched(spark, sf_dir))


def cdc_event_audit_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a feed with missing keys, unknown operations and unknown fields."""
    return event_audit(enriched_events(decode_envelope(odd_log(spark, sf_dir), ORDERS), ORDERS))


def orders_current_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica when the job passes over the records that are no row changes."""
    decoded = decode_envelope(odd_log(spark, sf_dir), ORDERS)
    changelog = decode_changelog(decoded, ORDERS, on_bad_record="skip")
    return current(typed_changes(changelog, ORDERS), ORDERS)


def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(_enriched(spark, sf_dir))


def orders_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tolerant reading with its nested fields laid out flat."""
    structured = decode_structured(_decoded(spark, sf_dir), ORDERS)
    return structured.select(
        "topic_name",
        "kafka_partition",
        "kafka_offset",
        "op",
        "ts_ms",
        *[F.col(f"{i}.{c}").alias(f"{i}_{c}") for i in ("before", "after") for c in ORDERS.columns],
    )


# The strict branch


def orders_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    changelog = decode_changelog(_decoded(spark, sf_dir), ORDERS)
    return changelog.selectExpr(
        "row_kind",
        *[
            f"{wall_clock(name)} AS {name}" if kind == INSTANT else name
            for name, kind in ORDERS.columns.items()
        ],
        "topic_name",
        "kafka_partition",
        "kafka_offset",
    )


def source_metadata_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage of each change, the source block's map spread over columns."""
    meta = source_metadata(decode_changelog(_decoded(spark, sf_dir), ORDERS), ORDERS)
    properties = F.col("source_properties")
    return meta.select(
        *[c for c in meta.columns if c != "source_properties"],
        *[properties.getItem(name).alias(f"source_{name}") for name in SOURCE_FIELDS
          if name not in ("db", "table")],
    )


def orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir)


def orders_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(_typed(spark, sf_dir), ORDERS)


def orders_current_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica when the database's own log decides which change is newer, as it must
    where a topic was repartitioned and offsets no longer tell."""
    decoded = decode_envelope(moved_log(spark, sf_dir), ORDERS)
    return current(typed_changes(decode_changelog(decoded, ORDERS), ORDERS), ORDERS, order_by="source")


def orders_current_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the database's own log across the roll-over of its file numbers."""
    decoded = decode_envelope(rolled_log(spark, sf_dir), ORDERS)
    return current(typed_changes(decode_changelog(decoded, ORDERS), ORDERS), ORDERS, order_by="source")


def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that the feed has and the tables do not."""
    return unknown_fields(odd_log(spark, sf_dir), ORDERS)


def gtid_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that the feed's events come from, as ranges."""
    return transaction_set(_enriched(spark, sf_dir))


def gtid_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions up to the last one of each server that no event of the feed comes from,
    as one asks after a fail-over."""
    present = transaction_set(_enriched(spark, sf_dir))
    executed = present.groupBy("server").agg(F.lit(1).cast("long").alias("first"), F.max("last").alias("last"))
    return missing_transactions(executed, present)


def orders_valid_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_current(_typed(spark, sf_dir), ORDERS)


def customers_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second captured table through the same steps, by its description alone."""
    feed = snapshot_feed(customers(spark, sf_dir), CUSTOMERS, SNAPSHOT_MS)
    changelog = decode_changelog(decode_envelope(feed, CUSTOMERS), CUSTOMERS)
    return current(typed_changes(changelog, CUSTOMERS), CUSTOMERS)


# Reconciliation, against a replica with planted faults


def _faulty_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    key = F.col("order_id")
    source = final_orders(spark, sf_dir).filter(key % 19 != 0)
    target = orders_current(spark, sf_dir).filter(key % 17 != 0)
    status = F.when(key % 23 == 0, "CANCELLED").otherwise(F.col("status"))
    return source, target.withColumn("status", status)


def reconcile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_keys(*_faulty_sides(spark, sf_dir), ORDERS)


def reconcile_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extra_keys(*_faulty_sides(spark, sf_dir), ORDERS)


def reconcile_missing_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_by_bitmap(*_faulty_sides(spark, sf_dir), ORDERS)


def reconcile_extra_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extra_by_bitmap(*_faulty_sides(spark, sf_dir), ORDERS)


def reconcile_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mismatched_rows(*_faulty_sides(spark, sf_dir), ORDERS)


def reconcile_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(*_faulty_sides(spark, sf_dir), ORDERS)


def reconcile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcomes found by descending a digest tree; equal parts are not joined."""
    return classify_by_digest(*_faulty_sides(spark, sf_dir), ORDERS)


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table_metrics({"valid_target_count": orders_valid_current(spark, sf_dir)})
    events = event_metrics(_enriched(spark, sf_dir), cdc_raw_events(spark, sf_dir))
    return stored.unionByName(events)


def reconcile_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir)


def reconcile_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings as a run stores them, not only the ids its report shows."""
    path = new_run_dir(spark, "findings")
    store_findings(classify(*_faulty_sides(spark, sf_dir), ORDERS), path)
    return read_findings(spark, path, ORDERS)


def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = classify(*_faulty_sides(spark, sf_dir), ORDERS)
    return summarise(outcomes, _metrics(spark, sf_dir), ORDERS)


# Tables to feeds and back


def _old_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version of the table, some orders not placed yet."""
    return first_orders(spark, sf_dir).filter(F.col("order_id") % 13 != 1)


def snapshot_feed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wall_clock_feed(snapshot_feed(final_orders(spark, sf_dir), ORDERS, SNAPSHOT_MS))


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wall_clock_feed(_diff(spark, sf_dir))


def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff_feed(_old_orders(spark, sf_dir), final_orders(spark, sf_dir), ORDERS, DIFF_MS)


def apply_feed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old table plus the difference is the new table."""
    return apply_feed(_old_orders(spark, sf_dir), _diff(spark, sf_dir), ORDERS)


def bootstrap_then_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica that starts from a snapshot and then follows the changes; some keys are negative."""
    old, new = both_signs(_old_orders(spark, sf_dir)), both_signs(final_orders(spark, sf_dir))
    start = snapshot_feed(old, ORDERS, SNAPSHOT_MS)
    follow = diff_feed(old, new, ORDERS, DIFF_MS, next_offset(start))
    decoded = decode_envelope(start.unionByName(follow), ORDERS)
    return current(typed_changes(decode_changelog(decoded, ORDERS), ORDERS), ORDERS)


# Ranges that the chunked copy is made in.
CHUNKS = 6


def bootstrap_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica copied range by range while the log goes on; every row is read at a moment of its own.

    The log's ends move on with each mark. Between the marks of a range a row is as old or as new
    as a hash of its key says, so ranges are torn wherever the log changes them meanwhile.
    """
    old, new = (
        written(both_signs(table), "version") for table in (_old_orders(spark, sf_dir), final_orders(spark, sf_dir))
    )
    log = written(diff_feed(old, new, ORDERS, DIFF_MS), "log")
    last = {r["partition"]: r["n"] for r in log.groupBy("partition").agg((F.max("offset") + 1).alias("n")).collect()}
    key = F.col(ORDERS.key)
    partition, offset = log_position(key, TOPIC_PARTITIONS, per_key=2)
    end = F.element_at(F.create_map(*[F.lit(x) for pair in last.items() for x in pair]), partition)
    times, taken = 2 * CHUNKS + 1, 0

    def ends() -> dict[int, int]:
        nonlocal taken
        taken += 1
        return {p: n * taken // times for p, n in last.items()}

    def read(condition: str) -> DataFrame:
        moment = F.floor(end * (taken + F.pmod(F.xxhash64(key), F.lit(1000)) / 1000) / times)
        changed = F.coalesce(offset < moment, F.lit(False))
        return old.where(condition).where(~changed).unionByName(new.where(condition).where(changed))

    path = new_run_dir(spark, "chunks")
    read_chunks(spark, ORDERS, key_cuts(old, ORDERS.key, CHUNKS), read, ends, path)
    changes = typed_changes(decode_changelog(decode_envelope(log, ORDERS), ORDERS), ORDERS)
    return current(chunked_changes(spark, ORDERS, path, changes), ORDERS).select(list(ORDERS.columns))


def keyed_upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eighth customer re-sent under a new key, others updated, some of them in vain;
    half of the keys come twice, first with an outdated row."""
    table = customers(spark, sf_dir)
    key = F.col("customer_id")
    email = F.when(key % 16 == 12, F.col("email")).otherwise(F.concat(F.lit("new-"), F.col("email")))
    batch = table.filter(key % 4 == 0).select(
        F.when(key % 8 == 0, -key - 1).otherwise(key).alias("customer_id"),
        "full_name",
        email.alias("email"),
        "country_code",
        F.lit(1).alias("sent"),
    )
    outdated = batch.where("customer_id % 8 IN (4, -1)").withColumn("email", F.lit("outdated"))
    batch = batch.unionByName(outdated.withColumn("sent", F.lit(0)))
    now = F.to_timestamp_ntz(F.lit(UPSERT_TIME))
    return keyed_upsert(
        table,
        batch,
        "customer_id",
        update=["full_name", "email", "country_code"],
        touch={"updated_at": now},
        defaults={"created_at": now, "updated_at": now},
        order_by="sent",
    )


def _wall_clock_feed(feed: DataFrame) -> DataFrame:
    return feed.withColumn("timestamp", F.expr(wall_clock("timestamp")))


# Streaming: the same tables, maintained by the continuous job

def _stream(spark: SparkSession, sf_dir: str, through: int = DELIVERIES - 1) -> DataFrame:
    """The log as a stream over the deliveries made so far."""
    arrived = ",".join(map(str, range(through + 1)))
    return read_feed_files(spark, f"{log_files(spark, sf_dir)}/delivery={{{arrived}}}", streaming=True)


def _run(spark: SparkSession, sf_dir: str, *tables: str, stamps: bool = False) -> job.Pipeline:
    """The job after each delivery took in what was new, stopping in between."""
    pipeline = job.Pipeline(new_run_dir(spark, "tables"), tables=tables, stamps=stamps)
    for through in range(DELIVERIES):
        job.drain(_stream(spark, sf_dir, through), pipeline)
    return pipeline


def _stream_query(table: str) -> Query:
    """The valid table is kept with stamps, by the processor that tells what leaves it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return job.read_output(spark, _run(spark, sf_dir, table, stamps=table == job.VALID), table)

    return query


def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica as an aggregation, read from its state store after four deliveries."""
    checkpoint = new_run_dir(spark, "state")
    for through in range(DELIVERIES):
        decoded = decode_envelope(_stream(spark, sf_dir, through), ORDERS)
        changes = typed_changes(decode_changelog(decoded, ORDERS), ORDERS)
        keyed.start_latest_state(changes, ORDERS, checkpoint, every=None).awaitTermination()
    return keyed.read_latest_state(spark, ORDERS, checkpoint)


def _lost_halfway(spark: SparkSession, sf_dir: str, table: str) -> job.Pipeline:
    """A job that lost its checkpoint after two deliveries and read the whole log again."""
    root = new_run_dir(spark, "tables")
    lost = job.Pipeline(root, tables=(table,), stamps=False)
    for through in range(2):
        job.drain(_stream(spark, sf_dir, through), lost)
    anew = job.Pipeline(root, tables=(table,), stamps=False, checkpoint_name="_checkpoint_2")
    job.drain(_stream(spark, sf_dir), anew)
    return anew


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.read_output(spark, _lost_halfway(spark, sf_dir, job.CURRENT), job.CURRENT)


def stream_raw_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table when half of the log, with gaps, is handed out twice: positions that are
    in the table's ranges are passed over."""
    return job.read_output(spark, _lost_halfway(spark, sf_dir, job.RAW), job.RAW)


def stream_valid_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid table rebuilt from the changes that the job emits for it."""
    pipeline = _run(spark, sf_dir, job.VALID, stamps=True)
    return current(job.read_valid_changes(spark, pipeline), ORDERS)


def stream_five_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tables from one job: their sizes, and a digest of their event ids or rows."""
    pipeline = _run(spark, sf_dir, *job.ALL_TABLES)
    result = None
    for table in job.ALL_TABLES:
        rows = job.read_output(spark, pipeline, table)
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in DIGESTED[table]]
        part = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("bigint")
        digest = F.coalesce(F.sum(part), F.lit(0)).alias("digest")
        line = rows.agg(F.count("*").alias("n"), digest).select(F.lit(table).alias("name"), "n", "digest")
        result = line if result is None else result.unionByName(line)
    return result


# What the digest of each table covers: everything but times, whose texts engines spell apart.
DIGESTED = {
    job.RAW: ["event_id", "kafka_partition", "kafka_offset", "payload", "is_tombstone"],
    job.AUDIT: ["event_id", "operation", "order_id", "source_position", "validation_reason", "before_state", "after_state"],
    job.REJECT: ["event_id", "order_id", "reason", "amount_raw", "status_raw", "currency_raw"],
    **{
        table: ["order_id", "customer_id", "status", "amount", "currency", "shipping_address", "kafka_offset"]
        for table in (job.CURRENT, job.VALID)
    },
}


def reconcile_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain the feed, then check source against replica until they agree; the logged run."""
    pipeline = _run(spark, sf_dir, *job.ALL_TABLES)
    def check() -> DataFrame:
        # The event tables were counted by the job as it wrote them and are not read.
        counted = job.event_counts(spark, pipeline)
        valid = {"valid_target_count": job.read_output(spark, pipeline, job.VALID)}
        replica = job.read_output(spark, pipeline, job.CURRENT)
        return reconcile_by_digest(final_orders(spark, sf_dir), replica, ORDERS, valid, counted=counted)

    log = pipeline.dir("pipeline_reconciliation")
    run_until_converged(check, log)
    return spark.read.schema(RECONCILIATION).parquet(log).drop("check_id", "checked_at")


QUERIES: dict[str, Query] = {
    "cdc_raw_events": cdc_raw_events,
    "raw_events_reread": raw_events_reread,
    "cdc_event_audit": cdc_event_audit,
    "cdc_event_audit_odd": cdc_event_audit_odd,
    "cdc_rejects": cdc_rejects,
    "orders_structured": orders_structured,
    "orders_changelog": orders_changelog,
    "source_metadata": source_metadata_flat,
    "orders_typed": orders_typed,
    "orders_current": orders_current,
    "orders_current_by_source": orders_current_by_source,
    "orders_current_odd": orders_current_odd,
    "orders_current_rolled": orders_current_rolled,
    "drift_report": drift_report,
    "gtid_ranges": gtid_ranges,
    "gtid_missing": gtid_missing,
    "orders_valid_current": orders_valid_current,
    "customers_current": customers_current,
    "reconcile_missing": reconcile_missing,
    "reconcile_extra": reconcile_extra,
    "reconcile_missing_bitmap": reconcile_missing_bitmap,
    "reconcile_extra_bitmap": reconcile_extra_bitmap,
    "reconcile_mismatch": reconcile_mismatch,
    "reconcile_outcomes": reconcile_outcomes,
    "reconcile_by_digest": reconcile_digest,
    "reconcile_metrics": reconcile_metrics,
    "reconcile_findings": reconcile_findings,
    "reconcile_summary": reconcile_summary,
    "reconcile_converged": reconcile_converged,
    "snapshot_feed": snapshot_feed_orders,
    "snapshot_diff": snapshot_diff,
    "apply_feed": apply_feed_orders,
    "bootstrap_then_follow": bootstrap_then_follow,
    "bootstrap_in_chunks": bootstrap_in_chunks,
    "keyed_upsert": keyed_upsert_customers,
    "stream_raw": _stream_query(job.RAW),
    "stream_audit": _stream_query(job.AUDIT),
    "stream_rejects": _stream_query(job.REJECT),
    "stream_orders_current": _stream_query(job.CURRENT),
    "stream_orders_valid_current": _stream_query(job.VALID),
    "stream_latest_state": stream_latest_state,
    "stream_restart": stream_restart,
    "stream_raw_reread": stream_raw_reread,
    "stream_valid_changes": stream_valid_changes,
    "stream_five_tables": stream_five_tables,
}
