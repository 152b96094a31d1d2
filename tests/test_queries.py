"""Every registered query against its SQL twin, and what the plans may not contain."""

import decimal
import os
import pathlib
import subprocess
import sys

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from __spark_entry__ import entry
from rowtide.plans.oracle import ORACLES
from rowtide.plans.queries import QUERIES
from rowtide.operators.decode import decode_changelog, decode_envelope
from rowtide.operators.latest import current
from rowtide.operators.views import typed_changes
from rowtide.plans.inputs import log_files, moved_log
from rowtide.schemas import ORDERS
from rowtide.session import new_run_dir, shared_dir

ROOT = pathlib.Path(__file__).parent.parent
BATCH = [name for name in QUERIES if not name.startswith("stream_") and name != "reconcile_converged"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in pathlib.Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return str(value) if isinstance(value, decimal.Decimal) else value


def normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    got = QUERIES[name](spark, SMALL)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    assert normal(got.columns, got.collect()) == normal(columns, cursor.fetchall())


@pytest.mark.parametrize("name", BATCH)
def test_plans_stay_in_the_engine(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Cartesian", "NestedLoop", "Scan ExistingRDD"):
        assert unwanted not in plan


def test_event_tables_need_no_shuffle(spark):
    for name in ("cdc_raw_events", "cdc_event_audit", "cdc_rejects", "orders_typed", "snapshot_feed"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan


def test_entry(spark):
    assert entry(spark).count() == 2398


def test_most_keys_with_several_records_span_deliveries(spark):
    log = spark.read.parquet(log_files(spark, SMALL))
    keys = log.groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("delivery").alias("d")).where("n > 1")
    several, spread = keys.agg(F.count("*"), F.count_if(F.col("d") > 1)).first()
    assert several > 500 and spread > 0.9 * several
    # Some orders are placed last, after their own changes.
    placed = log.where("offset % 8 = 0 AND delivery = 3").select("key")
    assert log.join(placed, "key").where("delivery < 3").count() > 20


def test_source_order_decides_where_a_topic_was_repartitioned(spark):
    by_source = QUERIES["orders_current_by_source"](spark, SMALL).select("order_id", "status")
    assert by_source.subtract(QUERIES["orders_current"](spark, SMALL).select("order_id", "status")).count() == 0
    typed = typed_changes(decode_changelog(decode_envelope(moved_log(spark, SMALL), ORDERS), ORDERS), ORDERS)
    assert current(typed, ORDERS).select("order_id", "status").subtract(by_source).count() > 10


def test_report_reads_the_feed_once_a_side(spark):
    plan = QUERIES["reconcile_outcomes"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 1 and plan.count("from_json") <= 2


def test_shared_dir_follows_the_session(spark):
    own = shared_dir(spark)
    assert shared_dir(spark) == own and new_run_dir(spark, "x") != new_run_dir(spark, "x")


def test_work_folders_go_with_the_driver(tmp_path):
    code = f"""
from rowtide.session import local_session, written
spark = local_session(1, 1)
print(written(spark.range(5), "kept").count(), len(list(__import__("pathlib").Path("{tmp_path}/shared/rowtide").iterdir())))
"""
    named = {"PYSPARK_SUBMIT_ARGS": f"--conf spark.checkpoint.dir={tmp_path}/shared pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, env=os.environ | named)
    assert done.stdout.split()[-2:] == ["5", "1"], done.stderr[-2000:]
    assert not list((tmp_path / "shared" / "rowtide").iterdir())


def test_shared_dir_named_by_the_cluster():
    class Conf(dict):
        get = dict.get

    class Context:
        master = "spark://host:7077"
        applicationId = "app"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf({"spark.checkpoint.dir": "hdfs:///shared/"})
        sparkContext = Context()

    assert shared_dir(Session()) == "hdfs:///shared"
    Session.conf = Conf()
    with pytest.raises(ValueError):
        shared_dir(Session())
