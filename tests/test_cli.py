"""The command line, end to end over files."""

import json

import pytest
from conftest import SMALL

from rowtide.cli import main
from rowtide.plans.inputs import final_orders, order_feed


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cli")
    order_feed(spark, SMALL).write.parquet(f"{root}/feed")
    final_orders(spark, SMALL).write.parquet(f"{root}/source")
    assert main(["run", "--feed", f"{root}/feed", "--root", f"{root}/tables", "--drain"]) == 0
    return root


def test_run_then_reconcile(place, capsys):
    assert main(["reconcile", "--source", f"{place}/source", "--root", f"{place}/tables"]) == 0
    report = json.loads(capsys.readouterr().out)
    assert (report["status"], report["source_count"], report["raw_event_count"]) == ("PASS", 1409, 2535)


def test_a_changed_source_is_reported_whole(spark, place, capsys):
    source = final_orders(spark, SMALL)
    fewer = f"{place}/fewer"
    source.where("order_id % 8 <> 0").write.parquet(fewer)
    check = ["reconcile", "--source", fewer, "--root", f"{place}/tables", "--sample-size", "7"]
    assert main([*check, "--timeout", "0", "--poll", "0"]) == 1
    report = json.loads(capsys.readouterr().err)
    extra = source.count() - spark.read.parquet(fewer).count()
    assert (report["extra_in_target"], report["missing_in_target"]) == (extra, 0) and extra > 100
    assert len(report["details"]["extra_ids"]) == 7
    assert spark.read.parquet(f"{place}/tables/pipeline_findings").count() == extra
    assert spark.read.parquet(f"{place}/tables/pipeline_reconciliation").count() == 2


def test_reconcile_waits_for_tables_that_are_not_there_yet(spark, place, tmp_path, capsys):
    check = ["reconcile", "--source", f"{place}/source", "--root", str(tmp_path / "new")]
    assert main([*check, "--timeout", "0", "--poll", "0"]) == 1
    report = json.loads(capsys.readouterr().err)
    assert (report["target_count"], report["raw_event_count"]) == (0, 0)
    assert report["missing_in_target"] == report["source_count"]


def test_a_feed_is_required():
    with pytest.raises(SystemExit):
        main(["run", "--root", "x"])
