"""Even key ranges for scans of another database."""

import pytest
from pyspark.sql import functions as F

from rowtide.plans.inputs import log_files, order_feed
from rowtide.sources.tables import key_cuts, key_predicates


@pytest.mark.parametrize(
    "keys",
    [
        "id",
        "IF(id < 9000, id, id * 1000000)",  # a wide gap
        "id * id - 30000000",  # both signs, ever sparser
        "IF(id % 3 = 0, 7, id)",  # a third of all rows has one key
    ],
)
def test_predicates_share_out_all_rows_evenly(spark, keys):
    table = spark.range(10_000).selectExpr(f"{keys} AS k").unionAll(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    predicates = key_predicates("k", key_cuts(table, "k", 8))
    parts = [table.where(p).count() for p in predicates]
    assert sum(parts) == 10_001
    met = " + ".join(f"IF(coalesce({p}, false), 1, 0)" for p in predicates)
    assert table.selectExpr(f"{met} AS n").where("n <> 1").count() == 0
    hot = 3_334 if "= 7" in keys or ", 7," in keys else 0
    assert max(parts) <= 1_250 * 1.2 + hot


def test_cuts_of_small_tables(spark):
    empty = spark.createDataFrame([], "k long")
    assert key_cuts(empty, "k", 8) == [] and key_predicates("k", []) == ["1 = 1"]
    assert key_cuts(spark.range(5).toDF("k"), "k", 1) == []
    assert key_predicates("k", key_cuts(spark.sql("SELECT 4L AS k"), "k", 4)) == ["k < 4 OR k IS NULL", "k >= 4"]


def test_no_task_writes_a_whole_partition_of_the_log(spark, tmp_path):
    """Of a log of 6 partitions no file has even a half of one, if files are to be small."""
    orders = spark.range(40_000).selectExpr(
        "id o_orderkey", "id o_custkey", "'O' o_orderstatus", "'1-URGENT' o_orderpriority",
        "1.5D o_totalprice", "TIMESTAMP'1995-01-02 00:00:00' o_orderdate",
    )
    orders.repartition(8).write.parquet(str(tmp_path / "orders.parquet"))
    small = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    kept = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        log = log_files(spark, str(tmp_path))
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    files = spark.read.parquet(log).groupBy("delivery", F.input_file_name()).count().collect()
    records = sum(r["count"] for r in files)
    assert records == order_feed(spark, str(tmp_path)).count()
    assert max(r["count"] for r in files) < records / 12
