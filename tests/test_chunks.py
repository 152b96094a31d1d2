"""A copy made range by range beside a running log, against the table as the log leaves it."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators import chunks
from rowtide.operators.latest import current
from rowtide.schemas import ORDERS
from rowtide.session import new_run_dir
from rowtide.sources.tables import key_predicates

PARTITIONS = 3
ROW = "order_id long, customer_id long, status string, amount decimal(12,2), currency string, " \
    "shipping_address string, created_at timestamp_ntz, updated_at timestamp_ntz"
CHANGE = f"row_kind string, {ROW}, source_event_ts timestamp_ntz, kafka_partition int, kafka_offset long, " \
    "source_ts_ms long, source_file string, source_position long, source_row int"


def row(key, version):
    return (key, version, "PAID", None, None, None, None, None)


class World:
    """A table of versions by key and its log; a key's events are in one partition."""

    def __init__(self, seed, keys):
        self.draw, self.keys = random.Random(seed), keys
        self.start = {k: 0 for k in keys if self.draw.random() < 0.7}
        self.table, self.log, self.ends = dict(self.start), [], {p: 0 for p in range(PARTITIONS)}

    def change(self, times):
        for _ in range(times):
            key = self.draw.choice(self.keys)
            kind = "INSERT" if key not in self.table else self.draw.choice(["UPDATE", "DELETE"])
            version = len(self.log) + 1
            p = key % PARTITIONS
            self.log.append((kind, *row(key, version), None, p, self.ends[p], None, None, None, None))
            self.ends[p] += 1
            if kind == "DELETE":
                del self.table[key]
            else:
                self.table[key] = version

    def at(self, through):
        """The table when the log was applied up to these offsets."""
        table = dict(self.start)
        for event in self.log:
            kind, key, version, p, offset = event[0], event[1], event[2], event[10], event[11]
            if offset < through.get(p, 0):
                table.pop(key, None)
                if kind != "DELETE":
                    table[key] = version
        return table


@pytest.mark.parametrize("seed", range(2))
def test_torn_ranges_and_the_log_give_the_table(spark, seed):
    world = World(seed, [*range(-20, 60), 10**12, -(10**12)])
    cuts = [-5, 0, 7, 33]
    path = new_run_dir(spark, "chunks")
    marks = {}

    def ends():
        world.change(7)
        marks.setdefault(len(marks), dict(world.ends))
        return dict(world.ends)

    def read(condition):
        # Half of the rows are seen before further changes, the others after them.
        spread = spark.createDataFrame([row(k, v) for k, v in world.table.items() if k % 2], ROW).where(condition).collect()
        world.change(40)
        later = spark.createDataFrame([row(k, v) for k, v in world.table.items() if k % 2 == 0], ROW).where(condition)
        return later.union(spark.createDataFrame(spread, ROW))

    assert chunks.read_chunks(spark, ORDERS, cuts, read, ends, path) == len(cuts) + 1
    assert chunks.read_chunks(spark, ORDERS, [99], read, ends, path) == 0  # all of it is there
    world.change(30)
    changes = spark.createDataFrame(world.log, CHANGE)

    def copied(through=None):
        found = current(chunks.chunked_changes(spark, ORDERS, path, changes, through), ORDERS)
        got = [(r.order_id, r.customer_id) for r in found.collect()]
        assert len(got) == len(set(got))
        return dict(got)

    assert copied() == world.table == copied(world.ends)
    # Up to the high mark of a range: that range and those before are the table at this position.
    for number in range(len(cuts) + 1):
        through = marks[2 * number + 1]
        expected = {k: v for k, v in world.at(through).items() if bisect.bisect_right(cuts, k) <= number}
        assert copied(through) == expected
    assert copied({}) == {}


def test_a_run_that_was_broken_off_goes_on(spark):
    path, seen = new_run_dir(spark, "chunks"), []

    def read(condition):
        seen.append(condition)
        if len(seen) == 2:
            raise RuntimeError("connection lost")
        return spark.createDataFrame([row(k, 0) for k in range(10)], ROW).where(condition)

    with pytest.raises(RuntimeError):
        chunks.read_chunks(spark, ORDERS, [3, 6], read, dict, path)
    assert chunks.read_chunks(spark, ORDERS, [5], read, dict, path) == 2
    assert seen == [*key_predicates("order_id", [3, 6])[:2], *key_predicates("order_id", [3, 6])[1:]]
    none = spark.createDataFrame([], CHANGE)
    copied = current(chunks.chunked_changes(spark, ORDERS, path, none), ORDERS)
    assert sorted(r.order_id for r in copied.collect()) == list(range(10))


def test_empty_table_without_cuts(spark):
    path = new_run_dir(spark, "chunks")
    empty = spark.createDataFrame([], ROW)
    assert chunks.read_chunks(spark, ORDERS, [], lambda c: empty.where(c), dict, path) == 1
    assert chunks.read_chunks(spark, ORDERS, [], lambda c: empty.where(c), dict, path) == 0
    event = ("INSERT", *row(4, 1), None, 0, 0, None, None, None, None)
    changes = spark.createDataFrame([event], CHANGE)
    assert [r.order_id for r in current(chunks.chunked_changes(spark, ORDERS, path, changes), ORDERS).collect()] == [4]


def test_range_of_a_key(spark):
    draw = random.Random(3)
    keys = [draw.randrange(-200, 200) for _ in range(300)] + [None, 2**63 - 1, -(2**63)]
    table = spark.createDataFrame([(k,) for k in keys], "k long")
    for size in (0, 1, 2, 8, 31):
        cuts = sorted(draw.sample(range(-150, 150), size))
        found = table.select("k", chunks.chunk_of(table["k"], cuts).alias("c")).collect()
        assert all(r.c == (0 if r.k is None else bisect.bisect_right(cuts, r.k)) for r in found)
        met = [F.when(F.expr(condition), n) for n, condition in enumerate(key_predicates("k", cuts))]
        numbers = table.select("k", F.array_compact(F.array(*met)).alias("n")).collect()
        assert [(r.k, [r.c]) for r in found] == [(r.k, r.n) for r in numbers]
