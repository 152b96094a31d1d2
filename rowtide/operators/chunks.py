"""A first copy of a table, read one key range after another while its log goes on.

Each range is read between two marks, the ends of the log's partitions before (low) and after
(high) the read. The database needs no snapshot and no lock: rows of a range may be of any moments
between its marks, each of its own. Rows that the log touched from the low mark on are replaced
by what the log says; earlier events of the range were in the table when it was read, and are
passed over. So the copy is right as soon as the log has been read up to the high mark. Where the
log lags behind the database, a mark should be taken only when it has caught up; else the copy is
ahead of the high mark by that lag, and right once the log has been read past it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.schemas import SPARK_TYPE, TableSpec
from rowtide.sources.tables import key_predicates

MARKS = T.StructType(
    [
        T.StructField("chunk", T.IntegerType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
    ]
)
CUTS = T.StructType([T.StructField("cut", T.LongType())])
# Stands for the log in the marks of a range that was read while the log had no partitions.
NO_PARTITION = -1


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What is stored at a path; empty before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _cuts(spark: SparkSession, path: str) -> list[int]:
    return sorted(r["cut"] for r in _stored(spark, f"{path}/cuts", CUTS).where("cut IS NOT NULL").collect())


def read_chunks(
    spark: SparkSession,
    spec: TableSpec,
    cuts: Sequence[int],
    read: Callable[[str], DataFrame],
    ends: Callable[[], Mapping[int, int]],
    path: str,
) -> int:
    """Store a table's ranges below `path`, each with its marks; the number of ranges read now.

    `cuts` are ascending keys (`key_cuts` gives even ones), `read` gives the rows that meet a SQL
    condition on the key, `ends` the next offset of each log partition at this moment. A range
    counts as read when its marks are stored, after its rows: a run that was broken off is called
    again with the same path and goes on, with the cuts it began with. Ranges follow one another,
    each is read by as many tasks as `read` has partitions.
    """
    if _stored(spark, f"{path}/cuts", CUTS).isEmpty():
        # A row without a cut, so that no cuts are told from none stored.
        kept = spark.createDataFrame([(None,), *[(c,) for c in sorted(set(cuts))]], CUTS)
        kept.coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")
    conditions = key_predicates(spec.key, _cuts(spark, path))
    done = {r["chunk"] for r in _stored(spark, f"{path}/marks", MARKS).select("chunk").distinct().collect()}
    for chunk in sorted(set(range(len(conditions))) - done):
        low = dict(ends())
        rows = read(conditions[chunk]).select(list(spec.columns))
        rows.write.mode("overwrite").parquet(f"{path}/rows/chunk={chunk}")
        high = dict(ends()) or {NO_PARTITION: 0}
        marks = [(p, low.get(p, 0), to) for p, to in high.items()]
        stored = spark.createDataFrame(marks, T.StructType(MARKS.fields[1:]))
        stored.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/chunk={chunk}")
    return len(conditions) - len(done)


def chunk_of(key: Column, cuts: Sequence[int]) -> Column:
    """The number of the range a key lies in: a binary search in the cuts, which the plan holds.

    A null key lies in the first range, as in `key_predicates`.
    """
    if not cuts:
        return F.lit(0)
    bounds, n = F.lit(np.array(cuts, np.int64)), len(cuts)
    steps = F.lit(np.array([1 << i for i in reversed(range(n.bit_length()))], np.int32))

    def go(at: Column, step: Column) -> Column:
        to = at + step
        return F.when((to <= n) & (F.get(bounds, to - 1) <= key), to).otherwise(at)

    return F.aggregate(steps, F.lit(0), go)


def chunked_changes(
    spark: SparkSession, spec: TableSpec, path: str, changes: DataFrame, through: Mapping[int, int] | None = None
) -> DataFrame:
    """The stored ranges and the log as one set of changes, of which `current` makes the replica.

    `changes` are typed changes of the log, at least from the lowest low mark on. Rows as read come
    as inserts without a log position, older than any event. `through` gives the next offset of
    each partition the log was read to: what lies behind is left out, and so are ranges whose
    high mark the log has not reached; the others are the table at exactly that position. Without
    it the log must reach past all marks.

    One shuffle-free pass over rows and events: marks (a row per range and partition) are joined,
    which Spark does by broadcast while they stay below its own threshold.
    """
    marks = _stored(spark, f"{path}/marks", MARKS)
    kinds = [T.StructField(c, SPARK_TYPE[k]) for c, k in spec.columns.items()]
    rows = _stored(spark, f"{path}/rows", T.StructType([*kinds, T.StructField("chunk", T.IntegerType())]))
    # A range is there with its marks: rows without them are of a read that was broken off.
    whole = marks
    events = changes.withColumn("chunk", chunk_of(F.col(spec.key), _cuts(spark, path)))
    if through is not None:
        entries = [F.struct(F.lit(p).alias("k"), F.lit(to).cast("long").alias("v")) for p, to in through.items()]
        reached = F.map_from_entries(F.array(*entries).cast("array<struct<k: int, v: bigint>>"))

        def end(partition: str) -> Column:
            return F.coalesce(F.try_element_at(reached, F.col(partition)), F.lit(0))

        events = events.where(F.col("kafka_offset") < end("kafka_partition"))
        late = marks.where(F.col("high") > end("partition")).select("chunk").distinct()
        whole = marks.join(late, "chunk", "left_anti")
    whole = whole.select("chunk").distinct()
    low = marks.select("chunk", F.col("partition").alias("kafka_partition"), "low")
    events = events.join(whole, "chunk", "left_semi").join(low, ["chunk", "kafka_partition"], "left")
    events = events.where(F.col("kafka_offset") >= F.coalesce("low", F.lit(0))).select(changes.columns)
    read = rows.join(whole, "chunk", "left_semi").drop("chunk").withColumn("row_kind", F.lit("INSERT"))
    return events.unionByName(read, allowMissingColumns=True)
