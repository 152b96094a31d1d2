"""Reading tables: files, or another database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.schemas import TableSpec, current_schema


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jdbc_options(
    spec: TableSpec, url: str, table: str, lower: int, upper: int, partitions: int, **extra: str
) -> dict[str, str]:
    """A scan split on key ranges, so that no single connection reads the whole table."""
    columns = ", ".join(spec.columns)
    return {
        "url": url,
        "dbtable": f"(SELECT {columns} FROM {table}) AS scan",
        "partitionColumn": spec.key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        **extra,
    }


def read_jdbc_table(
    spark: SparkSession,
    spec: TableSpec,
    url: str,
    table: str,
    lower: int,
    upper: int,
    partitions: int = 32,
    **extra: str,
) -> DataFrame:
    """The business columns of a table (needs the database's JDBC driver)."""
    options = jdbc_options(spec, url, table, lower, upper, partitions, **extra)
    return spark.read.format("jdbc").options(**options).load()


def key_cuts(keys: DataFrame, key: str, parts: int) -> list[int]:
    """Ascending keys that cut a table into about even parts, however its keys are spread.

    Taken from a quantile sketch of the keys (a replica's, say): one pass, a few kilobytes
    from each task, rank errors of about one percent. Fewer cuts where keys repeat a lot;
    none for an empty table.
    """
    ranks = F.array(*[F.lit(n / parts) for n in range(1, parts)])
    sketch = keys.where(F.col(key).isNotNull()).agg(F.kll_sketch_agg_bigint(F.col(key).cast("bigint")).alias("s"), F.count("*").alias("n"))
    if parts < 2 or not (row := sketch.where("n > 0").select(F.kll_sketch_get_quantile_bigint("s", ranks).alias("cuts")).first()):
        return []
    return sorted(set(row["cuts"]))


def key_predicates(key: str, cuts: list[int]) -> list[str]:
    """SQL conditions that share out all rows between the cuts: every row meets exactly one."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]


def read_jdbc_evenly(
    spark: SparkSession, spec: TableSpec, url: str, table: str, keys: DataFrame, parts: int = 32, **extra: str
) -> DataFrame:
    """A JDBC scan whose parts hold about as many rows each, by the keys of `keys`.

    `read_jdbc_table` cuts the range of keys evenly instead, which leaves parts empty where keys
    have gaps. Needs the database's driver, like every JDBC scan.
    """
    columns = ", ".join(spec.columns)
    predicates = key_predicates(spec.key, key_cuts(keys, spec.key, parts))
    properties = {"fetchsize": "10000", **extra}
    return spark.read.jdbc(url, f"(SELECT {columns} FROM {table}) AS scan", predicates=predicates, properties=properties)


def merge_statements(spec: TableSpec, table: str, stage: str) -> list[str]:
    """SQL a relational target runs to take in a staged batch of newest changes.

    Stage the batch with `newest.write.jdbc(url, stage, mode="overwrite")`. Only the
    listed columns are set on known keys, so a load-time default keeps its first value.
    """
    columns = current_schema(spec).names
    listed = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != spec.key)
    return [
        f"DELETE FROM {table} WHERE {spec.key} IN "
        f"(SELECT {spec.key} FROM {stage} WHERE row_kind = 'DELETE')",
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {stage} "
        f"WHERE row_kind <> 'DELETE' ON CONFLICT ({spec.key}) DO UPDATE SET {updates}",
    ]
