"""Table descriptions, the feed record, the envelope and the output tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from rowtide.functions.rules import ORDER_RULES, Rule

# Column kinds of a captured table. AMOUNT travels as text and is cast late, so that
# a bad amount is a finding about the row and not a failure of the job.
LONG, TEXT, AMOUNT, INSTANT = "long", "text", "amount", "instant"

MONEY = T.DecimalType(12, 2)

SPARK_TYPE = {
    LONG: T.LongType(),
    TEXT: T.StringType(),
    AMOUNT: MONEY,
    INSTANT: T.TimestampNTZType(),
}


@dataclass(frozen=True)
class TableSpec:
    """One captured table: its key, its columns in order, and its business rules."""

    database: str
    table: str
    key: str
    columns: dict[str, str]
    digest: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = field(default=())

    @property
    def topic(self) -> str:
        return f"mysql.{self.database}.{self.table}"

    def of_kind(self, kind: str) -> list[str]:
        return [name for name, k in self.columns.items() if k == kind]


ORDERS = TableSpec(
    database="shop",
    table="orders",
    key="order_id",
    columns={
        "order_id": LONG,
        "customer_id": LONG,
        "status": TEXT,
        "amount": AMOUNT,
        "currency": TEXT,
        "shipping_address": TEXT,
        "created_at": INSTANT,
        "updated_at": INSTANT,
    },
    digest=("order_id", "customer_id", "status", "amount", "currency"),
    rules=ORDER_RULES,
)

CUSTOMERS = TableSpec(
    database="shop",
    table="customers",
    key="customer_id",
    columns={
        "customer_id": LONG,
        "full_name": TEXT,
        "email": TEXT,
        "country_code": TEXT,
        "created_at": INSTANT,
        "updated_at": INSTANT,
    },
    digest=("customer_id", "full_name", "country_code"),
)

# The record of a partitioned log, as Spark's Kafka source names it.
FEED = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

# The fields of an envelope's source block and their types.
SOURCE_FIELDS = {
    "version": "string",
    "connector": "string",
    "name": "string",
    "ts_ms": "bigint",
    "snapshot": "string",
    "db": "string",
    "table": "string",
    "server_id": "bigint",
    "gtid": "string",
    "file": "string",
    "pos": "bigint",
    "row": "int",
}


def envelope_body(spec: TableSpec) -> T.StructType:
    """Everything is read as text (numbers may arrive quoted) and cast afterwards."""
    image = T.StructType([T.StructField(name, T.StringType()) for name in spec.columns])
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("source", T.MapType(T.StringType(), T.StringType())),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.StringType()),
        ]
    )


def envelope_schema(spec: TableSpec, envelope: str = "auto") -> T.StructType:
    """`wrapped` reads {"schema":…,"payload":{…}}, `flat` the bare body, `auto` either."""
    body = envelope_body(spec)
    wrapped = [T.StructField("payload", body)]
    if envelope == "wrapped":
        return T.StructType(wrapped)
    if envelope == "flat":
        return body
    if envelope == "auto":
        return T.StructType(wrapped + body.fields)
    raise ValueError(f"envelope must be auto, wrapped or flat, not {envelope!r}")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
_NTZ, _TS = T.TimestampNTZType(), T.TimestampType()

# Names, order and types of the output tables' columns, here and below.
RAW_EVENTS = _struct(
    ("event_id", _S),
    ("topic_name", _S),
    ("kafka_partition", _I),
    ("kafka_offset", _L),
    ("kafka_timestamp", _NTZ),
    ("payload", _S),
    ("is_tombstone", _B),
)

EVENT_AUDIT = _struct(
    ("event_id", _S),
    ("topic_name", _S),
    ("kafka_partition", _I),
    ("kafka_offset", _L),
    ("operation", _S),
    ("order_id", _L),
    ("source_file", _S),
    ("source_position", _L),
    ("source_row", _I),
    ("source_gtid", _S),
    ("source_ts_ms", _L),
    ("kafka_ts_ms", _L),
    ("validation_status", _S),
    ("validation_reason", _S),
    ("before_state", _S),
    ("after_state", _S),
)

REJECTS = _struct(
    ("event_id", _S),
    ("order_id", _L),
    ("operation", _S),
    ("reason", _S),
    ("amount_raw", _S),
    ("status_raw", _S),
    ("currency_raw", _S),
    ("source_file", _S),
    ("source_position", _L),
    ("kafka_partition", _I),
    ("kafka_offset", _L),
)


def current_schema(spec: TableSpec) -> T.StructType:
    return _struct(
        *[(name, SPARK_TYPE[kind]) for name, kind in spec.columns.items()],
        ("source_event_ts", _NTZ),
        ("kafka_partition", _I),
        ("kafka_offset", _L),
    )


RECONCILIATION = _struct(
    ("check_id", _L),
    ("checked_at", _TS),
    ("source_count", _L),
    ("target_count", _L),
    ("valid_target_count", _L),
    ("missing_in_target", _L),
    ("extra_in_target", _L),
    ("mismatched_rows", _L),
    ("reject_count", _L),
    ("audit_count", _L),
    ("raw_event_count", _L),
    ("status", _S),
    ("details", _S),
)
