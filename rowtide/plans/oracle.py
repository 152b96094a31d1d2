"""SQL twins of the queries, for another engine over the same tables.

The twins never read JSON: they compute each result directly from `orders` and
`customer`, so they check the decoding as well as the steps after it.
"""

from __future__ import annotations

from rowtide.plans.inputs import ROLLED_MS
from rowtide.plans.queries import DIFF_MS, DIGESTED, SNAPSHOT_MS, UPSERT_TIME

IMAGE = ["order_id", "customer_id", "status", "amount", "currency", "shipping_address",
         "created_at", "updated_at"]
NUMBERS = {"order_id", "customer_id"}


def _quoted(value: str) -> str:
    return f"""coalesce('"' || {value} || '"', 'null')"""


def _json_image(prefix: str) -> str:
    parts = []
    for name in IMAGE:
        column = f"{prefix}{name}"
        text = f"coalesce(CAST({column} AS VARCHAR), 'null')" if name in NUMBERS else _quoted(column)
        parts.append(f"""'"{name}":' || {text}""")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _json_source(ts_ms: str, snapshot: str, gtid: str, file: str, pos: str, table: str = "orders") -> str:
    return (
        """'{"version":"3.6.0","connector":"mysql","name":"mysql","ts_ms":' || """
        f"""{ts_ms} || ',"snapshot":"' || {snapshot} || '","db":"shop","table":"{table}",'"""
        f""" || '"server_id":223344,"gtid":' || {_quoted(gtid)} || ',"file":"' || {file}"""
        f""" || '","pos":' || {pos} || ',"row":0}}'"""
    )


def _json_body(before: str, after: str, source: str, op: str, ts_ms: str) -> str:
    return (
        f"""'{{"before":' || coalesce({before}, 'null') || ',"after":' || coalesce({after}, 'null')"""
        f""" || ',"source":' || {source} || ',"op":"' || {op} || '","ts_ms":' || {ts_ms} || '}}'"""
    )


def _wrap(body: str) -> str:
    return f"""'{{"schema":null,"payload":' || {body} || '}}'"""


# One row per order with both versions of its image, as text.
IMAGES = """
images AS (
  SELECT k, day_ms, k AS order_id,
    CASE WHEN k % 101 <> 7 THEN o_custkey END AS customer_id,
    CASE WHEN k % 113 = 5 THEN NULL WHEN k % 14 = 3 THEN 'SHIPPED'
         WHEN k % 14 = 8 THEN 'CANCELLED' WHEN o_orderstatus = 'O' THEN 'CREATED'
         WHEN o_orderstatus = 'P' THEN 'PROCESSING' ELSE 'DELIVERED' END AS status0,
    CASE WHEN k % 97 = 0 THEN 'BROKEN_STATUS' ELSE 'PAID' END AS status1,
    CASE WHEN k % 89 = 1 THEN 'abc' WHEN k % 83 = 2 THEN '-' || price
         WHEN k % 127 = 6 THEN NULL ELSE price END AS amount0,
    CASE WHEN k % 103 = 0 THEN 'abc' WHEN k % 127 = 6 THEN NULL ELSE price END AS amount1,
    CASE WHEN k % 79 = 3 THEN 'GBP' WHEN k % 109 = 4 THEN NULL WHEN k % 4 = 1 THEN 'USD'
         WHEN k % 4 = 2 THEN 'EUR' ELSE 'INR' END AS currency,
    CASE WHEN k % 13 <> 0 THEN o_orderpriority END AS shipping_address,
    day || 'T00:00:00.000Z' AS created_at,
    day || 'T00:00:00.123Z' AS updated_at0,
    day || 'T00:00:01.123Z' AS updated_at1
  FROM (SELECT *, o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS day,
          CAST(epoch_ms(o_orderdate) AS BIGINT) AS day_ms,
          CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price
        FROM orders) AS o
)"""

# The log: bv / av say which image (0 or 1) an event shows before and after the change.
_VERSIONED = {
    "order_id": "{v} >= 0 THEN order_id",
    "customer_id": "{v} >= 0 THEN customer_id",
    "status": "{v} = 0 THEN status0 WHEN {v} = 1 THEN status1",
    "amount": "{v} = 0 THEN amount0 WHEN {v} = 1 THEN amount1",
    "currency": "{v} >= 0 THEN currency",
    "shipping_address": "{v} >= 0 THEN shipping_address",
    "created_at": "{v} >= 0 THEN created_at",
    "updated_at": "{v} = 0 THEN updated_at0 WHEN {v} = 1 THEN updated_at1",
}
_SHOWN = ",\n    ".join(
    f"CASE WHEN {_VERSIONED[name].format(v=version)} END AS {prefix}{name}"
    for prefix, version in (("b_", "bv"), ("a_", "av"))
    for name in IMAGE
)

LOG = f"""
WITH {IMAGES.strip()},
steps AS (
  SELECT images.*, step,
    CASE WHEN step < 5 THEN step WHEN k % 33 = 0 THEN 4 WHEN k % 11 = 0 THEN 2
         WHEN k % 3 = 0 THEN 1 ELSE 0 END AS event
  FROM images, (VALUES (0), (1), (2), (3), (4), (5)) AS s(step)
  WHERE step = 0 OR (step = 1 AND k % 3 = 0) OR (step IN (2, 3) AND k % 11 = 0)
     OR (step = 4 AND k % 33 = 0) OR (step = 5 AND k % 7 = 0)
),
shown AS (
  SELECT *,
    CASE WHEN event = 1 THEN 0 WHEN event = 2 AND k % 3 = 0 THEN 1 WHEN event = 2 THEN 0 END AS bv,
    CASE WHEN event = 1 THEN 1 WHEN event IN (0, 4) THEN 0 END AS av
  FROM steps
),
log AS (
  SELECT k, step, event, bv, av,
    'mysql.shop.orders' AS topic_name,
    CAST(k % 6 AS INTEGER) AS kafka_partition,
    CAST((k // 6) * 8 + step AS BIGINT) AS kafka_offset,
    day_ms + step * 1000 + 987 AS log_ms,
    day_ms + event * 1000 + 487 AS source_ts_ms,
    CASE WHEN event = 3 THEN NULL WHEN event = 1 THEN 'u' WHEN event = 2 THEN 'd'
         WHEN event = 0 AND k % 5 = 0 THEN 'r' ELSE 'c' END AS op,
    'mysql-bin.' || lpad(CAST(k % 4 + 1 AS VARCHAR), 6, '0') AS source_file,
    CAST(k * 100 + event AS BIGINT) AS source_position,
    CASE WHEN k % 4 <> 0 THEN 'gtid:' || k END AS source_gtid,
    md5('mysql.shop.orders|' || (k % 6) || '|' || ((k // 6) * 8 + step)) AS event_id,
    {_SHOWN}
  FROM shown
)"""

_BODY = _json_body(
    f"CASE WHEN bv >= 0 THEN {_json_image('b_')} END",
    f"CASE WHEN av >= 0 THEN {_json_image('a_')} END",
    _json_source(
        "source_ts_ms", "CASE WHEN op = 'r' THEN 'true' ELSE 'false' END",
        "source_gtid", "source_file", "source_position",
    ),
    "op",
    "(source_ts_ms + 250)",
)

RAW = f"""{LOG}
SELECT event_id, topic_name, kafka_partition, kafka_offset,
  epoch_ms(log_ms) AS kafka_timestamp,
  CASE WHEN op IS NULL THEN NULL WHEN k % 10 = 9 THEN {_BODY} ELSE {_wrap(_BODY)} END AS payload,
  op IS NULL AS is_tombstone
FROM log"""


def _digest(prefix: str) -> str:
    names = ["order_id", "customer_id", "status", "amount", "currency"]
    return " || ',' || ".join(
        f"'{name}=' || coalesce(CAST({prefix}{name} AS VARCHAR), 'null')" for name in names
    )


# The accepted order states.
_STATUSES = "['CREATED', 'PAID', 'PROCESSING', 'SHIPPED', 'DELIVERED', 'CANCELLED']"

# Rule findings side by side; the first one present is the reason.
JUDGED = f"""{LOG},
findings AS (
  SELECT *, TRY_CAST(a_amount AS DECIMAL(12,2)) AS money FROM log WHERE op IS NOT NULL
),
judged AS (
  SELECT *, coalesce(
      CASE op WHEN 'd' THEN 'DELETE_EVENT' END,
      CASE WHEN a_order_id IS NULL THEN 'ORDER_ID_NULL' END,
      CASE WHEN a_customer_id IS NULL THEN 'CUSTOMER_ID_NULL' END,
      CASE WHEN money IS NULL THEN 'AMOUNT_NOT_NUMERIC' END,
      CASE WHEN money < 0 THEN 'NEGATIVE_AMOUNT' END,
      CASE WHEN a_currency <> ALL (['INR', 'USD', 'EUR']) THEN 'INVALID_CURRENCY' END,
      CASE WHEN a_status <> ALL ({_STATUSES}) THEN 'INVALID_STATUS' END,
      'VALID') AS reason,
    CASE op WHEN 'c' THEN 'CREATE' WHEN 'r' THEN 'SNAPSHOT_READ'
            WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' END AS operation
  FROM findings
)"""

AUDIT = f"""{JUDGED}
SELECT event_id, topic_name, kafka_partition, kafka_offset, operation, k AS order_id,
  source_file, source_position, 0 AS source_row, source_gtid, source_ts_ms,
  (log_ms // 1000) * 1000 AS kafka_ts_ms,
  CASE WHEN reason IN ('VALID', 'DELETE_EVENT') THEN 'PASS' ELSE 'FAIL' END AS validation_status,
  reason AS validation_reason,
  {_digest('b_')} AS before_state,
  {_digest('a_')} AS after_state
FROM judged"""

REJECTS = f"""{JUDGED}
SELECT event_id, k AS order_id, operation, reason, a_amount AS amount_raw,
  a_status AS status_raw, a_currency AS currency_raw, source_file, source_position,
  kafka_partition, kafka_offset
FROM judged WHERE reason NOT IN ('VALID', 'DELETE_EVENT')"""

_FLAT_IMAGES = ", ".join(
    f"{short}{name} AS {label}_{name}"
    for short, label in (("b_", "before"), ("a_", "after"))
    for name in IMAGE
)

STRUCTURED = f"""{LOG}
SELECT topic_name, kafka_partition, kafka_offset, op,
  CASE WHEN op IS NOT NULL THEN source_ts_ms + 250 END AS ts_ms, {_FLAT_IMAGES}
FROM log"""


def _row_of_change(amount: str = "{}") -> str:
    """The changed row: `after`, or `before` of a delete."""
    columns = []
    for name in IMAGE:
        text = f"CASE op WHEN 'd' THEN b_{name} ELSE a_{name} END"
        if name == "amount":
            text = amount.format(text)
        elif name.endswith("_at"):
            text = f"CAST(replace(replace({text}, 'T', ' '), 'Z', '') AS TIMESTAMP)"
        columns.append(f"{text} AS {name}")
    return ",\n    ".join(columns)


_ROW_KIND = "CASE op WHEN 'd' THEN 'DELETE' WHEN 'u' THEN 'UPDATE' ELSE 'INSERT' END AS row_kind"

CHANGELOG = f"""{LOG}
SELECT {_ROW_KIND},
    {_row_of_change()},
  topic_name, kafka_partition, kafka_offset
FROM log WHERE op IS NOT NULL"""

SOURCE_METADATA = f"""{LOG}
SELECT k AS order_id, topic_name, kafka_partition, kafka_offset,
  epoch_ms(log_ms) AS kafka_timestamp, epoch_ms(source_ts_ms) AS source_event_ts,
  'shop' AS source_database, 'orders' AS source_table,
  '3.6.0' AS source_version, 'mysql' AS source_connector, 'mysql' AS source_name,
  CAST(source_ts_ms AS VARCHAR) AS source_ts_ms,
  CASE WHEN op = 'r' THEN 'true' ELSE 'false' END AS source_snapshot,
  '223344' AS source_server_id, source_gtid, source_file,
  CAST(source_position AS VARCHAR) AS source_pos, '0' AS source_row
FROM log WHERE op IS NOT NULL"""

_MONEY = "TRY_CAST({} AS DECIMAL(12,2))"

CHANGES = f"""{LOG},
changes AS (
  SELECT {_ROW_KIND},
    {_row_of_change(_MONEY)},
    epoch_ms(source_ts_ms) AS source_event_ts, kafka_partition, kafka_offset,
    source_ts_ms, source_file, source_position, 0 AS source_row
  FROM log WHERE op IS NOT NULL
)"""

_STATE_COLUMNS = ", ".join(IMAGE + ["source_event_ts", "kafka_partition", "kafka_offset"])


def _current(order: str) -> str:
    return f"""{CHANGES},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {order}) AS n FROM changes
),
current_orders AS (
  SELECT {_STATE_COLUMNS} FROM ranked WHERE n = 1 AND row_kind <> 'DELETE'
)"""


_BY_POSITION = _current("kafka_offset DESC")
CURRENT = f"{_BY_POSITION} SELECT * FROM current_orders"
# Updates of every fifth order lie in another partition.
CURRENT_BY_SOURCE = (
    _current("source_ts_ms DESC, source_position DESC, kafka_partition DESC, kafka_offset DESC")
    + " SELECT * FROM current_orders"
).replace(
    "CAST(k % 6 AS INTEGER) AS kafka_partition",
    "CAST((k + CASE WHEN step = 1 AND k % 5 = 0 THEN 5 ELSE 0 END) % 6 AS INTEGER) AS kafka_partition",
)
_IS_VALID = (
    "customer_id IS NOT NULL AND amount >= 0 AND currency IN ('INR', 'USD', 'EUR') "
    f"AND list_contains({_STATUSES}, status)"
)
VALID = f"{_BY_POSITION} SELECT * FROM current_orders WHERE {_IS_VALID}"

_CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS full_name,
    'c' || c_custkey || '@example.com' AS email,
    lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code,
    TIMESTAMP '2026-01-01 00:00:00' AS created_at,
    TIMESTAMP '2026-01-01 00:00:00' AS updated_at
  FROM customer
)"""

CUSTOMERS_CURRENT = f"""WITH {_CUSTOMERS}
SELECT *, epoch_ms(CAST({SNAPSHOT_MS} AS BIGINT)) AS source_event_ts,
  CAST(customer_id % 6 AS INTEGER) AS kafka_partition,
  CAST(customer_id // 6 AS BIGINT) AS kafka_offset
FROM customers"""

KEYED_UPSERT = f"""WITH {_CUSTOMERS}
SELECT customer_id, full_name,
  CASE WHEN customer_id % 8 = 4 AND customer_id % 16 <> 12 THEN 'new-' || email ELSE email END AS email,
  country_code, created_at,
  CASE WHEN customer_id % 8 = 4 AND customer_id % 16 <> 12
       THEN TIMESTAMP '{UPSERT_TIME}' ELSE updated_at END AS updated_at
FROM customers
UNION ALL
SELECT -customer_id - 1, full_name, 'new-' || email, country_code,
  TIMESTAMP '{UPSERT_TIME}', TIMESTAMP '{UPSERT_TIME}'
FROM customers WHERE customer_id % 8 = 0"""


def _table_of(name: str, picks_one: str, where: str) -> str:
    """A version of the orders table; `picks_one` says when a row shows image 1."""
    def stamp(text: str) -> str:
        return f"CAST(replace(replace({text}, 'T', ' '), 'Z', '') AS TIMESTAMP)"

    return f"""
{name} AS (
  SELECT order_id, customer_id,
    CASE WHEN {picks_one} THEN status1 ELSE status0 END AS status,
    TRY_CAST(CASE WHEN {picks_one} THEN amount1 ELSE amount0 END AS DECIMAL(12,2)) AS amount,
    currency, shipping_address, {stamp('created_at')} AS created_at,
    {stamp(f"CASE WHEN {picks_one} THEN updated_at1 ELSE updated_at0 END")} AS updated_at
  FROM images WHERE {where}
)"""


_FINAL = _table_of(
    "final_orders", "k % 3 = 0 AND k % 33 <> 0", "NOT (k % 11 = 0 AND k % 33 <> 0)"
)
_FIRST = _table_of("first_orders", "FALSE", "TRUE")
_OLD = _table_of("old_orders", "FALSE", "k % 13 <> 1")

# Reconciliation: a source and a target with planted faults.
SIDES = f"""{_BY_POSITION},{_FINAL},
source_side AS (SELECT * FROM final_orders WHERE order_id % 19 <> 0),
target_side AS (
  SELECT * REPLACE (CASE WHEN order_id % 23 = 0 THEN 'CANCELLED' ELSE status END AS status)
  FROM current_orders WHERE order_id % 17 <> 0
),
missing AS (SELECT order_id FROM source_side EXCEPT SELECT order_id FROM target_side),
extra AS (SELECT order_id FROM target_side EXCEPT SELECT order_id FROM source_side),
differing AS (
  SELECT order_id FROM (
    SELECT {", ".join(IMAGE)} FROM source_side EXCEPT SELECT {", ".join(IMAGE)} FROM target_side)
  WHERE order_id IN (SELECT order_id FROM target_side)
)"""


def _reported(alias: str, label: str) -> str:
    texts = []
    for name in IMAGE[1:]:
        text = f"CAST({alias}.{name} AS VARCHAR)"
        if name.endswith("_at"):
            text = f"strftime({alias}.{name}, '%Y-%m-%dT%H:%M:%S.%g')"
        texts.append(f"{text} AS {label}_{name}")
    return ", ".join(texts)


MISMATCH = f"""{SIDES}
SELECT d.order_id, {_reported('s', 'source')}, {_reported('t', 'target')}
FROM differing d JOIN source_side s ON s.order_id = d.order_id
  JOIN target_side t ON t.order_id = d.order_id"""

OUTCOMES = f"""{SIDES}
SELECT order_id, 'MISSING' AS outcome FROM missing
UNION ALL SELECT order_id, 'EXTRA' FROM extra
UNION ALL SELECT order_id, 'MISMATCH' FROM differing
UNION ALL SELECT order_id, 'MATCH' FROM source_side
  WHERE order_id NOT IN (SELECT order_id FROM missing)
    AND order_id NOT IN (SELECT order_id FROM differing)"""

_SIZES = f"""
audit_size AS (
  SELECT count(*) AS audit_count,
    count(*) FILTER (WHERE op <> 'd' AND (a_customer_id IS NULL
      OR coalesce(TRY_CAST(a_amount AS DECIMAL(12,2)), -1) < 0
      OR a_currency NOT IN ('INR', 'USD', 'EUR') OR NOT list_contains({_STATUSES}, a_status))) AS reject_count
  FROM log WHERE op IS NOT NULL
),
sizes AS (
  SELECT audit_count, reject_count, (SELECT count(*) FROM log) AS raw_event_count,
    (SELECT count(*) FROM current_orders) AS current_count,
    (SELECT count(*) FROM current_orders WHERE {_IS_VALID}) AS valid_target_count
  FROM audit_size
)"""


def _rows_of(**names: str) -> str:
    return " UNION ALL ".join(f"SELECT '{label}' AS name, {c} AS n FROM sizes" for label, c in names.items())


_METRIC_NAMES = ["valid_target_count", "audit_count", "reject_count", "raw_event_count"]
METRICS = f"{_BY_POSITION},{_SIZES} {_rows_of(**{n: n for n in _METRIC_NAMES})}"


def _digested(table: str, sql: str) -> str:
    texts = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in DIGESTED[table])
    part = f"CAST('0x' || substr(md5({texts}), 1, 8) AS BIGINT)"
    return f"SELECT '{table}' AS name, count(*) AS n, CAST(coalesce(sum({part}), 0) AS BIGINT) AS digest FROM ({sql}) AS t"


FIVE_TABLES = " UNION ALL ".join(
    _digested(table, sql)
    for table, sql in (
        ("cdc_raw_events", RAW),
        ("cdc_event_audit", AUDIT),
        ("cdc_rejects", REJECTS),
        ("orders_current", CURRENT),
        ("orders_valid_current", VALID),
    )
)


def _first_ids(table: str) -> str:
    return (
        "coalesce((SELECT string_agg(CAST(order_id AS VARCHAR), ',' ORDER BY order_id) FROM "
        f"(SELECT order_id FROM {table} ORDER BY order_id LIMIT 100)), '')"
    )


_REPORT = f"""
SELECT (SELECT count(*) FROM source_side) AS source_count,
  (SELECT count(*) FROM target_side) AS target_count, valid_target_count,
  (SELECT count(*) FROM missing) AS missing_in_target,
  (SELECT count(*) FROM extra) AS extra_in_target,
  (SELECT count(*) FROM differing) AS mismatched_rows,
  reject_count, audit_count, raw_event_count,
  CASE WHEN EXISTS (FROM missing) OR EXISTS (FROM extra) OR EXISTS (FROM differing)
       THEN 'FAIL' ELSE 'PASS' END AS status,
  '{{"missing_ids":[' || {_first_ids('missing')} || '],"extra_ids":[' || {_first_ids('extra')}
    || '],"mismatch_ids":[' || {_first_ids('differing')} || ']}}' AS details
FROM sizes"""
SUMMARY = f"""{SIDES},{_SIZES}{_REPORT}"""

# Source and replica as they are, without planted faults.
_TRUE_SIDES = (
    SIDES.replace(" WHERE order_id % 19 <> 0", "")
    .replace("* REPLACE (CASE WHEN order_id % 23 = 0 THEN 'CANCELLED' ELSE status END AS status)", "*")
    .replace(" WHERE order_id % 17 <> 0", "")
)
CONVERGED = f"""{_TRUE_SIDES},{_SIZES}{_REPORT}"""


def _texts(table: str, prefix: str = "") -> str:
    """A table's rows with their columns spelled as an envelope spells them."""
    columns = []
    for name in IMAGE:
        text = name
        if name == "amount":
            text = "CAST(amount AS VARCHAR)"
        elif name.endswith("_at"):
            text = f"strftime({name}, '%Y-%m-%dT%H:%M:%S.%gZ')"
        columns.append(f"{text} AS {prefix}{name}")
    return f"SELECT {', '.join(columns)} FROM {table}"


def _plain_source(at_ms: int, snapshot: str, pos: str) -> str:
    return _json_source(str(at_ms), f"'{snapshot}'", "CAST(NULL AS VARCHAR)", "'mysql-bin.000001'", pos)


def _feed(at: str, offset: str, value: str, key: str) -> str:
    return f"""SELECT 'mysql.shop.orders' AS topic, CAST({key} % 6 AS INTEGER) AS partition,
  CAST({offset} AS BIGINT) AS "offset", epoch_ms(CAST({at} AS BIGINT)) AS "timestamp",
  '{{"order_id":' || {key} || '}}' AS key, {value} AS value"""


_SNAPSHOT_VALUE = _wrap(
    _json_body("NULL", _json_image("a_"), _plain_source(SNAPSHOT_MS, "true", "0"), "'r'", str(SNAPSHOT_MS))
)
SNAPSHOT_FEED = f"""WITH {IMAGES},{_FINAL},
texts AS ({_texts('final_orders', 'a_')})
{_feed(str(SNAPSHOT_MS), 'a_order_id // 6', _SNAPSHOT_VALUE, 'a_order_id')} FROM texts"""

_DIFF_BODY = _json_body(
    f"CASE WHEN b_order_id IS NOT NULL THEN {_json_image('b_')} END",
    f"CASE WHEN a_order_id IS NOT NULL THEN {_json_image('a_')} END",
    _plain_source(DIFF_MS, "false", "(id * 100)"),
    "op",
    str(DIFF_MS),
)
SNAPSHOT_DIFF = f"""WITH {IMAGES},{_FINAL},{_OLD},
b AS ({_texts('old_orders', 'b_')}), a AS ({_texts('final_orders', 'a_')}),
pairs AS (
  SELECT *, coalesce(b_order_id, a_order_id) AS id,
    CASE WHEN b_order_id IS NULL THEN 'c' WHEN a_order_id IS NULL THEN 'd' ELSE 'u' END AS op
  FROM b FULL OUTER JOIN a ON b_order_id = a_order_id
  WHERE b_order_id IS NULL OR a_order_id IS NULL
     OR {" OR ".join(f"b_{c} IS DISTINCT FROM a_{c}" for c in IMAGE)}
),
records AS (
  SELECT pairs.*, step FROM pairs, (VALUES (0), (1)) AS s(step) WHERE step = 0 OR op = 'd'
)
{_feed(f'{DIFF_MS} + step', '(id // 6) * 2 + step', f'CASE step WHEN 0 THEN {_wrap(_DIFF_BODY)} END', 'id')}
FROM records"""

APPLY_FEED = f"WITH {IMAGES},{_FINAL} SELECT * FROM final_orders"

# Ids of both signs; place is a key's place among those of its sign.
_SIGNED = """SELECT order_id AS plain_id, CASE WHEN order_id % 6 = 4 THEN -order_id ELSE order_id END AS signed_id,
    CASE WHEN order_id % 6 = 4 THEN order_id - 1 ELSE order_id END AS place FROM images"""
BOOTSTRAP = f"""WITH {IMAGES},{_FINAL},{_OLD},
signed AS ({_SIGNED}),
start AS (SELECT max(place // 6) + 1 AS base FROM old_orders JOIN signed ON plain_id = order_id),
same AS (SELECT * FROM old_orders INTERSECT SELECT * FROM final_orders)
SELECT f.* REPLACE (signed_id AS order_id),
  epoch_ms(CAST(CASE WHEN kept THEN {SNAPSHOT_MS} ELSE {DIFF_MS} END AS BIGINT)) AS source_event_ts,
  CAST(place % 6 + CASE WHEN signed_id < 0 THEN 6 ELSE 0 END AS INTEGER) AS kafka_partition,
  CAST(CASE WHEN kept THEN place // 6 ELSE base + (place // 6) * 2 END AS BIGINT) AS kafka_offset
FROM final_orders f JOIN signed ON plain_id = f.order_id, start,
  LATERAL (SELECT f.order_id IN (SELECT order_id FROM same) AS kept) AS e"""

BOOTSTRAP_CHUNKS = f"""WITH {IMAGES},{_FINAL},
signed AS ({_SIGNED})
SELECT f.* REPLACE (signed_id AS order_id) FROM final_orders f JOIN signed ON plain_id = f.order_id"""


def _odd(sql: str) -> str:
    """The same over the feed with odd records: placed without a key, or by an unknown operation."""
    pairs = (
        ("CASE WHEN event = 3 THEN NULL", "CASE WHEN step = 0 AND k % 43 = 2 AND k % 41 <> 1 THEN 'x' WHEN event = 3 THEN NULL"),
        ("CASE WHEN av >= 0 THEN order_id END", "CASE WHEN av >= 0 AND NOT (step = 0 AND k % 41 = 1) THEN order_id END"),
        ("operation, k AS order_id", "operation, coalesce(a_order_id, b_order_id) AS order_id"),
        ("'DELETE' END AS operation", "'DELETE' ELSE op END AS operation"),
        (
            "source_row\n  FROM log WHERE op IS NOT NULL",
            "source_row\n  FROM log WHERE op IN ('c', 'r', 'u', 'd') AND (op = 'd' OR a_order_id IS NOT NULL)",
        ),
    )
    for plain, odd in pairs:
        sql = sql.replace(plain, odd)
    return sql


CURRENT_ROLLED = f"""SELECT * REPLACE (epoch_ms(CAST({ROLLED_MS} AS BIGINT)) AS source_event_ts) FROM ({CURRENT}) AS c"""

DRIFT = f"""{LOG}
SELECT place, 'discount_code' AS field, 'STRING' AS type, count(*) AS records,
  min(kafka_partition) AS first_partition, arg_min(kafka_offset, CAST(kafka_partition AS BIGINT) * 1000000000000 + kafka_offset) AS first_offset
FROM (
  SELECT 'before' AS place, * FROM log WHERE bv >= 0 UNION ALL SELECT 'after' AS place, * FROM log WHERE av >= 0
) AS images
WHERE op IS NOT NULL AND k % 47 = 3 AND NOT (step = 0 AND (k % 41 = 1 OR k % 43 = 2))
GROUP BY place"""

def _gtid_islands(numbers: str) -> str:
    return f"""{LOG},
seen AS (
  SELECT DISTINCT CAST(split_part(source_gtid, ':', 2) AS BIGINT) AS n
  FROM log WHERE op IS NOT NULL AND source_gtid IS NOT NULL
), numbers AS ({numbers})
SELECT 'gtid' AS server, min(n) AS first, max(n) AS last
FROM (SELECT n, n - row_number() OVER (ORDER BY n) AS island FROM numbers) AS numbered
GROUP BY island"""


ORACLES: dict[str, str] = {
    "cdc_raw_events": RAW,
    "raw_events_reread": RAW,
    "cdc_event_audit": AUDIT,
    "cdc_event_audit_odd": _odd(AUDIT),
    "cdc_rejects": REJECTS,
    "orders_structured": STRUCTURED,
    "orders_changelog": CHANGELOG,
    "source_metadata": SOURCE_METADATA,
    "orders_typed": f"{CHANGES} SELECT * FROM changes",
    "orders_current": CURRENT,
    "orders_current_by_source": CURRENT_BY_SOURCE,
    "orders_current_odd": _odd(CURRENT),
    "orders_current_rolled": CURRENT_ROLLED,
    "drift_report": DRIFT,
    "gtid_ranges": _gtid_islands("SELECT n FROM seen"),
    "gtid_missing": _gtid_islands(
        "SELECT n FROM range(1, (SELECT max(n) FROM seen)) AS r(n) WHERE n NOT IN (SELECT n FROM seen)"
    ),
    "orders_valid_current": VALID,
    "customers_current": CUSTOMERS_CURRENT,
    "reconcile_missing": f"{SIDES} SELECT order_id FROM missing ORDER BY order_id",
    "reconcile_extra": f"{SIDES} SELECT order_id FROM extra ORDER BY order_id",
    "reconcile_missing_bitmap": f"{SIDES} SELECT order_id FROM missing ORDER BY order_id",
    "reconcile_extra_bitmap": f"{SIDES} SELECT order_id FROM extra ORDER BY order_id",
    "reconcile_mismatch": MISMATCH,
    "reconcile_outcomes": OUTCOMES,
    "reconcile_by_digest": OUTCOMES,
    "reconcile_metrics": METRICS,
    "reconcile_findings": f"SELECT * FROM ({OUTCOMES}) AS o WHERE outcome <> 'MATCH'",
    "reconcile_summary": SUMMARY,
    "reconcile_converged": CONVERGED,
    "snapshot_feed": SNAPSHOT_FEED,
    "snapshot_diff": SNAPSHOT_DIFF,
    "apply_feed": APPLY_FEED,
    "bootstrap_then_follow": BOOTSTRAP,
    "bootstrap_in_chunks": BOOTSTRAP_CHUNKS,
    "keyed_upsert": KEYED_UPSERT,
    "stream_raw": RAW,
    "stream_audit": AUDIT,
    "stream_rejects": REJECTS,
    "stream_orders_current": CURRENT,
    "stream_orders_valid_current": VALID,
    "stream_latest_state": CURRENT,
    "stream_restart": CURRENT,
    "stream_raw_reread": RAW,
    "stream_valid_changes": VALID,
    "stream_five_tables": FIVE_TABLES,
}
