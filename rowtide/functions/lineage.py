"""Where an event came from, as SQL text: ids, operation names, state digests."""

from __future__ import annotations

from collections.abc import Mapping

# Operation codes of the envelope and their names.
OPERATIONS = {"c": "CREATE", "r": "SNAPSHOT_READ", "u": "UPDATE", "d": "DELETE"}

# 32 hex digits that depend on the log position only, so a replay gives the same id.
EVENT_ID = "md5(concat_ws('|', topic_name, kafka_partition, kafka_offset))"


def operation_name(op: str) -> str:
    """Unknown codes pass through unchanged."""
    names = ", ".join(f"'{code}', '{name}'" for code, name in OPERATIONS.items())
    return f"coalesce(decode({op}, {names}), {op}, 'UNKNOWN')"


def whole_second_millis(instant: str) -> str:
    """Milliseconds since the epoch with the fraction of the second dropped."""
    return f"unix_seconds({instant}) * 1000"


def state_digest(names: tuple[str, ...], fields: Mapping[str, str]) -> str:
    """`a=1,b=null,…` over the given columns of a row."""
    parts = [
        f"concat('{name}=', coalesce(CAST({fields[name]} AS STRING), 'null'))" for name in names
    ]
    return f"concat_ws(',', {', '.join(parts)})"
