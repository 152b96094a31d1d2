"""Business rules: an ordered list of SQL conditions, compiled to one verdict per event."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from rowtide.functions.values import to_money

# Accepted currencies and order states.
CURRENCIES = ["INR", "USD", "EUR"]
STATUSES = ["CREATED", "PAID", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED"]

# Reasons that count as a pass.
DELETE_EVENT, VALID = "DELETE_EVENT", "VALID"


@dataclass(frozen=True)
class Rule:
    """`broken` is a SQL condition over {field} placeholders that holds for a bad row.
    A NULL outcome does not break the rule."""

    reason: str
    broken: str

    def over(self, fields: Mapping[str, str]) -> str:
        return self.broken.format_map(fields)


def _listed(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


ORDER_RULES = (
    Rule("ORDER_ID_NULL", "{order_id} IS NULL"),
    Rule("CUSTOMER_ID_NULL", "{customer_id} IS NULL"),
    Rule("AMOUNT_NOT_NUMERIC", f"{to_money('{amount}')} IS NULL"),
    Rule("NEGATIVE_AMOUNT", f"{to_money('{amount}')} < 0"),
    Rule("INVALID_CURRENCY", f"{{currency}} NOT IN ({_listed(CURRENCIES)})"),
    Rule("INVALID_STATUS", f"{{status}} NOT IN ({_listed(STATUSES)})"),
)


def first_failing(rules: tuple[Rule, ...], op: str, fields: Mapping[str, str]) -> str:
    """The reason of the first broken rule; deletes are never judged.

    `fields` maps a column of the row to the SQL that reads it.
    """
    branches = [f"WHEN {op} = 'd' THEN '{DELETE_EVENT}'"]
    branches += [f"WHEN {rule.over(fields)} THEN '{rule.reason}'" for rule in rules]
    return f"CASE {' '.join(branches)} ELSE '{VALID}' END"


def verdict_of(reason: str) -> str:
    return f"IF({reason} IN ('{DELETE_EVENT}', '{VALID}'), 'PASS', 'FAIL')"


def passes_all(rules: tuple[Rule, ...], fields: Mapping[str, str]) -> str:
    """Row filter of the valid table: every rule must be known to hold.

    Stricter than the verdict: a NULL currency or status passes the verdict (the rule
    is not known to be broken) but is kept out of the valid table.
    """
    return " AND ".join(["true", *[f"NOT ({rule.over(fields)})" for rule in rules]])
