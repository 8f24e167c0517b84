"""Code -> label decodes and channel rules. Arguments are column names or SQL expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions.contracts import AGE_RANGE, DAYPARTS, GENDER, NATIONALITY, NIGHT, PAYMENT_METHOD


def label(code: str, labels: Mapping[str, str], otherwise: str = "''") -> Column:
    """Look a code up by its text form, so numeric and text sources decode alike."""
    table = ", ".join(f"'{key}', '{value}'" for key, value in labels.items())
    return F.expr(f"coalesce(try_element_at(map({table}), cast({code} as string)), {otherwise})")


def gender(code: str) -> Column:
    return label(code, GENDER)


def age_range(code: str, keep_unknown: bool = False) -> Column:
    """Unknown ages are blank for product sales and pass through for payment services."""
    return label(code, AGE_RANGE, f"cast({code} as string)" if keep_unknown else "''")


def nationality(code: str) -> Column:
    return label(code, NATIONALITY)


def demographics(gender_code: str, age_code: str, nationality_code: str,
                 keep_unknown_age: bool = False) -> dict[str, Column]:
    return {
        "customer_gender": gender(gender_code),
        "customer_age_range": age_range(age_code, keep_unknown_age),
        "customer_nationality": nationality(nationality_code),
    }


def payment_method(code: str) -> Column:
    return label(code, PAYMENT_METHOD, "'unknown'")


def transaction_type(transaction_id: str) -> Column:
    return F.expr(f"case when startswith({transaction_id}, 'R') then 'Refund' else 'Sale Transaction' end")


def bill_channel(order_no: str) -> Column:
    """Channel a bill tells by itself, before any delivery is known."""
    return F.expr(f"case when startswith(lower({order_no}), 'savyu') then 'Savyu' else 'Store' end")


def delivery_channel(external_source: str, order_id: str) -> Column:
    return F.expr(f"""case when {external_source} <> '' then {external_source}
                           when {order_id} is not null then '7Now' else 'Unknown' end""")


def report_channel(source_7now: str, channel_name: str) -> Column:
    """Channel as dashboards show it."""
    return F.expr(f"""case when {source_7now} <> '' then '7NOW'
                           when contains(upper({channel_name}), 'SAVYU') then 'Savyu'
                           when contains(upper({channel_name}), '7NOW') then '7NOW'
                           when {channel_name} <> '' then {channel_name}
                           else 'Store' end""")


def daypart(hour: str) -> Column:
    cases = " ".join(f"when {hour} between {lo} and {hi} then '{name}'" for lo, hi, name in DAYPARTS)
    return F.expr(f"case {cases} else '{NIGHT}' end")
