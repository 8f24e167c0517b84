"""Who bought: the tables that may know a bill's customer, and how their answers become one.

Each source answers a bill with one struct column under the source's name. What a column of the fact takes, from which
answers in which order, is a table; the joins and the choice are built from it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.contracts import IDENTITY_FLIP_DATE, NO_ID, STATUS_TIMES
from tillhouse.operators.dedup import one_per_key
from tillhouse.operators.shares import Share, of_share

# What a user row tells, by the column it becomes.
USER_FIELDS = {"customer_phone": "phone", "user_name": "full_name", "customer_code": "customer_code"}
WHO = ("customer_id", *USER_FIELDS, "dom_created_at")
TIMES = tuple(STATUS_TIMES.values())
SHIPPED = ("external_order_id", "delivery_note", "short_order_id", "order_id")
DELIVERY = (*WHO, *SHIPPED, "channel_name", "partner_store", *TIMES)


@dataclass(frozen=True)
class Source:
    """A typed table that answers for a bill, by one of the bill's columns."""

    table: str
    key: str
    fields: tuple[str, ...]
    key_may_be_null: bool = False


# In the order of the joins: all but the last keep the partitioning by transaction.
SOURCES = {
    "rated": Source("transactions", "transaction_id", (*WHO, "rating", "comment")),
    "earned": Source("points", "transaction_id", (*WHO, "capture_method")),
    "shipped": Source("deliveries", "transaction_id", DELIVERY),
    "ordered": Source("deliveries", "order_no", DELIVERY, key_may_be_null=True),
}

# Whose answer comes first, by column.
SHIPPED_FIRST = ("shipped", "ordered", "earned", "rated")
EARNED_FIRST = ("earned", "rated", "shipped", "ordered")
ORDER = {
    **dict.fromkeys((*USER_FIELDS, "dom_created_at", "customer_id"), SHIPPED_FIRST),
    **dict.fromkeys((*SHIPPED, "channel_name", "partner_store"), ("shipped", "ordered")),
    **dict.fromkeys(TIMES, ("ordered", "shipped")),
}
# Columns that one source alone tells.
SAID = {"rating": "rated", "comment": "rated", "capture_method": "earned"}
# Columns of the bill itself that stand in where no answer has one.
OWN = {"channel_name": "channel_name", "partner_store": "promotion_partner_store"}


def known_users(users: DataFrame) -> DataFrame:
    return users.select("user_id", *[F.col(field).alias(name) for name, field in USER_FIELDS.items()])


def with_user(rows: DataFrame, users: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rows of a source with what is known of their user; `columns` names the row's own columns that stay."""
    named = rows.join(known_users(users), "user_id", "left")
    return named.select(*[F.col(own).alias(name) for name, own in columns.items()], *USER_FIELDS)


def asked(bills: DataFrame, tables: Mapping[str, DataFrame], one_delivery: bool = False,
          heads: DataFrame | None = None, share: Share | None = None) -> DataFrame:
    """Bills with the answer of every source, null where it has none.

    Two deliveries on one transaction multiply its lines, as the grain check is there to report; with `one_delivery`
    the one of the highest order id answers.

    A key that may be null is answered per transaction first, on the few bills that have it, so bills stay dealt by
    transaction and those without it meet nowhere. `heads` has every bill's transaction_id and such keys, for bills that
    are costly to read twice. Where the bills are a `share` of all by their transaction, the answers are cut down to it
    before they are dealt.
    """
    who = F.coalesce("transaction_id", F.lit(NO_ID)).alias("_who")
    for name, source in SOURCES.items():
        table = tables[source.table].where(F.col(source.key).isNotNull())
        if one_delivery and source.table == "deliveries":
            table = one_per_key(table, [source.key], [F.col("order_id").desc_nulls_last()])
        answer = table.select(source.key, F.struct(*source.fields).alias(name))
        if source.key_may_be_null:
            pairs = (bills if heads is None else heads).where(F.col(source.key).isNotNull()).select(who, source.key).distinct()
            pairs = of_share(pairs, "_who", share)
            bills = bills.select("*", who).join(pairs.join(answer, source.key), ["_who", source.key], "left").drop("_who")
        else:
            bills = bills.join(of_share(answer, source.key, share), source.key, "left")
    return bills


def choices(flip: str | date = IDENTITY_FLIP_DATE) -> dict[str, Column]:
    """Each column from the first answer that has it.

    The customer's id changes its order with the bill's own day, so one job may cover days on both sides of the flip.
    """
    first = lambda column, order: F.coalesce(
        *[F.col(f"{name}.{column}") for name in order], *[F.col(OWN[column]) for _ in range(column in OWN)])
    chosen = {column: first(column, order) for column, order in ORDER.items()}
    flipped = F.col("report_date") > F.lit(str(flip)).cast("date")
    chosen["customer_id"] = F.when(flipped, first("customer_id", EARNED_FIRST)).otherwise(chosen["customer_id"])
    return chosen


def resolved(bills: DataFrame, flip: str | date = IDENTITY_FLIP_DATE) -> DataFrame:
    """One value per column; the answers end here."""
    chosen = choices(flip)
    own = [c for c in bills.columns if c not in chosen and c not in SOURCES]
    return bills.select(*own, *[column.alias(name) for name, column in chosen.items()],
                        *[F.col(f"{source}.{name}") for name, source in SAID.items()],
                        F.col("earned").isNotNull().cast("int").alias("is_passive_capture"),
                        F.lit("").alias("order_cancel_reason"), F.lit("").alias("transaction_7now_source"))
