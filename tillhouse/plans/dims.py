"""Stored dimensions: those that keep history are advanced day by day, the others are replaced."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tillhouse.operators.dedup import distinct_rows, one_per_key
from tillhouse.operators.scd import is_versioned
from tillhouse.plans.identity import USER_FIELDS
from tillhouse.sources.sinks import SnapshotTable, advance_dimension


@dataclass(frozen=True)
class Dim:
    """How a dimension comes out of its master: rows that count, a lookup, columns (expressions), one row per key."""

    master: str
    key: str | None = None
    columns: tuple[str, ...] = ("*",)
    where: str = "true"
    lookup: tuple[str, str] | None = None  # a second master, and the column both have
    history: bool = False

    def build(self, landing, master: DataFrame | None = None) -> DataFrame:
        rows = (getattr(landing, self.master)() if master is None else master).where(self.where)
        if self.lookup:
            other, on = self.lookup
            rows = rows.join(getattr(landing, other)(), on, "left")
        rows = rows.selectExpr(*self.columns)
        return one_per_key(rows, [self.key]) if self.key else rows


# The dimensions, and which of them keep history.
DIMS = {
    "dim_product": Dim("product_uom_upc", "product_id", ("* except (product_uom_code)", "product_uom_code as product_uom"),
                       "status = 1 and is_base_unit = 1", history=True),
    "dim_brand": Dim("oms_product", "product_id", ("product_id", "product_brand_name", "product_manufacturer_name")),
    "dim_store": Dim("oms_store", "store_id", ("store_id", "store_name", "store_type", "tier_store", "sale_area_id"),
                     lookup=("dict_stores", "store_id"), history=True),
    "dim_payment": Dim("mapping_payment_method", "payment_method_id"),
    "dim_partner_store": Dim("partner_store", None, ("partner_store_id", "name as partner_store"),
                             lookup=("partner_sources", "partner_source")),
    "dim_customer": Dim("users", None, ("user_id as customer_id", *[f"{field} as {name}" for name, field in USER_FIELDS.items()])),
}
VERSIONED_DIMS = {name: (dim.key,) for name, dim in DIMS.items() if dim.history}


def dimension(name: str, landing, master: DataFrame | None = None) -> DataFrame:
    """A dimension of today's masters, or of a master given instead."""
    return DIMS[name].build(landing, master)


def price_timeline(landing, deal_by: Sequence[str] = ()) -> DataFrame:
    """Effective-dated prices, each range once; ranges of one product may repeat in the master.

    Where each product's ranges are then put in order, they are dealt by its key (`deal_by`) once, for both.
    """
    ranges = landing.purchase_price_timeline()
    return distinct_rows(ranges.repartition(*deal_by) if deal_by else ranges)


class Dimensions:
    """Dimension tables below one folder, each a snapshot table whose next state comes from its current one."""

    def __init__(self, spark: SparkSession, path: str, versioned: Mapping[str, Sequence[str]] = VERSIONED_DIMS):
        self.spark, self.path, self.versioned = spark, path, versioned

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.path}/{name}")

    def advance(self, name: str, incoming: DataFrame, day: str | date) -> DataFrame:
        """The state after a day's master: history where the policy wants it, else the master itself."""
        if name in self.versioned:
            return advance_dimension(self.table(name), incoming, self.versioned[name], day)
        return self.table(name).replace(incoming)

    def read(self, name: str) -> DataFrame:
        found = self.table(name).read()
        if found is None:
            raise ValueError(f"dimension {name} has no state yet")
        if name in self.versioned and not is_versioned(found):
            raise ValueError(f"dimension {name} keeps history, but its state has no versions")
        return found
