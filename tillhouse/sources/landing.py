"""The given tables in the shapes the retail sources deliver: bills, deliveries, users, prices, documents.

Only column arithmetic and joins; nothing is invented beyond the given rows. Fixture parameters that stand in
for business constants outside the data's range are listed first.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.calendar import RunWindow
from tillhouse.functions.contracts import NO_ID
from tillhouse.operators.shares import Share, of_share
from tillhouse.operators.skew import running_sums
from tillhouse.session import scratch_path
from tillhouse.sources.sinks import exists, is_file
from tillhouse.sources.tables import between

# Fixed values of the fixture.
FLIP_DATE = "1998-01-01"
STORES_OUT = ("3", "7")
STORE_PREFIX_OUT = "2"
AS_OF = "2024-01-31 00:00:00"
BATCH_BOUND = "2024-01-20"
LIVE_SHIFT_DAYS = 8220  # from the last orders to the events
SNAPSHOT_DAYS = ("1996-01-01", "1997-01-01", "1998-07-01", "2000-01-01")
PRODUCT_DAYS = ("1996-01-01", "1997-07-01", "1999-01-01")
PRICE_YEARS = (1995, 2001)
# Order dates that a run of some business days needs: days before its first moment, days after its last one. A return
# is dated three days after its order, a delivery and a service document within a day, points a day.
Days = tuple[int, int]
SAME_DAYS, COVER, RETURNED, DELIVERED, POINTS, SERVED = (0, 0), (1, 1), (3, -3), (2, 1), (2, 0), (1, 1)
# Lines per document page; a longer bill spans several documents with the same id.
PAGE_LINES = 500

# Parts whose prices one task unfolds.
PRICED_PARTS = 20_000

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate")

# What tells apart the rows of a product that is there more than once, in the order in which items compare.
PRODUCT_ORDER = ("p_name", "p_size", "p_brand", "p_type", "p_retailprice")

# The bill's items, promotions and header as expressions over the given columns.
ITEM = """struct(
    cast(l_partkey as string) as productCode, p_name as productName, 'EA' as uom, cast(p_size as bigint) as uomSize,
    l_quantity as quantity, l_extendedprice as totalAmount, l_extendedprice * (1 - l_tax) as totalAmountWithoutTax,
    l_extendedprice * (1 - l_discount) as totalAmountByPromotion,
    l_extendedprice * (1 - l_discount) * (1 - l_tax) as totalAmountWithoutTaxByPromotion,
    l_discount >= 0.05D as winPromotion,
    cast(substr(p_brand, 7) as bigint) as productGroupId, p_brand as productGroup,
    p_partkey % 12 as productSubCategoryId, concat(p_type, '/', p_partkey % 12) as productSubCategory,
    cast(length(p_type) as bigint) as productCategoryId, p_type as productCategory,
    p_partkey % 4 as productUomId, p_retailprice as retailSellingPrice,
    concat('RBT', p_size % 3) as retailBusinessType,
    cast(null as double) as purchasePriceWithTax, cast(null as double) as purchasePriceWithoutTax,
    concat('V', cast(round(l_tax * 100) as int)) as outputVatCode)"""
PROMOTIONS = """case when o_orderkey % 3 <> 0 then array(
    struct(concat('PR', o_orderkey % 7) as promotionCode, concat('Promo ', o_orderkey % 7) as promotionName,
           5.25D as totalDiscountAmount, o_orderkey % 4 as voucherType,
           case when o_orderkey % 2 = 0 then concat('VC', o_orderkey % 13) end as voucherCode,
           case when o_orderkey % 5 = 0 then '95010032,1' else '1,2' end as products),
    struct(concat('PR', o_orderkey % 5) as promotionCode,
           case when o_orderkey % 4 <> 1 then concat('Promo ', o_orderkey % 5) end as promotionName,
           2.5D as totalDiscountAmount, 0L as voucherType,
           case when o_orderkey % 6 = 4 then concat('VD', o_orderkey % 3) end as voucherCode,
           cast(null as string) as products)) end"""
BILL_ID, RETURN_ID = "concat('T', o_orderkey) as _id", "concat('R', o_orderkey) as _id"
HEADER = (
    "o_orderkey", BILL_ID, "o_orderdate as documentDate",
    "o_orderdate + interval 1 hour as postingDate", "cast(pay_code as bigint) as paymentMethod",
    "delivery_no as deliveryOrderNo", "cast(c_nationkey as string) as storeCode", "n_name as storeName",
    "concat('Type', n_regionkey % 2) as storeType",
    "case when pay_code = 0 then o_totalprice end as cash", "case when pay_code = 2 then o_totalprice end as voucher",
    "case when pay_code = 1 then o_totalprice end as receivableAmount",
    "case when pay_code >= 3 then o_totalprice end as cashAtBank",
    "c_custkey % 3 as customerGender", "cast(c_custkey % 6 as string) as customerAgeRange",
    "cast(c_nationkey % 5 as bigint) as customerNationality",
    "concat('s', o_custkey % 50) as staffId", "concat('Staff ', o_custkey % 50) as staffName",
    "case o_orderkey % 3 when 1 then '' when 2 then concat('V', o_orderkey % 7, ',W', o_orderkey % 5) end"
    " as originalVoucherCode",
)
RETURN_HEADER = (
    "o_orderkey", RETURN_ID, "documentDate + interval 3 days as documentDate",
    "postingDate + interval 3 days as postingDate", "paymentMethod", "cast(null as string) as deliveryOrderNo",
    "storeCode", "storeName", "storeType", "cash", "voucher", "receivableAmount", "cashAtBank",
    "concat('SUP', o_orderkey % 9) as supplierCode", "concat('Supplier ', o_orderkey % 9) as supplierName",
    "_id as customerNote",
)
SERVICE_ITEM = """cast(l_partkey as string) as productCode, concat('Service ', l_partkey % 20) as productName,
    cast(l_partkey % 4 as string) as productUomId, cast(l_suppkey as string) as supplierCode,
    concat('Supplier ', l_suppkey) as supplierName, cast(l_quantity as bigint) as quantity,
    l_extendedprice as totalAmount, concat('RBT', l_partkey % 3) as retailBusinessType,
    l_discount * 100 as commissionOnVnd, l_extendedprice * l_discount as totalCommission"""
SERVICE_COST = """l_extendedprice * 0.7D as purchasePriceWithTax, l_extendedprice * 0.63D as purchasePriceWithoutTax"""
SERVICE_HEADER = (
    "concat('S', o_orderkey, '-', translate(serviceName, ' ', '')) as transactionId",
    "o_orderdate + make_interval(0, 0, 0, 0, cast(o_orderkey % 24 as int)) as transactionTime",
    "o_orderdate + make_interval(0, 0, 0, 0, cast(o_orderkey % 24 + 1 as int)) as postingTime",
    "cast(c_nationkey as string) as storeId", "n_name as storeName", "concat('Type', n_regionkey % 2) as storeType",
    "o_orderkey % 3 as movementType", "cast(o_orderkey % 2 as int) as hasInvoice",
    "cast(c_custkey % 6 as string) as customerAgeRange", "cast(c_nationkey % 5 as string) as customerNationality",
    "c_custkey % 3 as customerGender", "o_orderkey % 4 as edcType", "o_totalprice as cash", "serviceName",
    "o_totalprice * 0.9D as amountBeforeVat", "o_totalprice * 0.1D as amountVat",
    "o_totalprice as totalAmountWithoutPromotion", "concat('s', o_custkey % 50) as staffId",
    "concat('Staff ', o_custkey % 50) as staffName", "concat('pos', o_orderkey % 7) as posId",
    "cast(pay_code as bigint) as paymentMethod", "o_totalprice as paymentMethodValue",
    "o_orderdate as transactionRecordStartTime", "o_orderdate as transactionRecordEndTime",
    "cast(null as double) as promotionTotalAmount", "cast(null as double) as totalProductPromotionAmountWithoutTax",
    "cast(null as double) as totalVoucherPromotionAmountWithoutTax",
    "cast(null as double) as totalBillPromotionAmountWithoutTax",
    "o_orderkey % 10 as serviceFee", "o_orderkey % 5 as customerServiceFee",
    "o_orderkey % 2 = 0 as skipValidateOver50Percent", "o_totalprice as receivableAmount",
    "o_orderkey % 5 = 0 as prePaid", "case when o_orderkey % 9 <> 0 then 'done' end as syncedSapStatus",
    "case when o_orderkey % 9 <> 0 then o_orderdate end as syncedSapTime",
)
SERVICE_ORDER = """concat('SO-', o_orderkey) as orderNo, concat('prov', o_orderkey % 3) as providerId,
    concat('type', o_orderkey % 2) as orderType"""
PAY_BILL_ORDER = "concat('svc', o_orderkey % 4) as serviceId, cast(c_custkey as string) as customerId"
PRODUCT = (
    "cast(p_partkey as string) as product_id", "case when p_partkey % 17 = 0 then 0 else 1 end as status", "is_base_unit",
    "case when is_base_unit = 1 then 'EA' else 'BOX' end as product_uom_code", "p_name as product_name",
    "cast(p_size as bigint) as product_uom_size", "p_partkey % 4 as product_uom_id",
    "cast(substr(p_brand, 7) as bigint) as product_group_id", "p_brand as product_group_name",
    "cast(length(p_type) as bigint) as product_category_id", "p_type as product_category_name",
    "p_partkey % 12 as product_sub_category_id", "concat(p_type, '/', p_partkey % 12) as product_sub_category_name",
    "concat('RBT', p_size % 3) as retail_business_type",
)

_schemas: dict[tuple[str, str], T.StructType] = {}
# Children filed by the months of their orders, once per application and input folder.
_filed: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip("/")}/{name}.parquet"


def _key(keyed: bool, name: str = "_id") -> str:
    return f"{name} as _id" if keyed else f"nullif({name}, '\\0') as _id"


class Landing:
    """Bronze-shaped frames over one folder of given tables: all of them, or what a run's window may need.

    In a run every dated source is read between two moments, given by how far its own timestamp lies from the business
    days of what depends on it, on the bare column, so that the bound reaches the scan. What has no date of its own is
    read for the parents that are in the window. Masters are read whole. For many runs in one application, such children
    are `filed`: laid down by the months of their orders once, so that a run reads and deals those of its months only.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, window: RunWindow | None = None, filed: bool = False):
        self.spark, self.sf_dir, self.window, self.filed = spark, sf_dir, window, filed
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A given table. Its schema is read from the footer once per application."""
        if name not in self._read:
            path = table_path(self.sf_dir, name)
            key = (self.spark.sparkContext.applicationId, path)
            reader = self.spark.read if key not in _schemas else self.spark.read.schema(_schemas[key])
            self._read[name] = reader.parquet(path)
            _schemas[key] = self._read[name].schema
        return self._read[name]

    def covered(self, df: DataFrame, ts: str) -> DataFrame:
        """What was written in the run's cover window, by a derived timestamp."""
        return df if self.window is None else between(df, ts, self.window.cover_lo, self.window.cover_hi)

    def of_orders(self, name: str, key: str, days: Days) -> DataFrame:
        """Children of the orders in the window, so many days around it."""
        child = self.raw(name)
        if self.window is None:
            return child
        if self.filed:
            before, after = (timedelta(days=n) for n in days)
            child = self._of_months(name, key, f"{self.window.utc_lo - before:%Y-%m}", f"{self.window.utc_hi + after:%Y-%m}")
        parents = self.dated_orders(days).select(F.col("o_orderkey").alias("_parent"))
        return child.join(parents, F.col(key) == F.col("_parent"), "left_semi")

    def _of_months(self, name: str, key: str, first: str, last: str) -> DataFrame:
        """Children whose order is dated in some months. One whose key has orders in several months lies in each of
        them, and is taken from the first that is asked for."""
        child = self.raw(name)
        at = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if at not in _filed or not exists(self.spark, f"{_filed[at][0]}/_SUCCESS"):
            months = (self.raw("orders").where("o_orderdate is not null").groupBy("o_orderkey")
                      .agg(F.collect_set(F.date_format("o_orderdate", "yyyy-MM")).alias("_months")))
            filed = child.join(months, F.col(key) == F.col("o_orderkey")).drop("o_orderkey")
            filed = filed.withColumn("_month", F.explode("_months"))
            path = scratch_path(self.spark, f"{name}-by-month")
            filed.hint("rebalance", "_month").write.partitionBy("_month").parquet(path)
            _filed[at] = path, filed.schema
        path, schema = _filed[at]
        asked = lambda month: (month >= first) & (month <= last)
        rows = self.spark.read.schema(schema).parquet(path).where(asked(F.col("_month")))
        return rows.where(F.col("_month") == F.array_min(F.filter("_months", asked))).select(*child.columns)

    # ---- bills ------------------------------------------------------------------------------------
    def dated_orders(self, days: Days = SAME_DAYS) -> DataFrame:
        """Orders as given, dated from so many days before the run's first moment to so many after its last."""
        raw = self.raw("orders")
        if self.window is None:
            return raw
        before, after = (timedelta(days=n) for n in days)
        return between(raw, "o_orderdate", self.window.utc_lo - before, self.window.utc_hi + after)

    def orders(self, days: Days = SAME_DAYS) -> DataFrame:
        return self.dated_orders(days).selectExpr(
            "*", "cast(substr(o_orderpriority, 1, 1) as int) - 1 as pay_code", "o_orderkey % 4 = 0 as is_delivery",
            """case when o_orderkey % 16 = 0 then concat('SAVYU-', o_orderkey)
                    when o_orderkey % 8 = 0 then concat('DO-', o_orderkey) end as delivery_no""")

    def billed_orders(self, days: Days = SAME_DAYS) -> DataFrame:
        """Every order except deliveries still open, which surface as canceled orders."""
        return self.orders(days).where("not (is_delivery and o_orderstatus = 'O')")

    def _with_store(self, orders: DataFrame) -> DataFrame:
        stores = self.raw("customer").join(self.raw("nation"), F.expr("c_nationkey = n_nationkey"), "left")
        return orders.join(stores, F.expr("o_custkey = c_custkey"), "left")

    def _pages(self, lines: DataFrame, keys: list[str], item: str, name: str) -> DataFrame:
        """Lines as item arrays per key, in line order, in pages of PAGE_LINES: no array grows without bound. They are
        dealt by the first key, an order's."""
        placed = running_sums(self._of_orders(lines), keys, LINE_ORDER, before="line_no", deal_by=keys[:1])
        return self._gather_pages(placed, keys, item, name)

    @staticmethod
    def _of_orders(lines: DataFrame) -> DataFrame:
        """Lines that name their order, which Spark then knows: they are dealt by it once, up to the bill."""
        return lines.where("l_orderkey is not null").withColumn("l_orderkey", F.coalesce("l_orderkey", F.lit(0)))

    @staticmethod
    def _gather_pages(placed: DataFrame, keys: list[str], item: str, name: str) -> DataFrame:
        return (placed.selectExpr(*keys, f"line_no div {PAGE_LINES} as doc_page", f"struct(line_no, {item} as item) as entry")
                .groupBy(*keys, "doc_page").agg(F.expr(f"array_sort(collect_list(entry)).item as {name}")))

    def _sale_items(self, lines: DataFrame, document: str, share: Share | None = None) -> DataFrame:
        """Items by document id. Their product is looked up first: after that lines are dealt by the document's id once,
        for their numbers, their pages, their header and the numbers of the bill's documents."""
        known = self._of_orders(lines).join(self.raw("part"), F.expr("l_partkey = p_partkey"), "left")
        known = of_share(known.withColumn("_id", F.concat(F.lit(document), "l_orderkey")).drop("l_orderkey"), "_id", share)
        placed = running_sums(known, ["_id"], (*LINE_ORDER, *PRODUCT_ORDER), before="line_no")
        return self._gather_pages(placed, ["_id"], ITEM, "saleNormalItems")

    def _documents(self, orders: DataFrame, items: DataFrame, document: str, how: str, share: Share | None = None) -> DataFrame:
        """Orders, their stores and their items; header columns are made of them once they have met. Without an order
        number the id is NO_ID."""
        key = F.coalesce(F.concat(F.lit(document), "o_orderkey"), F.lit(NO_ID))
        return of_share(self._with_store(orders).withColumn("_id", key), "_id", share).join(items, "_id", how)

    def _bill_header(self, days: Days = SAME_DAYS) -> DataFrame:
        return self._with_store(self.billed_orders(days)).selectExpr(*HEADER)

    def _lines(self, days: Days = SAME_DAYS) -> DataFrame:
        return self.of_orders("lineitem", "l_orderkey", days)

    def bill_heads(self, days: Days = SAME_DAYS) -> DataFrame:
        """The bills without their items, for what needs bill-level fields only."""
        return self._bill_header(days).drop("o_orderkey")

    def return_heads(self, days: Days = RETURNED) -> DataFrame:
        """The return bills without their items: orders with a returned line."""
        returned = self._lines(days).where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
        return self._bill_header(days).selectExpr(*RETURN_HEADER).join(returned, "o_orderkey", "left_semi").drop("o_orderkey")

    def bill_promotions(self) -> DataFrame:
        """Ids and promotions of the bills; no line is read for it."""
        return self.billed_orders().selectExpr("concat('T', o_orderkey) as _id", f"{PROMOTIONS} as transactionPromotions")

    def sale_bill(self, keyed: bool = False, share: Share | None = None) -> DataFrame:
        """The bills; `keyed` ones have NO_ID for a missing id, so that what they were dealt by stays known. A `share` of
        them are those whose keyed id is in it."""
        bills = self._documents(self.billed_orders(), self._sale_items(self._lines(), "T", share), "T", "left", share)
        header = [_key(keyed) if c == BILL_ID else c for c in HEADER if c != "o_orderkey"]
        return bills.selectExpr(*header, "saleNormalItems", "coalesce(doc_page, 0L) as doc_page",
                                f"case when coalesce(doc_page, 0L) = 0 then {PROMOTIONS} end as transactionPromotions")

    def sale_return_bill(self, keyed: bool = False, share: Share | None = None) -> DataFrame:
        returned = self._sale_items(self._lines(RETURNED).where("l_returnflag = 'R'"), "R", share)
        bills = self._documents(self.billed_orders(RETURNED), returned, "R", "inner", share)
        bills = bills.withColumnRenamed("_id", "_key").selectExpr(*HEADER, "_key", "doc_page", "saleNormalItems")
        header = [_key(keyed, "_key") if c == RETURN_ID else c for c in RETURN_HEADER if c != "o_orderkey"]
        return bills.selectExpr(*header, "doc_page", "saleNormalItems")

    # ---- relational sources -----------------------------------------------------------------------
    def delivery_orders(self) -> DataFrame:
        """A tenth of the deliveries has a second row under its own order id; a third is anonymous."""
        orders = self.orders(DELIVERED).where("is_delivery").join(
            self.raw("customer").select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"), "left")
        copies = orders.selectExpr(
            "*", "explode(case when o_orderkey % 40 = 0 then array(0L, 1000000000L) else array(0L) end) as shift")
        return self.covered(copies.selectExpr(
            "o_orderkey + shift as order_id", "concat('T', o_orderkey) as transaction_no",
            "case when o_orderkey % 12 <> 0 then o_custkey end as user_id",
            "case o_orderkey % 5 when 0 then 'GrabFood' when 1 then '' end as external_source",
            "o_orderdate + make_interval(0, 0, 0, 0, cast(o_orderkey % 24 as int)) as created_at",
            "concat('P', o_orderkey) as partner_order_no", "cast(c_nationkey % 6 as string) as partner_store_id",
            "concat('X', o_orderkey) as external_order_id", "concat('note ', o_orderkey % 9) as delivery_note",
            "delivery_no as order_no", "cast(case o_orderstatus when 'F' then 8 when 'P' then 7 else 5 end as bigint) as status",
            "o_totalprice as total_price_amount", "cast(pay_code as bigint) as payment_method",
            "case when o_orderstatus = 'O' then concat('reason ', o_orderkey % 3) else '' end as canceled_reason"), "created_at")

    def delivery_order_details(self) -> DataFrame:
        details = self.of_orders("lineitem", "l_orderkey", DELIVERED)
        return details.where("l_orderkey % 4 = 0").selectExpr(
            "l_orderkey as order_id", "cast(l_partkey as string) as product_id",
            "case when l_orderkey % 5 <> 0 then l_linenumber % 2 end as put_in_cart_order")

    def delivery_order_audits(self) -> DataFrame:
        audits = self.of_orders("events", "user_id", DELIVERED)
        return audits.selectExpr(
            "user_id as order_id", """cast(case event_type when 'signup' then 1 when 'error' then 5 when 'click' then 6
                                      when 'view' then 7 when 'purchase' then 8 end as bigint) as status""",
            "ts as created_at")

    def users(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey as user_id", "concat('09', lpad(cast(c_custkey as string), 8, '0')) as phone", "c_name as full_name",
            "case when c_custkey % 4 <> 0 then concat('C', c_custkey) else '' end as customer_code")

    def sale_transactions(self) -> DataFrame:
        return self.dated_orders(COVER).where("o_orderkey % 2 = 0").selectExpr(
            "concat('T', o_orderkey) as transaction_id", "o_custkey + 1 as user_id", "o_orderdate as created_at",
            "cast(1 + o_orderkey % 5 as int) as rating", "concat('comment ', o_orderkey % 11) as comment")

    def point_histories(self) -> DataFrame:
        audit = lambda captured, who: f"struct('{captured}' as is_captured, '{who}' as user_type)"
        return self.covered(self.dated_orders(POINTS).where("o_orderkey % 3 = 0").selectExpr(
            "concat('T', o_orderkey) as reference_id", "o_custkey + 2 as user_id", "o_orderdate + interval 1 day as created_at",
            f"""case when o_orderkey % 15 = 0 then null
                     when o_orderkey % 9 = 0 then cast(array() as array<struct<is_captured:string,user_type:string>>)
                     when o_orderkey % 2 = 0 then array({audit('true', 'CASHIER')}, {audit('false', 'APP')})
                     else array({audit('false', 'CASHIER')}, {audit('true', 'APP')}) end as action_audits"""), "created_at")

    def partner_store(self) -> DataFrame:
        return self.raw("nation").where("n_nationkey < 6").selectExpr(
            "cast(n_nationkey as string) as partner_store_id", "cast(n_nationkey % 3 as string) as partner_source")

    def partner_sources(self) -> DataFrame:
        return self.raw("region").where("r_regionkey < 2").selectExpr(
            "cast(r_regionkey as string) as partner_source", "r_name as name")

    # ---- dimensions -------------------------------------------------------------------------------
    def product_uom_upc(self) -> DataFrame:
        units = "explode(case when p_partkey % 3 = 0 then array(1, 0) else array(1) end) as is_base_unit"
        return self.raw("part").selectExpr("*", units).selectExpr(*PRODUCT)

    def product_snapshot(self, nth: int) -> DataFrame:
        """The product master as read on one of three days: groups move, products appear and disappear, and the
        second one has a column that the others lack."""
        master = self.raw("part").selectExpr("*", "explode(case when p_partkey % 3 = 0 then array(1, 0) else array(1) end) as is_base_unit")
        if nth < 1:
            master = master.where("p_partkey % 13 <> 0")
        if nth == 2:
            master = master.where("p_partkey % 19 <> 0")
        renamed = (f"concat(product_group_name, if({nth} >= 1 and cast(product_id as long) % 5 = 1, ' new', ''), "
                   f"if({nth} >= 2 and cast(product_id as long) % 10 = 1, ' newer', '')) as product_group_name")
        shaped = master.selectExpr(*PRODUCT, *(["p_size % 7 as shelf"] if nth == 1 else []))
        return shaped.selectExpr(*[renamed if c == "product_group_name" else c for c in shaped.columns])

    def oms_product(self) -> DataFrame:
        copies = "explode(case when p_partkey % 50 = 0 then array(1, 2) else array(1) end) as copy"
        return self.raw("part").selectExpr("*", copies).selectExpr(
            "cast(p_partkey as string) as product_id", "p_brand as product_brand_name",
            "concat('Maker ', p_size % 5) as product_manufacturer_name")

    def oms_store(self) -> DataFrame:
        return self.raw("nation").selectExpr("cast(n_nationkey as string) as store_id", "n_name as store_name",
                                             "concat('Type', n_regionkey % 2) as store_type")

    def dict_stores(self) -> DataFrame:
        return self.raw("nation").where("n_nationkey <> 11").selectExpr(
            "cast(n_nationkey as string) as store_id", "concat('T', n_nationkey % 3) as tier_store",
            "cast(n_regionkey as int) as sale_area_id")

    def mapping_payment_method(self) -> DataFrame:
        return Landing(self.spark, self.sf_dir).orders().selectExpr("cast(pay_code as bigint) as payment_method_id",
                                        "concat('Pay supplier ', pay_code) as payment_supplier_name").distinct()

    def purchase_price_timeline(self) -> DataFrame:
        first, last = PRICE_YEARS
        cost = f"p_retailprice * 0.7D * (1 + 0.01D * (year - {first}))"
        parts = self.raw("part").where("p_partkey % 10 <> 0").select("p_partkey", "p_retailprice")
        # one part is many rows: few parts a task, or a small file's only task would hold the whole timeline
        parts = parts.repartition(parts.count() // PRICED_PARTS + 1)
        return (parts.selectExpr("p_partkey", "p_retailprice", "explode(sequence(0, 4)) as sale_area_id")
                .selectExpr("*", f"explode(sequence({first}, {last})) as year")
                .where("not (p_partkey % 7 = 0 and year >= 2000)")
                .selectExpr("cast(p_partkey as string) as product_id", "sale_area_id",
                            "cast(make_date(year, 1, 1) as timestamp_ntz) as purchase_price_effective_date",
                            "cast(make_date(year + 1, 1, 1) as timestamp_ntz) as next_purchase_price_effective_date",
                            f"{cost} * 1.1D as purchase_price_with_tax", f"{cost} as purchase_price_without_tax"))

    def store_snapshots(self) -> DataFrame:
        """The store master as read on four days: tiers move, one store appears, one disappears."""
        days = ", ".join(f"'{d}'" for d in SNAPSHOT_DAYS)
        return (self.raw("nation").selectExpr("*", f"posexplode(array({days})) as (snap, day)")
                .where("not (n_nationkey = 3 and snap = 3) and not (n_nationkey = 5 and snap < 1)")
                .selectExpr("cast(n_nationkey as string) as store_id", "n_name as store_name",
                            "case when not (n_nationkey = 7 and snap = 1) then cast((n_nationkey + snap) div 10 as int) end as tier",
                            """cast(case when n_nationkey = 11 and snap >= 2 then (n_regionkey + 1) % 5 else n_regionkey end
                               as int) as sale_area_id""", "cast(day as date) as snapshot_day"))

    # ---- payment services -------------------------------------------------------------------------
    def _service_docs(self, status: str, kind: str, item: str, order: str, items_field: str) -> DataFrame:
        sold = self._lines(SERVED).where(F.col("l_linestatus") == status).selectExpr("*", f"{kind} as serviceName")
        docs = self._pages(sold, ["l_orderkey", "serviceName"], f"struct({item})", items_field)
        # the store is looked up for the order, before the items are with it
        whole = docs.join(self._with_store(self.orders(SERVED)), F.expr("l_orderkey = o_orderkey"))
        return whole.selectExpr(*SERVICE_HEADER, f"struct({order}) as orderInfo", items_field)

    def pay_bill_transaction(self) -> DataFrame:
        return self._service_docs("F", "'Pay Bill'", SERVICE_ITEM, f"{SERVICE_ORDER}, {PAY_BILL_ORDER}", "paybillItems")

    def top_up_transaction(self) -> DataFrame:
        kind = "case when l_partkey % 2 = 0 then 'Top Up' else 'Pay Card' end"
        return self._service_docs("O", kind, f"{SERVICE_ITEM}, {SERVICE_COST}", SERVICE_ORDER, "topUpItems")

    # ---- event stream -----------------------------------------------------------------------------
    def event_stream(self) -> DataFrame:
        """The events as a file stream; one file or a folder of files."""
        path = table_path(self.sf_dir, "events")
        reader = self.spark.readStream.schema(self.raw("events").schema)
        if is_file(self.spark, path):
            return reader.option("pathGlobFilter", path.rpartition("/")[2]).parquet(self.sf_dir)
        return reader.parquet(path)


# The message of one sale, as an expression over an event.
MESSAGE = """to_json(struct(
    case when event_type = 'purchase' then 'SALE_TRANSACTION' else upper(event_type) end as stream_type, 'POS' as source,
    struct(cast(user_id % 20 as string) as store_code, concat('Store ', user_id % 20) as store_name,
        array(struct(
            concat('E', event_id) as transaction_id, concat('s', event_id % 30) as staff_id,
            concat('Staff ', event_id % 30) as staff_name, sent_ms as document_date, sent_ms + 1000 as posting_date,
            event_id % 5 as payment_method, price as total_amount, event_id % 3 as customer_gender,
            case when event_id % 90 <> 0 then array(struct(
                cast(event_id % 40 as string) as product_code, concat('Item ', event_id % 40) as product_name, 'EA' as uom,
                case when event_id % 70 <> 0 then event_id % 4 end as product_uom_id, 1L as uom_size,
                1 + event_id % 3 as quantity, price as retail_selling_price, price as total_amount,
                price * 0.9D as total_amount_without_tax, price * 0.7D as purchase_price_with_tax,
                price * 0.63D as purchase_price_without_tax,
                event_id % 10 as product_group_id, concat('Group ', event_id % 10) as product_group,
                event_id % 20 as product_sub_category_id, concat('Sub ', event_id % 20) as product_sub_category,
                event_id % 5 as product_category_id, concat('Category ', event_id % 5) as product_category,
                concat('RBT', event_id % 3) as retail_business_type, concat('SUP', event_id % 6) as supplier_code,
                concat('Supplier ', event_id % 6) as supplier_name)) end as sale_normal_items)) as sale_transaction)
    as payload)) as value"""


def stream_values(events: DataFrame) -> DataFrame:
    """Events as message text: purchases are sale envelopes, all other types are noise on the same topic.

    Every 50th event is sent again a minute later with a corrected amount, every 70th has no unit id, every
    90th has no items.
    """
    sent = events.selectExpr("*", "explode(case when event_id % 50 = 0 then array(0, 1) else array(0) end) as again")
    return sent.selectExpr(
        "event_id", "user_id", "event_type", "value + again as price",
        "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) + again * 60000 as sent_ms").selectExpr(MESSAGE)
