"""Payment services: documents of two collections to lines, fact and mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillhouse.functions import decode
from tillhouse.functions.contracts import ORDER_INFO, SERVICE_FACT, SERVICE_ITEMS
from tillhouse.functions.nested import read_nested
from tillhouse.functions.types import conform

# Document field -> column, in contract order.
DOCUMENT_FIELDS = {
    "transactionId": "transaction_id", "transactionTime": "transaction_time", "postingTime": "posting_time",
    "storeId": "store_id", "storeName": "store_name", "storeType": "store_type", "movementType": "movement_type",
    "hasInvoice": "has_invoice", "customerAgeRange": "customer_age_range",
    "customerNationality": "customer_nationality", "customerGender": "customer_gender", "edcType": "edc_type",
    "cash": "cash", "serviceName": "service_name", "amountBeforeVat": "amount_before_vat",
    "amountVat": "amount_vat", "totalAmountWithoutPromotion": "total_amount_without_promotion",
    "staffId": "staff_id", "staffName": "staff_name", "posId": "pos_id", "paymentMethod": "payment_method",
    "paymentMethodValue": "payment_method_value",
    "transactionRecordStartTime": "transaction_record_start_time",
    "transactionRecordEndTime": "transaction_record_end_time", "promotionTotalAmount": "promotion_total_amount",
    "totalProductPromotionAmountWithoutTax": "total_product_promotion_amount_without_tax",
    "totalVoucherPromotionAmountWithoutTax": "total_voucher_promotion_amount_without_tax",
    "totalBillPromotionAmountWithoutTax": "total_bill_promotion_amount_without_tax",
    "serviceFee": "service_fee", "customerServiceFee": "customer_service_fee",
    "skipValidateOver50Percent": "skip_validate_over_50_percent", "receivableAmount": "receivable_amount",
    "prePaid": "pre_paid", "syncedSapStatus": "synced_sap_status", "syncedSapTime": "synced_sap_time",
}
ORDER_FIELDS = {
    "orderNo": "order_no", "serviceId": "service_id", "providerId": "provider_id", "customerId": "customer_id",
    "orderType": "order_type",
}
SERVICE_ITEM_FIELDS = {
    "productCode": "product_code", "productName": "product_name", "productUomId": "product_uom_id",
    "supplierCode": "supplier_code", "supplierName": "supplier_name", "quantity": "quantity",
    "purchasePriceWithTax": "purchase_price_with_tax", "purchasePriceWithoutTax": "purchase_price_without_tax",
    "totalAmount": "total_amount", "retailBusinessType": "retail_business_type",
    "commissionOnVnd": "commission_on_vnd", "totalCommission": "total_commission",
}
# The two collections and the name of their item array.
COLLECTIONS = {"pay_bill_transaction": "paybillItems", "top_up_transaction": "topUpItems"}

MART_COLUMNS = ("report_date", "service_name", "provider_id", "order_type", "store_id", "store_name", "staff_id",
                "payment_method", "transaction_id", "product_code", "product_name", "quantity", "total_amount",
                "amount_before_vat", "amount_vat", "total_commission", "commission_on_vnd",
                "purchase_price_with_tax", "purchase_price_without_tax")


def _collection_lines(docs: DataFrame, items_field: str) -> DataFrame:
    typed = docs.withColumns({"_order": read_nested(docs, "orderInfo", ORDER_INFO),
                              "_items": read_nested(docs, items_field, SERVICE_ITEMS)})
    heads = typed.selectExpr(
        *[f"{field} as {name}" for field, name in DOCUMENT_FIELDS.items()],
        *[f"_order.{field} as {name}" for field, name in ORDER_FIELDS.items()],
        "try_cast(skipValidateOver50Percent as int) as skip_validate_over_50_percent_by_int",
        "to_date(transactionTime) as report_date", "_items")
    heads = heads.withColumns(decode.demographics("customer_gender", "customer_age_range", "customer_nationality",
                                                  keep_unknown_age=True))
    head = [c for c in heads.columns if c != "_items"]
    return (heads.selectExpr(*head, "explode_outer(_items) as _item")
            .selectExpr(*head, *[f"_item.{field} as {name}" for field, name in SERVICE_ITEM_FIELDS.items()]))


def service_lines(collections: dict[str, DataFrame]) -> DataFrame:
    """Lines of every collection that is there; unknown age codes pass through."""
    parts = [_collection_lines(docs, COLLECTIONS[name]) for name, docs in collections.items()]
    if not parts:
        raise ValueError("no service collection found")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def service_fact(lines: DataFrame) -> DataFrame:
    return conform(lines, {**SERVICE_FACT, "report_date": "day"})


def service_mart(fact: DataFrame) -> DataFrame:
    return fact.select(*MART_COLUMNS)
