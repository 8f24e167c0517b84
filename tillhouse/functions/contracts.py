"""Column contracts, nested document types and code tables.

Everything in this module is a FIXED VALUE of the data contract: names, order, type tokens, codes and
labels are what upstream systems send and downstream readers expect.
"""

from __future__ import annotations

# ---- fixed values: product fact, one row per bill line -------------------------------------------
PRODUCT_FACT = {
    "transaction_id": "str",
    "product_id": "str",
    "report_date": "date",
    "transaction_time": "date",
    "product_name": "str",
    "product_uom": "str",
    "product_group_id": "int",
    "product_group_name": "str",
    "product_sub_category_id": "int",
    "product_sub_category_name": "str",
    "product_category_id": "int",
    "product_category_name": "str",
    "product_price": "float",
    "product_brand_name": "str",
    "product_manufacturer_name": "str",
    "retail_business_type": "str",
    "store_id": "str",
    "store_name": "str",
    "store_type": "str",
    "supplier_id": "str",
    "supplier_name": "str",
    "product_uom_size": "int",
    "quantity": "int",
    "total_amount_no_tax": "float",
    "total_amount": "float",
    "final_amount_no_tax": "float",
    "final_amount": "float",
    "row_num_transaction_id": "int",
    "sale_bill_time": "date",
    "posting_time": "date",
    "staff_id": "str",
    "staff_name": "str",
    "payment_method_id": "int",
    "payment_method_name": "str",
    "payment_supplier_id": "int",
    "payment_supplier_name": "str",
    "is_passive_capture": "int",
    "order_no": "str",
    "bill_amount": "float",
    "voucher_amount": "float",
    "customer_id": "int",
    "customer_phone": "str",
    "external_order_id": "str",
    "dom_created_at": "date",
    "partner_store": "str",
    "user_name": "str",
    "customer_code": "str",
    "channel_name": "str",
    "rating": "int",
    "comment": "str",
    "problem_label_by_llm": "str",
    "delivery_created_time": "date",
    "delivery_driver_booked_time": "date",
    "delivery_picked_time": "date",
    "delivery_canceled_time": "date",
    "delivery_completed_time": "date",
    "delivery_status": "str",
    "delivery_partial_completed_time": "date",
    "delivery_store_delivered_time": "date",
    "order_id": "int",
    "purchase_price_without_tax": "float",
    "purchase_price_with_tax": "float",
    "order_cancel_reason": "str",
    "promotion_id_arr": "list",
    "promotion_name_arr": "list",
    "voucher_code_arr": "list",
    "voucher_name_arr": "list",
    "number_of_line_item": "int",
    "total_voucher_amount": "float",
    "capture_method": "str",
    "customer_gender": "str",
    "customer_age_range": "str",
    "customer_nationality": "str",
    "synced_sap_time": "date",
    "refund_transaction_id": "str",
    "product_uom_id": "int",
    "transaction_type": "str",
    "delivery_note": "str",
    "short_order_id": "str",
    "output_vat_code": "str",
    "transaction_7now_source": "str",
    "put_in_cart_order": "int",
    "feedback_at": "date",
}

# ---- fixed values: payment-service fact, one row per service item --------------------------------
SERVICE_FACT = {
    "report_date": "date",
    "transaction_id": "str",
    "transaction_time": "date",
    "posting_time": "date",
    "store_id": "str",
    "store_name": "str",
    "movement_type": "int",
    "has_invoice": "bool",
    "customer_age_range": "str",
    "customer_nationality": "str",
    "customer_gender": "str",
    "edc_type": "int",
    "cash": "int",
    "store_type": "str",
    "service_name": "str",
    "amount_before_vat": "int",
    "amount_vat": "int",
    "total_amount_without_promotion": "int",
    "staff_id": "str",
    "staff_name": "str",
    "pos_id": "str",
    "payment_method": "int",
    "payment_method_value": "int",
    "transaction_record_start_time": "date",
    "transaction_record_end_time": "date",
    "promotion_total_amount": "int",
    "total_product_promotion_amount_without_tax": "int",
    "total_voucher_promotion_amount_without_tax": "int",
    "total_bill_promotion_amount_without_tax": "int",
    "service_fee": "int",
    "customer_service_fee": "int",
    "skip_validate_over_50_percent": "bool",
    "skip_validate_over_50_percent_by_int": "int",
    "receivable_amount": "int",
    "pre_paid": "bool",
    "synced_sap_status": "str",
    "synced_sap_time": "date",
    "order_no": "str",
    "service_id": "str",
    "provider_id": "str",
    "customer_id": "str",
    "order_type": "str",
    "product_code": "str",
    "product_name": "str",
    "product_uom_id": "str",
    "supplier_code": "str",
    "supplier_name": "str",
    "quantity": "int",
    "purchase_price_with_tax": "int",
    "purchase_price_without_tax": "int",
    "total_amount": "int",
    "retail_business_type": "str",
    "commission_on_vnd": "int",
    "total_commission": "int",
}

# ---- fixed values: nested document types ----------------------------------------------------------
SALE_ITEMS = """array<struct<
    productCode: string, productName: string, uom: string, uomSize: bigint, quantity: double,
    totalAmount: double, totalAmountWithoutTax: double,
    totalAmountByPromotion: double, totalAmountWithoutTaxByPromotion: double, winPromotion: boolean,
    productGroupId: bigint, productGroup: string,
    productSubCategoryId: bigint, productSubCategory: string,
    productCategoryId: bigint, productCategory: string,
    productUomId: bigint, retailSellingPrice: double, retailBusinessType: string,
    purchasePriceWithTax: double, purchasePriceWithoutTax: double, outputVatCode: string>>"""

PROMOTIONS = """array<struct<
    promotionCode: string, promotionName: string, totalDiscountAmount: double,
    voucherType: bigint, voucherCode: string, products: string>>"""

ACTION_AUDITS = "array<struct<is_captured: string, user_type: string>>"

SERVICE_ITEMS = """array<struct<
    productCode: string, productName: string, productUomId: string,
    supplierCode: string, supplierName: string, quantity: bigint,
    purchasePriceWithTax: double, purchasePriceWithoutTax: double, totalAmount: double,
    retailBusinessType: string, commissionOnVnd: double, totalCommission: double>>"""

ORDER_INFO = """struct<
    orderNo: string, serviceId: string, providerId: string, customerId: string, orderType: string>"""

STREAM_ENVELOPE = """struct<
    stream_type: string, source: string,
    payload: struct<
        store_code: string, store_name: string,
        sale_transaction: array<struct<
            transaction_id: string, staff_id: string, staff_name: string,
            document_date: bigint, posting_date: bigint, payment_method: bigint,
            total_amount: double, customer_gender: bigint,
            sale_normal_items: array<struct<
                product_code: string, product_name: string, uom: string, product_uom_id: bigint,
                uom_size: bigint, quantity: bigint, retail_selling_price: double,
                total_amount: double, total_amount_without_tax: double,
                purchase_price_with_tax: double, purchase_price_without_tax: double,
                product_group_id: bigint, product_group: string,
                product_sub_category_id: bigint, product_sub_category: string,
                product_category_id: bigint, product_category: string,
                retail_business_type: string, supplier_code: string, supplier_name: string>>>>>>"""

# ---- fixed values: columns of the realtime fact ---------------------------------------------------
LIVE_FACT = {
    "transaction_id": "str",
    "product_id": "str",
    "report_date": "day",
    "transaction_time": "date",
    "sale_bill_time": "date",
    "posting_time": "date",
    "store_id": "str",
    "store_name": "str",
    "staff_id": "str",
    "staff_name": "str",
    "payment_method_id": "int",
    "product_name": "str",
    "product_uom": "str",
    "product_uom_id": "int",
    "product_group_id": "int",
    "product_group_name": "str",
    "product_sub_category_id": "int",
    "product_sub_category_name": "str",
    "product_category_id": "int",
    "product_category_name": "str",
    "retail_business_type": "str",
    "supplier_id": "str",
    "supplier_name": "str",
    "product_uom_size": "int",
    "quantity": "int",
    "product_price": "float",
    "total_amount": "float",
    "total_amount_no_tax": "float",
    "final_amount": "float",
    "final_amount_no_tax": "float",
    "purchase_price_with_tax": "float",
    "purchase_price_without_tax": "float",
    "customer_gender": "str",
    "transaction_type": "str",
    "delivery_status": "str",
}

LIVE_KEY = ("transaction_id", "product_id", "product_uom_id")

LIVE_MART_COLUMNS = (
    "transaction_id", "product_id", "report_date", "transaction_time", "source", "store_id", "store_name",
    "staff_id", "payment_method_id", "product_name", "product_group_name", "product_category_name",
    "retail_business_type", "quantity", "product_price", "total_amount", "total_amount_no_tax",
    "final_amount", "customer_gender",
)

# ---- fixed values: code tables --------------------------------------------------------------------
GENDER = {"1": "Male", "2": "Female"}
AGE_RANGE = {"2": "Student", "3": "Middle", "5": "Foreigner"}
NATIONALITY = {"0": "Vietnamese", "1": "Asian", "2": "US_UK", "3": "Other"}
PAYMENT_METHOD = {"0": "cash", "1": "card", "2": "voucher", "4": "e-wallet"}
KNOWN_SERVICES = ("Pay Bill", "Pay Card", "Top Up")
VOUCHER_PRODUCT = "95010032"

COMPLETED, CANCELED = 8, (5, 13)
STATUS_TIMES = {
    1: "delivery_created_time",
    5: "delivery_canceled_time",
    6: "delivery_driver_booked_time",
    7: "delivery_picked_time",
    8: "delivery_completed_time",
    12: "delivery_store_delivered_time",
    13: "delivery_partial_completed_time",
}

DAYPARTS = (
    (6, 10, "1 Morning (06-10)"),
    (11, 13, "2 Lunch (11-13)"),
    (14, 16, "3 Afternoon (14-16)"),
    (17, 21, "4 Evening (17-21)"),
)
NIGHT = "5 Night (22-05)"

# ---- fixed values: business parameters ------------------------------------------------------------
LOCAL_OFFSET_HOURS = 7
NO_ID = "\0"  # stands for a missing transaction id where rows are dealt by it; no document has it
IDENTITY_FLIP_DATE = "2022-04-01"
EXCLUDED_STORES = ("1000", "1004")
EXCLUDED_STORE_PREFIX = "19"
NO_FEEDBACK = "1971-01-01 00:00:00"
START_OF_TIME = "1970-01-01 00:00:00"
END_OF_TIME = "9999-12-31 00:00:00"
RETENTION_HOURS = 72
LIVE_MART_DAYS = 7
BASELINE_TOLERANCE = 10
FAILED_RUN_HOURS = 26
