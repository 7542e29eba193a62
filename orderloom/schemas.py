"""Explicit schemas, keys and enums of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw table columns and types.
RAW_DDL = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string",
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    "order_items": "order_id string, order_item_id bigint, product_id string, seller_id string, "
    "shipping_limit_date timestamp, price decimal(12,2), freight_value decimal(12,2)",
    "order_payments": "order_id string, payment_sequential bigint, payment_type string, "
    "payment_installments bigint, payment_value decimal(12,2)",
    "order_reviews": "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp",
    "products": "product_id string, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g int, product_length_cm int, "
    "product_height_cm int, product_width_cm int",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
    "geolocation_city string, geolocation_state string",
    "product_category_name_translation": "product_category_name string, product_category_name_english string",
}

# Keys and the column that tells which of two equal keys is newer.
KEYS = {
    "customers": (("customer_id",), ()),
    "orders": (("order_id",), ("order_purchase_timestamp",)),
    "order_items": (("order_id", "order_item_id"), ("shipping_limit_date",)),
    "order_payments": (("order_id", "payment_sequential"), ()),
    "order_reviews": (("review_id",), ("review_answer_timestamp",)),
    "products": (("product_id",), ()),
    "sellers": (("seller_id",), ()),
    "product_category_name_translation": (("product_category_name",), ()),
}

# Accepted order states and payment types.
ORDER_STATUS = (
    "approved", "canceled", "created", "delivered", "invoiced", "processing", "shipped", "unavailable",
)
PAYMENT_TYPES = ("boleto", "credit_card", "debit_card", "voucher", "not_defined")


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_DDL[table])
