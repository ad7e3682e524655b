"""Column types of the raw tables. Timestamps carry no time zone."""

from __future__ import annotations

# Table and column names of the raw data, with their Spark types.
RAW_COLUMNS = {
    "order_items": {
        "order_id": "string",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": "double",
        "freight_value": "double",
    },
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "double",
        "product_description_lenght": "double",
        "product_photos_qty": "double",
    },
    "category_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
    "customers": {
        "customer_id": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    "sellers": {"seller_id": "string"},
    "payments": {"order_id": "string", "payment_type": "string"},
    "reviews": {
        "order_id": "string",
        "review_score": "int",
        "review_comment_message": "string",
    },
}

# Tables the five-join star needs; the others are optional.
STAR_TABLES = (
    "order_items",
    "orders",
    "products",
    "category_translation",
    "customers",
    "sellers",
)
