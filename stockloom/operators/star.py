"""The five-join star: one row per order line with product, customer and seller columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions.calendar import TIMESTAMP_LAYOUT, lenient_timestamp

# Column names of the raw tables.
LIFECYCLE_COLUMNS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "shipping_limit_date",
)

# Columns dropped from the line table once the category is resolved.
DESCRIPTIVE_COLUMNS = (
    "product_category_name",
    "product_category_name_english",
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
)


def parse_timestamps(
    df: DataFrame,
    columns: tuple[str, ...] = LIFECYCLE_COLUMNS,
    layout: str = TIMESTAMP_LAYOUT,
    strict: tuple[str, ...] = (),
) -> DataFrame:
    """Turn text columns into timestamps. Other types are left alone.

    ``layout`` is the pattern that texts must match. Bad values become null, but in a
    column named in ``strict`` they end the job with an error.
    """
    text = {name for name, kind in df.dtypes if kind == "string"}
    parsed = {}
    for name in columns:
        if name in text:
            value = lenient_timestamp(F.col(name), layout)
            if name in strict:
                bad = F.raise_error(F.concat(F.lit(f"bad timestamp in {name}: "), F.col(name)))
                value = F.when(F.col(name).isNull() | value.isNotNull(), value).otherwise(
                    bad.cast("timestamp_ntz")
                )
            parsed[name] = value
    return df.withColumns(parsed)


def resolved_category(english: Column, native: Column) -> Column:
    """English name, else native name, else ``unknown``."""
    return F.coalesce(english, native, F.lit("unknown"))


def categorized_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their readable category; done at product grain, before any line is touched."""
    named = products.join(translation, "product_category_name", "left")
    category = resolved_category(
        F.col("product_category_name_english"), F.col("product_category_name")
    )
    return named.withColumn("product_category", category).drop(*DESCRIPTIVE_COLUMNS)


def line_table(
    tables: dict[str, DataFrame],
    include: tuple[str, ...] = ("products", "customers", "sellers"),
) -> DataFrame:
    """Inner join of lines and orders, then left joins of products, customers and sellers.

    No status filter and no de-duplication. ``include`` names the dimensions a
    caller needs: their keys are unique, so leaving one out changes no other
    column and saves its join.

    Customers are joined to orders, names to products, and products and sellers to the
    lines before these meet their orders: what moves for the product and seller keys is a
    line's own few columns, and the many columns of its order move once, at order grain.
    No join carries a broadcast hint: Spark broadcasts a side whose size is known to be
    small, and otherwise sorts and merges, where adaptive execution splits the
    partitions of a hot key.
    """
    orders = parse_timestamps(tables["orders"])
    if "customers" in include:
        orders = orders.join(tables["customers"], "customer_id", "left")
    lines = parse_timestamps(tables["order_items"])
    own = len(lines.columns)
    if "products" in include:
        products = categorized_products(tables["products"], tables["category_translation"])
        # A line whose product is missing altogether has no category either.
        lines = lines.join(products, "product_id", "left").withColumn(
            "product_category", F.coalesce("product_category", F.lit("unknown"))
        )
    if "sellers" in include:
        lines = lines.join(tables["sellers"], "seller_id", "left")
    keys = len({"products", "sellers"} & set(include))
    return _columns_moved(lines.join(orders, "order_id", "inner"), keys, own, len(lines.columns))


def _columns_moved(joined: DataFrame, keys: int, own: int, wide: int) -> DataFrame:
    """The first column after the ``keys`` next ones, and columns ``own`` to ``wide`` at the end.

    Goes by position, as raw tables may share further names.
    """
    if not keys:
        return joined
    places = [*range(1, keys + 1), 0, *range(keys + 1, own)]
    places += [*range(wide, len(joined.columns)), *range(own, wide)]
    numbered = joined.toDF(*(f"_{place}" for place in range(len(joined.columns))))
    names = joined.columns
    return numbered.select(*(f"_{place}" for place in places)).toDF(
        *(names[place] for place in places)
    )
