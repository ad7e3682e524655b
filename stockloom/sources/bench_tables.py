"""Binding of the TPC-H-like benchmark tables to the raw tables of this library.

The benchmark tables have no lifecycle timestamps, freight, cities or reviews.
They are derived here, by plain expressions over the given columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CUTOFF_YEAR, CUTOFF_MONTH = 2000, 6


# Columns of the benchmark tables. Naming them saves a job per scan
# that would only look up the schema.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Lines; the price is missing for some products, freight is price times tax."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey as order_id",
        "l_partkey as product_id",
        "l_suppkey as seller_id",
        "l_shipdate as shipping_limit_date",
        "case when l_partkey % 9 <> 4 then l_extendedprice end as price",
        "cast(rint(l_extendedprice * 100) as bigint) * cast(rint(l_tax * 100) as bigint) / 10000D"
        " as freight_value",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with purchase hours and the later stages of delivery.

    Each stage is the order date plus a whole number of hours, so that no stage
    repeats the arithmetic of the one before.
    """
    bought = "o_orderkey * 7 % 24"
    approved = f"{bought} + o_custkey % 36"
    handed = f"{approved} + (o_custkey % 40 - 2) * 24 + o_orderkey % 5 * 5"
    delivered = f"{handed} + (o_orderkey % 70 - 3) * 24 + o_orderkey % 7 * 5"

    def at(hours: str) -> str:
        return f"o_orderdate + cast({hours} as int) * interval '1' hour"

    approved_only = "case when o_orderkey % 97 <> 0 then"
    delivered_only = "case when o_orderkey % 97 <> 0 and o_orderstatus <> 'P' then"
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as order_id",
        "o_custkey as customer_id",
        f"{at(bought)} as order_purchase_timestamp",
        f"{approved_only} {at(approved)} end as order_approved_at",
        f"{approved_only} {at(handed)} end as order_delivered_carrier_date",
        f"{delivered_only} {at(delivered)} end as order_delivered_customer_date",
        "o_orderdate + interval '30' day as order_estimated_delivery_date",
    )


def products(spark: SparkSession, folder: str, grain: str = "brand") -> DataFrame:
    """Products; categories are brands, or brand and size. Some have none."""
    name = {"brand": "p_brand", "brand_size": "concat(p_brand, '-', p_size)"}[grain]
    return table(spark, folder, "part").selectExpr(
        "p_partkey as product_id",
        f"case when p_partkey % 50 <> 7 then {name} end as product_category_name",
        "cast(length(p_name) as double) as product_name_lenght",
    )


def category_translation(spark: SparkSession, folder: str) -> DataFrame:
    """Readable names for brands 1 to 15; the others have none."""
    return spark.range(1, 16, 1, 1).selectExpr(
        "concat('Brand#', id) as product_category_name",
        "concat('brand ', id) as product_category_name_english",
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers; states are nations, each with four cities. Some have neither."""
    nation = table(spark, folder, "nation").selectExpr("n_nationkey as c_nationkey", "n_name")
    return (
        table(spark, folder, "customer")
        .join(nation, "c_nationkey", "left")
        .selectExpr(
            "c_custkey as customer_id",
            "case when c_custkey % 41 <> 0 then concat(n_name, '/', c_custkey % 4) end"
            " as customer_city",
            "case when c_custkey % 43 <> 0 then n_name end as customer_state",
        )
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "s_suppkey as seller_id", "s_name as seller_name"
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order; some have no type."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as order_id",
        "case when o_orderkey % 53 <> 0 then o_orderpriority end as payment_type",
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents as reviews; quality and tone give a score from 1 to 5."""
    return table(spark, folder, "labels").selectExpr(
        "doc_id as order_id", "quality * 2 + (1 - toxic) * 2 + 1 as review_score"
    )


def review_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews with their text and the source they are grouped by."""
    texts = table(spark, folder, "documents").selectExpr(
        "doc_id as order_id", "source as review_source", "text as review_comment_message"
    )
    return reviews(spark, folder).join(texts, "order_id", "inner")


def events_as_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as order lines: event types are categories, users sell."""
    return table(spark, folder, "events").selectExpr(
        "event_id as order_id",
        "event_type as product_category",
        "ts as order_purchase_timestamp",
        "value as price",
        "case when event_id % 3 <> 0 then value end as freight_value",
        "user_id as seller_id",
    )


def stream_of(lines: DataFrame, folder: str, triggers: int = 2) -> DataFrame:
    """``lines`` written to a new ``folder`` in order of time and read as a stream.

    Ranges of time are as many as the session's shuffle partitions, so that no task writes a
    fixed share of the lines; lines of one time are split by their other columns. Each of
    about ``triggers`` triggers reads the same number of files, in the order in which they
    were written, which is nearly that of time.
    """
    spark = lines.sparkSession
    time = "order_purchase_timestamp"
    others = (name for name in lines.columns if name != time)
    each = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // triggers)
    lines.repartitionByRange(each * triggers, time, *others).write.parquet(folder)
    return spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", each).parquet(folder)


BINDINGS = {
    "order_items": order_items,
    "orders": orders,
    "products": products,
    "category_translation": category_translation,
    "customers": customers,
    "sellers": sellers,
    "payments": payments,
    "reviews": reviews,
}


def raw_tables(
    spark: SparkSession, folder: str, *names: str, grain: str = "brand"
) -> dict[str, DataFrame]:
    """The named raw tables, or all of them."""
    tables = {}
    for name in names or BINDINGS:
        extra = {"grain": grain} if name == "products" else {}
        tables[name] = BINDINGS[name](spark, folder, **extra)
    return tables
