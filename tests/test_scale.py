"""Plans and results under a key that holds a third of all rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stockloom.operators import demand, star
from stockloom.plans.catalog import QUERIES
from stockloom.session import materialize, use_checkpoint_dir

SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def conf(spark):
    changed = {}

    def change(key, value):
        changed[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", ["order_id", "product_id", "seller_id"])
def test_hot_key_is_split_in_the_star_join(spark, conf, hot):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    rows = 60000
    items = spark.range(0, rows, 1, 8).select(
        (F.col("id") % 9000).alias("order_id"),
        (F.col("id") % 1000).alias("product_id"),
        (F.col("id") % 500).alias("seller_id"),
        F.rand(1).alias("price"),
    )
    items = items.withColumn(hot, F.when(F.rand(2) < 0.4, 7).otherwise(F.col(hot)))
    tables = {
        "order_items": items,
        "orders": spark.range(9000).select(
            F.col("id").alias("order_id"), (F.col("id") % 70).alias("customer_id")
        ),
        "products": spark.range(1000).select(
            F.col("id").alias("product_id"), F.lit("x").alias("product_category_name")
        ),
        "category_translation": spark.createDataFrame(
            [("x", "y")], "product_category_name string, product_category_name_english string"
        ),
        "customers": spark.range(70).select(F.col("id").alias("customer_id")),
        "sellers": spark.range(500).select(F.col("id").alias("seller_id")),
    }
    lines = star.line_table(tables).select("order_id", "product_id", "price", "product_category")
    joins = [x for x in final_plan(lines).split("\n") if "skew=true" in x and hot in x]
    assert joins
    assert lines.count() == rows


def test_columns_of_orders_move_for_no_line_key(spark, conf):
    """Lines meet products and sellers before their orders; the columns keep their places."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = {
        "order_items": spark.createDataFrame(
            [(1, 5, 8, 2.0), (1, 6, None, 3.0), (2, None, 8, 4.0), (None, 5, 8, 5.0), (9, 5, 8, 6.0)],
            "order_id int, product_id int, seller_id int, price double",
        ),
        "orders": spark.createDataFrame(
            [(1, 3, "x"), (2, None, "y"), (2, 4, "z"), (None, 3, "w")],
            "order_id int, customer_id int, extra string",
        ),
        "products": spark.createDataFrame(
            [(5, "n", "p"), (5, None, "q")],
            "product_id int, product_category_name string, extra string",
        ),
        "category_translation": spark.createDataFrame(
            [("n", "e")], "product_category_name string, product_category_name_english string"
        ),
        "customers": spark.createDataFrame([(3, "c")], "customer_id int, customer_city string"),
        "sellers": spark.createDataFrame([(8, "s")], "seller_id int, seller_name string"),
    }
    lines = star.line_table(tables)
    assert lines.columns == [
        "seller_id", "product_id", "order_id", "price", "customer_id", "extra", "customer_city",
        "extra", "product_category", "seller_name",
    ]
    text = lines._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    moved = [x for x in text.split("\n\n") if "Exchange\n" in x and "price" in x]
    assert len(moved) == 3
    assert not any("customer" in x for x in moved)
    assert sorted(map(tuple, lines.collect()), key=str) == sorted(
        [
            (8, 5, 1, 2.0, 3, "x", "c", "p", "e", "s"),
            (8, 5, 1, 2.0, 3, "x", "c", "q", "unknown", "s"),
            (None, 6, 1, 3.0, 3, "x", "c", None, "unknown", None),
            (8, None, 2, 4.0, None, "y", None, None, "unknown", "s"),
            (8, None, 2, 4.0, 4, "z", None, None, "unknown", "s"),
        ],
        key=str,
    )
    assert star.line_table(tables, ("products",)).columns[:3] == ["product_id", "order_id", "seller_id"]
    assert star.line_table(tables, ()).columns[:3] == ["order_id", "product_id", "seller_id"]


def test_large_sides_are_not_broadcast(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "1KB")
    plan = final_plan(QUERIES["master_table"](spark, SMALL))
    final = plan.split("Initial Plan")[0]
    assert "SortMergeJoin" in final
    # What stays below the limit is nations, category names and ten sellers.
    assert final.count("BroadcastHashJoin") <= 3


def test_scans_read_only_the_needed_columns(spark):
    plan = QUERIES["late_rate_by_state"](spark, SMALL)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "o_totalprice" not in text and "o_orderpriority" not in text


def test_year_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "features")
    df = spark.range(40).selectExpr("id", "cast(2015 + id % 4 as int) as year", "1 as month")
    df.write.partitionBy("year").parquet(path)
    kept = demand.test_rows(spark.read.parquet(path), 2017, 1)
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and kept.count() == 10


def test_no_query_uses_a_cross_join(spark):
    names = ["demand_grid", "inventory_plan", "hist_seller_time", "kde_carrier_time",
             "latest_week_snapshot", "vendor_risk", "ts_cv_folds", "payment_share"]
    for name in names:
        text = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in text and "NestedLoop" not in text, name


def test_hot_week_counts_sellers_in_two_steps(spark):
    at = datetime(2018, 1, 2)
    lines = spark.range(100).select(
        F.col("id").alias("order_id"),
        F.lit("hot").alias("product_category"),
        F.lit(at).cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("freight_value"),
        (F.col("id") % 9).alias("seller_id"),
    )
    weekly = demand.weekly_demand(lines)
    text = weekly._jdf.queryExecution().executedPlan().toString()
    assert "seller_id" in text.split("Exchange hashpartitioning(")[2].split(")")[0]
    assert weekly.first().curr_active_sellers == 9


def test_checkpoints_go_to_the_configured_folder(spark):
    use_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in spark.sparkContext.getCheckpointDir()
    assert materialize(spark.range(5)).count() == 5
