from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stockloom.operators import demand
from stockloom.sources import bench_tables
from stockloom.streaming import weekly

SCHEMA = (
    "order_id string, product_category string, order_purchase_timestamp timestamp_ntz, "
    "price double, freight_value double, seller_id string"
)
MEASURES = [*demand.MEASURES, "first_sold_at"]


def sales(category, first, last):
    start = datetime(2018, 1, 1)
    return [
        (f"{category}{i}", category, start + timedelta(hours=40 * i), 1.5 + i % 3, 0.25, f"s{i % 4}")
        for i in range(first, last)
    ]


@pytest.fixture()
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("in", "weekly", "features", "progress")}


def trigger(spark, paths, features=False):
    lines = spark.readStream.schema(SCHEMA).parquet(paths["in"])
    run = weekly.start_weekly_stream(
        lines,
        paths["weekly"],
        paths["progress"],
        paths["features"] if features else None,
        late_by="21 days",
    )
    run.awaitTermination()


def rows_of(df):
    return sorted(df.select("product_category", demand.WEEK, *MEASURES).collect())


def test_triggers_add_up_to_the_batch_result(spark, paths):
    parts = [sales("a", 0, 30) + sales("b", 0, 10), sales("a", 30, 60) + sales("c", 20, 50)]
    for part in parts:
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(paths["in"])
        trigger(spark, paths)
    batch = demand.weekly_demand(spark.read.schema(SCHEMA).parquet(paths["in"]))
    assert rows_of(weekly.current_weekly(spark, paths["weekly"])) == rows_of(batch)
    trigger(spark, paths)
    assert rows_of(weekly.current_weekly(spark, paths["weekly"])) == rows_of(batch)
    weekly.compact_weekly(spark, paths["weekly"], paths["features"])
    assert rows_of(weekly.current_weekly(spark, paths["features"])) == rows_of(batch)
    assert spark.read.parquet(f"{paths['features']}/weeks").count() == batch.count()


def test_late_lines_within_the_limit_count_and_others_do_not(spark, paths):
    batches = [sales("a", 100, 101), sales("a", 95, 96), sales("a", 130, 131), sales("a", 0, 1)]
    for part in batches:
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(paths["in"])
        trigger(spark, paths)
    table = weekly.current_weekly(spark, paths["weekly"])
    assert table.agg(F.sum("quantity_sold")).first()[0] == 3


def weeks_written(spark, path, batch):
    stored = spark.read.parquet(path).where(F.col("batch") == batch)
    return {row[0] for row in stored.select("week").distinct().collect()}


def features_agree(spark, paths):
    lines = spark.read.schema(SCHEMA).parquet(paths["in"])
    full = demand.features_from_grid(demand.demand_grid(demand.weekly_demand(lines)))
    found = weekly.current_features(spark, paths["features"]).select(full.columns)
    assert sorted(found.collect()) == sorted(full.collect())
    return full.count()


def test_sellers_are_exact_over_triggers(spark, paths):
    start = datetime(2018, 1, 2)
    for part in range(3):
        rows = [
            (f"{part}-{i}", "a", start + timedelta(minutes=i), 1.0, None, f"s{(i * 7 + part) % 41}")
            for i in range(60)
        ] + [(f"n{part}", "a", start, None, None, None)]
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(paths["in"])
        trigger(spark, paths)
        batch = demand.weekly_demand(spark.read.schema(SCHEMA).parquet(paths["in"]))
        now = weekly.current_weekly(spark, paths["weekly"])
        assert rows_of(now) == rows_of(batch)
    assert now.first().curr_active_sellers == 41


def test_triggers_write_only_weeks_from_the_first_changed_one(spark, paths):
    parts = (
        sales("a", 0, 90) + sales("b", 0, 60) + sales("rare", 0, 2),
        sales("a", 90, 100) + sales("new", 95, 100),
        sales("a", 100, 101),
        sales("b", 96, 98),
    )
    for part in parts:
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(paths["in"])
        trigger(spark, paths, features=True)
        assert features_agree(spark, paths) > 0
    batches = sorted(
        row[0] for row in spark.read.parquet(paths["features"]).select("batch").distinct().collect()
    )
    assert len(batches) == len(parts)
    every = weeks_written(spark, paths["features"], batches[0])
    later = weeks_written(spark, paths["features"], batches[1])
    assert len(every) > 20 and len(later) < 6 and max(every) <= max(later)
    # The last trigger touches one category and no new week.
    stored = spark.read.parquet(paths["features"])
    newest = stored.where(F.col("batch") == stored.agg(F.max("batch")).first()[0])
    assert {row[0] for row in newest.select("product_category").distinct().collect()} == {"b"}


def test_prices_known_only_long_before_are_found(spark, paths):
    """Two months of sales without any price lie between a known price and new weeks."""
    rows = [list(row) for row in sales("a", 0, 120) + sales("b", 0, 120)]
    for row in rows:
        if row[1] == "a" and datetime(2018, 2, 1) < row[2] < datetime(2018, 6, 20):
            row[3] = row[4] = None
    first = [tuple(row) for row in rows if row[2] < datetime(2018, 5, 30)]
    second = [tuple(row) for row in rows if row[2] >= datetime(2018, 5, 30)]
    for part in (first, second):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(paths["in"])
        trigger(spark, paths, features=True)
    assert features_agree(spark, paths) > 0
    found = weekly.current_features(spark, paths["features"])
    after = found.where("product_category = 'a' and order_purchase_timestamp > '2018-06-20'")
    assert after.where("price_lag_1 > 0").count() > 0


def test_a_trigger_reads_many_files_of_which_each_is_a_small_share(spark, paths):
    """Half of all lines are of one time; a third have none, or no other value."""
    at = datetime(2018, 1, 2)
    rows = [
        (f"o{i}", "a", at if i % 2 else at + timedelta(hours=i), 1.0, None, f"s{i % 7}")
        for i in range(4000)
    ] + [(f"n{i}", None, None, None, None, None) for i in range(100)]
    lines = spark.createDataFrame(rows, SCHEMA)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = bench_tables.stream_of(lines, paths["in"])
    written = spark.read.parquet(paths["in"]).groupBy(F.input_file_name()).count().collect()
    assert len(written) == partitions > 2
    assert max(row["count"] for row in written) < 2 * len(rows) / partitions
    read = []
    run = (
        stream.writeStream.foreachBatch(lambda df, _: read.append(sorted(df.collect(), key=str)))
        .option("checkpointLocation", paths["progress"])
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    assert len(read) == 2
    assert sorted(sum(read, []), key=str) == sorted(lines.collect(), key=str)


def test_no_line_is_kept_as_state_and_a_trigger_repeated_counts_once(spark, paths):
    """Every line has a seller of its own; the triggers share a week, one has no sellers."""
    start = datetime(2018, 1, 2)
    parts = [
        [(f"{part}-{i}", "a", start + timedelta(hours=9 * i + part), 0.1, i / 3, f"s{part}-{i // 2}")
         for i in range(80)]
        for part in range(2)
    ]
    parts.append([("n", "a", start, None, float("nan"), None), ("m", None, start, 1.0, 1.0, "s")])
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(paths["in"])
    lines = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(paths["in"])
    run = weekly.start_weekly_stream(lines, paths["weekly"], paths["progress"], late_by="60 days")
    run.awaitTermination()
    triggers = [progress for progress in run.recentProgress if progress["numInputRows"]]
    assert len(triggers) == 3
    assert sum(state["numRowsTotal"] for progress in triggers for state in progress["stateOperators"]) == 0
    batch = demand.weekly_demand(spark.read.schema(SCHEMA).parquet(paths["in"]))
    assert rows_of(weekly.current_weekly(spark, paths["weekly"])) == rows_of(batch)
    again = spark.createDataFrame(parts[2], SCHEMA)
    changed = weekly.update_weekly(again, paths["weekly"], 2, 0, "60 days")
    assert changed == [datetime(2018, 1, 8).date()]
    assert rows_of(weekly.current_weekly(spark, paths["weekly"])) == rows_of(batch)


def test_lateness_counts_from_the_trigger_before_the_last_and_from_former_runs(spark, paths):
    start = datetime(2018, 1, 2)

    def days_after(*days):
        for day in days:
            row = (f"o{day}", f"d{day}", start + timedelta(days=day), 1.0, 1.0, "s")
            rows = spark.createDataFrame([row], SCHEMA).coalesce(1)
            rows.write.mode("append").parquet(paths["in"])
        lines = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(paths["in"])
        run = weekly.start_weekly_stream(
            lines, paths["weekly"], paths["progress"], late_by="21 days"
        )
        run.awaitTermination()
        found = weekly.current_weekly(spark, paths["weekly"]).select("product_category").collect()
        return sorted(int(row[0][1:]) for row in found)

    # Lines of before 1970 are not late by that alone.
    assert days_after(-30000, 100, 0, 1, 200) == [-30000, 0, 100, 200]
    assert days_after(120, 300) == [-30000, 0, 100, 200, 300]
