from datetime import datetime

import pytest
from pyspark.errors import AnalysisException

from stockloom.operators import evaluation, star
from stockloom.sources import readers, sinks

CSV = {
    "order_items": "seller_id,order_id,product_id,price,freight_value,shipping_limit_date\n"
    "s1,o1,p1,10.5,2.5,2018-01-05 00:00:00\ns1,o1,p2,1.0,,bad\ns2,o9,p1,1,1,\n",
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
    "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
    "o1,c1,canceled,2018-01-02 10:00:00,2018-01-02,,,2018-01-20 00:00:00\n",
    "products": "product_id,product_category_name,product_photos_qty\np1,cama,1\n",
    "category_translation": "product_category_name,product_category_name_english\ncama,bed\n",
    "customers": "customer_id,customer_city,customer_state\nc1,\"sao paulo, centro\",SP\n",
    "sellers": "seller_id,seller_city\ns1,x\n",
    "reviews": 'order_id,review_score,review_comment_message\no1,5,"two\nlines ""quoted"""\n',
}


@pytest.fixture()
def raw(tmp_path):
    for name, text in CSV.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_star_from_csv(spark, raw):
    tables = readers.read_raw_tables(spark, raw)
    assert "payments" not in tables
    rows = {r.product_id: r for r in star.line_table(tables).collect()}
    assert set(rows) == {"p1", "p2"}
    first, second = rows["p1"], rows["p2"]
    assert (first.product_category, second.product_category) == ("bed", "unknown")
    assert first.order_purchase_timestamp == datetime(2018, 1, 2, 10)
    assert first.order_approved_at is None and second.shipping_limit_date is None
    assert (first.price, second.freight_value) == (10.5, None)
    assert first.customer_city == "sao paulo, centro" and first.order_status == "canceled"
    assert "product_photos_qty" not in first.asDict()
    assert "product_category_name" not in first.asDict()


def test_review_text_with_line_breaks(spark, raw):
    row = readers.read_raw_tables(spark, raw)["reviews"].first()
    assert (row.review_score, row.review_comment_message) == (5, 'two\nlines "quoted"')


def test_missing_required_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_raw_tables(spark, str(tmp_path))


def test_named_files(spark, raw, tmp_path):
    (tmp_path / "items_2018.csv").write_text(CSV["order_items"])
    tables = readers.read_raw_tables(spark, raw, files={"order_items": "items_2018.csv"})
    assert tables["order_items"].count() == 3


def test_sinks_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "out")
    for rows in (10, 5):
        df = spark.range(rows).selectExpr("id", "cast(2017 + id % 2 as int) as year")
        sinks.write_parquet(df, path, partition_by="year")
    assert spark.read.parquet(path).count() == 5
    sinks.write_csv(spark.range(3), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    results = spark.createDataFrame([(4, 5.0)], "actual int, predicted double")
    for _ in range(2):
        metrics = evaluation.forecast_metrics(results)
        sinks.log_run(spark, str(tmp_path / "runs"), "try", {"rounds": 3}, metrics)
    runs = spark.read.parquet(str(tmp_path / "runs")).collect()
    assert len(runs) == 2 and runs[0].params == {"rounds": "3"} and runs[0].wmape == 0.25
