from stockloom.operators import inventory
from stockloom.plans import full_run
from stockloom.sources import bench_tables

SMALL = "/root/testdata/sf0.001"


def test_all_steps_leave_their_tables(spark, tmp_path):
    tables = bench_tables.raw_tables(spark, SMALL)
    out = str(tmp_path)
    counts = full_run.run(
        spark, tables, out, model="boosted_trees", year=2001, month=1, rounds=5
    )
    assert counts["line_rows"] == tables["order_items"].count()
    assert counts["feature_rows"] == spark.read.parquet(f"{out}/features").count()
    plan = spark.read.option("header", True).csv(f"{out}/inventory_plan")
    assert tuple(plan.columns) == inventory.PLAN_COLUMNS and plan.count() > 0
    assert spark.read.parquet(f"{out}/runs").count() == 1
    for name in ("global_forecast", "top_category_forecasts", "error_histogram"):
        assert spark.read.option("header", True).csv(f"{out}/evaluation/{name}").count() > 0
    for name in ("monthly_revenue", "weekday_hour", "payment_share", "state_logistics"):
        assert spark.read.option("header", True).csv(f"{out}/explore/{name}").count() > 0
    for name in ("feature_importance", "permutation_importance"):
        assert spark.read.option("header", True).csv(f"{out}/{name}").count() == 19
    reports = spark.read.parquet(f"{out}/reports")
    assert reports.count() == 19 and reports.where("state <> 'written'").count() == 0


def test_a_failing_report_does_not_keep_others_from_being_written(spark, tmp_path, monkeypatch):
    tables = bench_tables.raw_tables(spark, SMALL)
    out = str(tmp_path)
    full_run.write_line_table(tables, out)

    def at_once(*_, **__):
        raise ValueError("no such thing")

    def while_running(lines, *_, **__):
        return lines.selectExpr("cast(raise_error('broken row') as string) as broken")

    monkeypatch.setattr(full_run.logistics, "late_rate_national", at_once)
    monkeypatch.setattr(full_run.profile, "weekday_hour_pivot", while_running)
    assert full_run.explore(spark, out, tables["payments"]) == ["late_rate_national", "weekday_hour"]
    states = {r.report: r for r in spark.read.parquet(f"{out}/reports").collect()}
    assert len(states) == 12
    assert states["late_rate_national"].error == "ValueError: no such thing"
    assert "broken row" in states["weekday_hour"].error
    written = [name for name, row in states.items() if row.state == "written"]
    assert len(written) == 10
    for name in written:
        assert spark.read.option("header", True).csv(f"{out}/explore/{name}").count() > 0


def test_file_names_come_from_the_command_line(spark, tmp_path, monkeypatch):
    seen = {}

    def remembered(spark, folder, files, file_format):
        seen.update(folder=folder, files=files, file_format=file_format)
        return {}

    monkeypatch.setattr(full_run.readers, "read_raw_tables", remembered)
    monkeypatch.setattr(full_run, "run", lambda *_: {"line_rows": 0})
    monkeypatch.setattr(
        "sys.argv", ["full_run", "raw", "out", "--files", "orders=o.csv", "payments=p=1.csv"]
    )
    full_run.main()
    assert seen["files"] == {"orders": "o.csv", "payments": "p=1.csv"}
