"""Named queries over the benchmark tables, one or more per operator.

Every query reads the whole tables. Doubles are rounded here, and only here, so
that results can be compared with another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from stockloom.models.demand_models import DemandModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.functions import calendar
from stockloom.models import demand_models, importance, levels, seasonal, topics, validation
from stockloom.operators import demand, evaluation, inventory, logistics, profile, star, vendors
from stockloom.plans import features as stages
from stockloom.session import materialize, stage_folder
from stockloom.sources import bench_tables as bind
from stockloom.streaming import weekly

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CATEGORY, WEEK = demand.CATEGORY, demand.WEEK


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6, only: tuple[str, ...] | None = None) -> DataFrame:
    """Round doubles, or the named ones; the order of columns stays.

    Sums of whole money units and what follows from them by fixed steps are
    exact on both sides and need no rounding.
    """
    return df.selectExpr(
        *(
            f"round(`{name}`, {digits}) as `{name}`"
            if kind == "double" and (only is None or name in only)
            else f"`{name}`"
            for name, kind in df.dtypes
        )
    )


# Feature columns that go through a root or a trigonometric function.
INEXACT = ("month_sin", "month_cos", "sales_roll_std_4")


def _lines(spark: SparkSession, folder: str, *include: str, grain: str = "brand") -> DataFrame:
    names = ["order_items", "orders", *include]
    if "products" in include:
        names.append("category_translation")
    return star.line_table(bind.raw_tables(spark, folder, *names, grain=grain), include)


def _staged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with stage days, which are computed on the orders."""
    tables = bind.raw_tables(spark, folder, "order_items", "orders")
    return star.line_table(tables | {"orders": logistics.add_stage_days(tables["orders"])}, ())


def _orders(spark: SparkSession, folder: str, *include: str) -> DataFrame:
    """Orders weighted by their lines; ``include`` may name customers."""
    tables = bind.raw_tables(spark, folder, "order_items", "orders", *include)
    return logistics.weighted_orders(tables)


WEIGHT = "order_lines"


def _fine_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, "products", grain="brand_size")


def _fine_grid(spark: SparkSession, folder: str, trim: bool = True) -> DataFrame:
    return stages.grid_stage(_fine_lines(spark, folder), trim)


def _fine_features(spark: SparkSession, folder: str) -> DataFrame:
    return stages.feature_table(_fine_lines(spark, folder))


def _brand_features(spark: SparkSession, folder: str) -> DataFrame:
    return stages.feature_table(_lines(spark, folder, "products"))


def _split(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    cutoff = (bind.CUTOFF_YEAR, bind.CUTOFF_MONTH)
    return demand.train_rows(features, *cutoff), demand.test_rows(features, *cutoff)


def _rolling_results(features: DataFrame) -> DataFrame:
    """Test-period results of the rolling-mean forecast, which needs no fitted model."""
    return evaluation.results_table(_split(features)[1], "sales_roll_mean_4")


# Sources, projections and joins


@query
def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Text of mixed quality to timestamps: bad text and bare dates become null."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(F.col("event_id") % 7 == 0, "bad")
        .when(F.col("event_id") % 11 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(stamp)
    )
    events = bind.table(spark, folder, "events").select(
        "event_id", text.alias("order_purchase_timestamp")
    )
    return star.parse_timestamps(events)


@query
def category_fallback(spark: SparkSession, folder: str) -> DataFrame:
    products = bind.products(spark, folder)
    named = star.categorized_products(products, bind.category_translation(spark, folder))
    return named.select("product_id", CATEGORY)


@query
def join_category_lookup(spark: SparkSession, folder: str) -> DataFrame:
    translation = bind.category_translation(spark, folder)
    return (
        bind.products(spark, folder)
        .join(translation, "product_category_name", "left")
        .select("product_id", "product_category_name", "product_category_name_english")
    )


@query
def join_items_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder)


@query
def master_table(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, "products", "customers", "sellers")


@query
def delivery_stage_days(spark: SparkSession, folder: str) -> DataFrame:
    staged = logistics.add_stage_days(bind.orders(spark, folder))
    return staged.select(
        "order_id", "time_to_ship", "carrier_time", "total_delivery_time", "delay_days"
    )


# Weekly demand, grid and features


@query
def first_sale_date(spark: SparkSession, folder: str) -> DataFrame:
    return demand.first_sale_dates(_fine_lines(spark, folder))


@query
def weekly_demand(spark: SparkSession, folder: str) -> DataFrame:
    return demand.weekly_demand(_fine_lines(spark, folder))


@query
def observed_weeks(spark: SparkSession, folder: str) -> DataFrame:
    return demand.observed_weeks(demand.weekly_demand(_fine_lines(spark, folder)))


@query
def demand_grid(spark: SparkSession, folder: str) -> DataFrame:
    return _fine_grid(spark, folder, trim=False)


@query
def demand_grid_trimmed(spark: SparkSession, folder: str) -> DataFrame:
    return _fine_grid(spark, folder)


@query
def zombie_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return demand.grid_row_counts(stages.weekly_stage(_fine_lines(spark, folder)))


@query
def lagged_drivers(spark: SparkSession, folder: str) -> DataFrame:
    lagged = demand.add_lagged_drivers(_fine_grid(spark, folder))
    return lagged.select(CATEGORY, WEEK, "price_lag_1", "freight_lag_1", "sellers_lag_1")


@query
def ffill_price(spark: SparkSession, folder: str) -> DataFrame:
    """Known price per category after nulls are filled from the weeks before."""
    lagged = demand.add_lagged_drivers(_fine_grid(spark, folder))
    return lagged.select(CATEGORY, WEEK, "curr_avg_price", "price_lag_1")


@query
def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    weeks = demand.observed_weeks(demand.weekly_demand(_fine_lines(spark, folder)))
    return rounded(demand.add_calendar(weeks), 9)


@query
def weeks_to_event(spark: SparkSession, folder: str) -> DataFrame:
    """Distance of every order to the yearly event, at the order's own time."""
    return bind.orders(spark, folder).select(
        "order_id", calendar.weeks_to_event(F.col(WEEK)).alias("weeks_to_bf")
    )


@query
def freight_ratio(spark: SparkSession, folder: str) -> DataFrame:
    lagged = demand.add_lagged_drivers(_fine_grid(spark, folder))
    return demand.add_freight_ratio(lagged).select(CATEGORY, WEEK, "freight_ratio")


@query
def price_momentum(spark: SparkSession, folder: str) -> DataFrame:
    lagged = demand.add_lagged_drivers(_fine_grid(spark, folder))
    return demand.add_price_momentum(lagged).select(
            CATEGORY, WEEK, "price_roll_mean_4", "price_momentum"
        )


@query
def sales_lags(spark: SparkSession, folder: str) -> DataFrame:
    lagged = demand.add_sales_lags(_fine_grid(spark, folder))
    return lagged.select(CATEGORY, WEEK, *(f"sales_lag_{k}" for k in demand.SALES_LAGS))


@query
def sales_rolling_stats(spark: SparkSession, folder: str) -> DataFrame:
    rolled = demand.add_sales_rolling_stats(_fine_grid(spark, folder))
    return rounded(rolled.select(CATEGORY, WEEK, "sales_roll_mean_4", "sales_roll_std_4"))


@query
def features_full(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_fine_features(spark, folder), only=INEXACT)


@query
def time_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    features = demand.with_part(
        _fine_features(spark, folder), bind.CUTOFF_YEAR, bind.CUTOFF_MONTH
    )
    return (
        features.where(F.col("part").isNotNull())
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(demand.TARGET).alias("units"))
    )


@query
def latest_week_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    features = materialize(_fine_features(spark, folder))
    return rounded(demand.latest_week(features), only=INEXACT)


# Evaluation and inventory, with the rolling-mean forecast in the model's place


@query
def forecast_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.forecast_metrics(_rolling_results(_fine_features(spark, folder))))


@query
def wmape_by_category(spark: SparkSession, folder: str) -> DataFrame:
    test = _split(_brand_features(spark, folder))[1]
    models = {"rolling_mean": "sales_roll_mean_4", "last_week": "sales_lag_1"}
    return rounded(evaluation.compare_models(test, models))


@query
def global_forecast_by_week(spark: SparkSession, folder: str) -> DataFrame:
    results = _rolling_results(_fine_features(spark, folder))
    return rounded(evaluation.global_forecast_by_week(results))


@query
def top_categories(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.top_categories(_rolling_results(_fine_features(spark, folder)))


@query
def top_category_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    results = materialize(_rolling_results(_fine_features(spark, folder)))
    return rounded(evaluation.top_category_forecasts(results))


def _errors(spark: SparkSession, folder: str) -> DataFrame:
    """Errors as they are, each for one line: with a fitted model, nearly all differ."""
    results = _rolling_results(_fine_features(spark, folder))
    return materialize(results.select("error", F.lit(1).cast("bigint").alias("lines")))


@query
def hist_residuals(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.histogram(_errors(spark, folder), "error", 50))


@query
def ts_cv_folds(spark: SparkSession, folder: str) -> DataFrame:
    features = materialize(_brand_features(spark, folder).select(WEEK, demand.TARGET))
    return evaluation.fold_summary(evaluation.fold_roles(features))


@query
def forecast_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly planning gets the rolling mean, operations get last week's sales."""
    test = materialize(_split(_brand_features(spark, folder))[1])
    return rounded(
        evaluation.routed_forecasts(
            {
                "monthly_planning": evaluation.results_table(test, "sales_roll_mean_4"),
                "operations": evaluation.results_table(test, "sales_lag_1"),
            }
        )
    )


def _plan(spark: SparkSession, folder: str, service_level: float) -> DataFrame:
    needed = (CATEGORY, WEEK, "price_lag_1", "sales_roll_mean_4", "sales_roll_std_4")
    features = materialize(_fine_features(spark, folder).select(*needed))
    latest = demand.latest_week(features)
    return inventory.reorder_plan(latest, "sales_roll_mean_4", service_level)


@query
def inventory_plan(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_plan(spark, folder, 0.95), only=("demand_std_dev",))


@query
def inventory_plan_z128(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_plan(spark, folder, 0.90), only=("demand_std_dev",))


@query
def plan_top5(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_plan(spark, folder, 0.95).limit(5), only=("demand_std_dev",))


# Deliveries


@query
def valid_logistics(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics(_staged_lines(spark, folder))
    return valid.select("order_id", "product_id", "seller_id", "time_to_ship", "carrier_time")


@query
def valid_logistics_v1(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics_by_total(_staged_lines(spark, folder))
    return valid.select(
        "order_id", "product_id", "seller_id", "time_to_ship", "carrier_time", "total_delivery_time"
    )


@query
def median_delay_by_state(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(logistics.median_delay_by_state(_orders(spark, folder, "customers"), weight=WEIGHT))


@query
def late_rate_by_state(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(logistics.late_rate_by_state(_orders(spark, folder, "customers"), weight=WEIGHT))


@query
def late_rate_national(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(logistics.late_rate_national(_orders(spark, folder, "customers"), weight=WEIGHT))


@query
def delay_boxplot_by_state(spark: SparkSession, folder: str) -> DataFrame:
    within = logistics.within_delay_view(_orders(spark, folder, "customers"))
    return rounded(profile.delay_boxplot(within, weight=WEIGHT))


@query
def top_cities(spark: SparkSession, folder: str) -> DataFrame:
    return logistics.top_cities(_orders(spark, folder, "customers"), weight=WEIGHT)


@query
def city_delivery_time(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(logistics.city_delivery_time(_orders(spark, folder, "customers"), weight=WEIGHT))


@query
def state_delivery_time(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(logistics.state_delivery_time(_orders(spark, folder, "customers"), weight=WEIGHT))


@query
def state_logistics_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics(_orders(spark, folder, "customers"))
    return rounded(logistics.state_logistics_breakdown(valid, weight=WEIGHT))


@query
def delivery_composition(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics_by_total(_orders(spark, folder))
    return rounded(logistics.delivery_composition(valid, WEIGHT))


def _largest_cities(spark: SparkSession, folder: str) -> DataFrame:
    staged = _orders(spark, folder, "customers")
    return profile.rows_of_top(staged, logistics.top_cities(staged, weight=WEIGHT), "customer_city")


@query
def city_delivery_ci(spark: SparkSession, folder: str) -> DataFrame:
    """Bootstrap interval of the mean delivery days of the twenty largest cities."""
    return profile.bootstrap_mean_interval(
        _largest_cities(spark, folder), "total_delivery_time", "customer_city", weight=WEIGHT
    )


@query
def city_delivery_ci_agrees(spark: SparkSession, folder: str) -> DataFrame:
    """Whether both ends of the bootstrap interval are near the normal one's.

    Near is a tenth of the normal interval's width at most.
    """
    rows = materialize(_largest_cities(spark, folder))
    sides = {
        "drawn": profile.bootstrap_mean_interval,
        "normal": profile.normal_mean_interval,
    }
    drawn, normal = (
        f(rows, "total_delivery_time", "customer_city", weight=WEIGHT).alias(name)
        for name, f in sides.items()
    )
    near = "abs(drawn.{0} - normal.{0}) <= 0.1 * (normal.ci_high - normal.ci_low)"
    joined = drawn.join(normal, "customer_city")
    return rounded(
        joined.selectExpr(
            "customer_city",
            "drawn.lines as lines",
            "drawn.mean as mean",
            f"{near.format('ci_low')} and {near.format('ci_high')} as agrees",
        )
    )


@query
def city_delivery_normal_ci(spark: SparkSession, folder: str) -> DataFrame:
    """The deterministic interval for the same cities."""
    staged = _orders(spark, folder, "customers")
    return rounded(
        profile.normal_mean_interval(
            profile.rows_of_top(
                staged, logistics.top_cities(staged, weight=WEIGHT), "customer_city"
            ),
            "total_delivery_time",
            "customer_city",
            weight=WEIGHT,
        )
    )


# Profiles and distributions


@query
def monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return profile.monthly_revenue(_lines(spark, folder))


@query
def weekday_hour_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.weekday_hour_counts(bind.table(spark, folder, "events"), "ts")


@query
def weekday_hour_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return profile.weekday_hour_pivot(_orders(spark, folder), weight=WEIGHT)


@query
def payment_share(spark: SparkSession, folder: str) -> DataFrame:
    return profile.payment_share(bind.payments(spark, folder))


def _day_counts(valid: DataFrame, value: str) -> DataFrame:
    return materialize(logistics.value_counts(valid, value, weight=WEIGHT))


@query
def hist_seller_time(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics(_orders(spark, folder))
    counts = _day_counts(valid, "time_to_ship")
    return rounded(profile.histogram(counts, "time_to_ship", 20))


@query
def hist_carrier_time(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics(_orders(spark, folder))
    counts = _day_counts(valid, "carrier_time")
    return rounded(profile.histogram(counts, "carrier_time", 40))


@query
def hist_seller_time_v1(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics_by_total(_orders(spark, folder))
    counts = _day_counts(valid, "time_to_ship")
    return rounded(profile.histogram(counts, "time_to_ship", 30))


@query
def hist_carrier_time_v1(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics_by_total(_orders(spark, folder))
    counts = _day_counts(valid, "carrier_time")
    return rounded(profile.histogram(counts, "carrier_time", 30))


@query
def kde_seller_time(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics(_orders(spark, folder))
    counts = _day_counts(valid, "time_to_ship")
    return rounded(profile.kernel_density(counts, "time_to_ship"), 9)


@query
def kde_residuals(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.binned_kernel_density(_errors(spark, folder), "error"), 9)


@query
def kde_carrier_time(spark: SparkSession, folder: str) -> DataFrame:
    valid = logistics.valid_logistics(_orders(spark, folder))
    counts = _day_counts(valid, "carrier_time")
    return rounded(profile.kernel_density(counts, "carrier_time"), 9)


# Sellers and reviews


def _reviewed(spark: SparkSession, folder: str) -> DataFrame:
    staged = _staged_lines(spark, folder)
    return vendors.reviewed_lines(staged, bind.reviews(spark, folder))


@query
def vendor_risk(spark: SparkSession, folder: str) -> DataFrame:
    sellers = materialize(vendors.seller_summary(_reviewed(spark, folder)))
    return rounded(vendors.vendor_risk(sellers))


@query
def ship_review_corr(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(vendors.ship_review_corr(_reviewed(spark, folder)))


@query
def dissatisfaction_rate(spark: SparkSession, folder: str) -> DataFrame:
    scored = bind.review_texts(spark, folder)
    return rounded(vendors.dissatisfaction_rate(scored, "review_source"))


@query
def dissatisfaction_by_category(spark: SparkSession, folder: str) -> DataFrame:
    """Share of low scores among the reviewed order lines of each product category."""
    lines = _lines(spark, folder, "products").select("order_id", CATEGORY)
    reviewed = vendors.reviewed_lines(lines, bind.reviews(spark, folder))
    return rounded(vendors.dissatisfaction_rate(reviewed, CATEGORY))


# Fitted models


def _scored_test(
    spark: SparkSession, folder: str, fit: Callable[[DataFrame], DemandModel]
) -> DataFrame:
    train, test = _split(materialize(_brand_features(spark, folder)))
    return evaluation.results_table(fit(train).transform(test))


@query
def demand_model_tweedie(spark: SparkSession, folder: str) -> DataFrame:
    return _scored_test(spark, folder, demand_models.fit_tweedie_regression)


@query
def demand_model_tweedie_fine(spark: SparkSession, folder: str) -> DataFrame:
    """The same model and path over the finest categories."""
    train, test = _split(materialize(_fine_features(spark, folder)))
    return evaluation.results_table(demand_models.fit_tweedie_regression(train).transform(test))


@query
def demand_model_boosted_fine(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(materialize(_fine_features(spark, folder)))
    return evaluation.results_table(demand_models.fit_boosted_tweedie(train).transform(test))


@query
def demand_model_gbt(spark: SparkSession, folder: str) -> DataFrame:
    return _scored_test(spark, folder, demand_models.fit_boosted_trees)


@query
def demand_model_boosted(spark: SparkSession, folder: str) -> DataFrame:
    """Boosted trees under the Tweedie loss."""
    return _scored_test(spark, folder, demand_models.fit_boosted_tweedie)


@query
def category_levels(spark: SparkSession, folder: str) -> DataFrame:
    """The number that stands for a category in the models, per training week."""
    levelled = levels.add_ordered_levels(_split(_fine_features(spark, folder))[0])
    return rounded(levelled.select(CATEGORY, WEEK, levels.LEVEL), 9)


@query
def category_levels_final(spark: SparkSession, folder: str) -> DataFrame:
    """The level of each category after the training weeks; that of all has no category."""
    train = materialize(_split(_fine_features(spark, folder))[0])
    return rounded(levels.final_levels(train), 9)


@query
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _split(materialize(_brand_features(spark, folder)))
    model = demand_models.fit_boosted_trees(train)
    return demand_models.feature_importance(spark, model)


@query
def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Error growth per feature of the Tweedie regression over the finest categories."""
    train, test = _split(materialize(_fine_features(spark, folder)))
    model = demand_models.fit_tweedie_regression(train)
    return importance.permutation_importance(test, model.transform)


@query
def inventory_plan_model(spark: SparkSession, folder: str) -> DataFrame:
    """The plan with the forecast of the Tweedie regression."""
    features = materialize(_brand_features(spark, folder))
    model = demand_models.fit_tweedie_regression(_split(features)[0])
    return inventory.reorder_plan(model.transform(demand.latest_week(features)))


@query
def cross_validation_scores(spark: SparkSession, folder: str) -> DataFrame:
    features = materialize(_brand_features(spark, folder))
    return validation.cross_validation_scores(features, demand_models.fit_tweedie_regression)


@query
def seasonal_baseline(spark: SparkSession, folder: str) -> DataFrame:
    grid = stages.grid_stage(_lines(spark, folder, "products"))
    return seasonal.seasonal_baseline(grid)


@query
def topic_terms(spark: SparkSession, folder: str) -> DataFrame:
    texts = bind.table(spark, folder, "documents")
    return topics.topic_terms(texts, "text")


# Streaming


# Later than anything in the files, whose order is not that of time.
ANY_LATENESS = "36500 days"


@query
def stream_weekly_demand(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of sales over several triggers: event types are categories."""
    stage = stage_folder(spark, "weekly-stream")
    lines = bind.stream_of(bind.events_as_lines(spark, folder), f"{stage}/lines")
    run = weekly.start_weekly_stream(
        lines, f"{stage}/weekly", f"{stage}/progress", late_by=ANY_LATENESS
    )
    run.awaitTermination()
    return rounded(weekly.current_weekly(spark, f"{stage}/weekly"))


@query
def stream_features(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a stream; each trigger writes the feature weeks that it changes."""
    stage = stage_folder(spark, "feature-stream")
    sold = _lines(spark, folder, "products").select(
        "order_id", CATEGORY, WEEK, "price", "freight_value", "seller_id"
    )
    run = weekly.start_weekly_stream(
        bind.stream_of(sold, f"{stage}/lines"),
        f"{stage}/weekly",
        f"{stage}/progress",
        f"{stage}/features",
        late_by=ANY_LATENESS,
    )
    run.awaitTermination()
    return rounded(weekly.current_features(spark, f"{stage}/features"), only=INEXACT)
