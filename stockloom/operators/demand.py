"""Weekly demand: aggregate, observed-week grid, and leak-free features.

The flow is: order lines -> one row per category and week with sales -> a grid
in which silent weeks are zero rows -> features that look only at earlier weeks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stockloom.functions import calendar, numeric

CATEGORY = "product_category"
WEEK = "order_purchase_timestamp"
TARGET = "quantity_sold"

MEASURES = (TARGET, "revenue", "curr_avg_price", "curr_avg_freight", "curr_active_sellers")
# Weeks that sales are looked back by.
SALES_LAGS = (1, 2, 3, 4, 8)
ROLLING_WEEKS = 4

# Columns known only after the week is over, never a feature.
CURRENT_WEEK_COLUMNS = (
    "revenue",
    "curr_avg_price",
    "curr_avg_freight",
    "curr_active_sellers",
    "first_sale_date",
)


def by_week() -> WindowSpec:
    """Each category's weeks in order."""
    return Window.partitionBy(CATEGORY).orderBy(WEEK)


def first_sale_dates(lines: DataFrame) -> DataFrame:
    """Time of the first sale per category; lines without a category have none."""
    return lines.where(F.col(CATEGORY).isNotNull()).groupBy(CATEGORY).agg(F.min(WEEK).alias("first_sale_date"))


def weekly_demand(lines: DataFrame) -> DataFrame:
    """One row per category and week with sales.

    ``quantity_sold`` counts order lines, ``revenue`` is 0 when every price is
    null, averages skip nulls, sellers are counted once. ``first_sold_at`` is
    carried along so that the grid needs no second pass over the lines. Money is
    summed exactly to ten decimals; NaN counts as null.

    The distinct count makes Spark group by (category, week, seller) first, so
    even a category that holds a third of all lines is spread over many tasks
    and arrives at its own key already reduced.
    """
    sold = lines.where(F.col(CATEGORY).isNotNull() & F.col(WEEK).isNotNull())
    # Money becomes a decimal once a line, before it is both summed and counted.
    narrow = sold.select(
        CATEGORY,
        calendar.week_ending_monday(F.col(WEEK)).alias(WEEK),
        "order_id",
        "seller_id",
        numeric.money(F.col("price")).alias("_price"),
        numeric.money(F.col("freight_value")).alias("_freight"),
        F.col(WEEK).alias("_sold_at"),
    )
    price_sum, freight_sum = (F.sum(name).cast("double") for name in ("_price", "_freight"))
    return narrow.groupBy(CATEGORY, WEEK).agg(
        F.count("order_id").alias(TARGET),
        F.coalesce(price_sum, F.lit(0.0)).alias("revenue"),
        F.try_divide(price_sum, F.count("_price")).alias("curr_avg_price"),
        F.try_divide(freight_sum, F.count("_freight")).alias("curr_avg_freight"),
        F.countDistinct("seller_id").alias("curr_active_sellers"),
        F.min("_sold_at").alias("first_sold_at"),
    )


def observed_weeks(weekly: DataFrame) -> DataFrame:
    """Weeks in which any category sold something. Weeks nobody sold in are not part of time."""
    return weekly.select(WEEK).distinct()


def calendar_weeks(weekly: DataFrame) -> DataFrame:
    """Every week from the first to the last. As ``all_weeks`` of the grid, lags follow the calendar."""
    ends = weekly.agg(F.min(WEEK).alias("_first"), F.max(WEEK).alias("_last"))
    week = F.make_dt_interval(F.lit(7))
    return ends.select(F.explode(F.sequence("_first", "_last", week)).alias(WEEK))


def demand_grid(
    weekly: DataFrame, trim: bool = True, all_weeks: DataFrame | None = None
) -> DataFrame:
    """Every category in every observed week; weeks without sales are 0 in every measure.

    ``trim`` keeps only rows whose label is not before the category's first
    sale. As the label is Monday 00:00, a first sale later on a Monday drops
    that week too. Nulls that were present stay null.

    Each row of ``weekly`` stands for its own week and the silent weeks up to
    the category's next sale. Rows carry the number of their week through one
    shuffle by category, which the feature windows reuse; gaps become ranges of
    numbers after it, and the small table of observed weeks drops the numbers
    nobody sold in. That table is broadcast: all weeks of the calendar are half a
    million numbers. It is read from ``weekly`` a second time, so pass a
    materialized table for large data. ``all_weeks`` gives other weeks: those of
    the whole table if ``weekly`` holds only some categories, or ``calendar_weeks``.
    """
    source = weekly if all_weeks is None else all_weeks
    observed = source.select(calendar.week_number(F.col(WEEK)).alias("_number")).distinct()
    ends = observed.agg(
        F.struct(F.min("_number").alias("first"), F.max("_number").alias("last"))
    ).scalar()
    in_order = Window.partitionBy(CATEGORY).orderBy("_own")
    from_start = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (
        weekly.select(
            CATEGORY,
            calendar.week_number(F.col(WEEK)).alias("_own"),
            *MEASURES,
            "first_sold_at",
        )
        .withColumns(
            {
                "first_sale_date": F.first("first_sold_at").over(from_start),
                "_next": F.lead("_own").over(in_order),
                "_opens": F.lag("_own").over(in_order).isNull(),
            }
        )
    )
    begin = F.col("_own") if trim else F.when(F.col("_opens"), ends["first"]).otherwise(F.col("_own"))
    end = F.coalesce(F.col("_next") - 1, F.greatest(ends["last"], F.col("_own")))
    seen = F.col("_number") == F.col("_own")
    grid = (
        spans.withColumn("_number", F.explode(F.sequence(begin, end)))
        .join(F.broadcast(observed), "_number", "left_semi")
        .select(
            CATEGORY,
            calendar.week_of_number(F.col("_number")).alias(WEEK),
            *(zero_unless(seen, name) for name in MEASURES),
            "first_sale_date",
        )
    )
    return grid.where(F.col(WEEK) >= F.col("first_sale_date")) if trim else grid


def zero_unless(seen: Column, name: str) -> Column:
    zero = F.lit(0) if name in (TARGET, "curr_active_sellers") else F.lit(0.0)
    return F.when(seen, F.col(name)).otherwise(zero).alias(name)


def grid_row_counts(weekly: DataFrame) -> DataFrame:
    """Rows of the full grid, rows kept by the trim, and rows dropped as before launch."""
    grid = demand_grid(weekly, trim=False)
    kept = F.count_if(F.col(WEEK) >= F.col("first_sale_date"))
    return grid.agg(
        F.count(F.lit(1)).alias("grid_rows"),
        kept.alias("kept_rows"),
        (F.count(F.lit(1)) - kept).alias("dropped_rows"),
    )


def add_lagged_drivers(grid: DataFrame) -> DataFrame:
    """Last week's price, freight and sellers.

    Price and freight take the latest known value before the week (a null is
    filled forward), 0 if there is none. Sellers are not filled forward.
    """
    earlier = by_week().rowsBetween(Window.unboundedPreceding, -1)
    return grid.withColumns(
        {
            "price_lag_1": F.coalesce(
                F.last("curr_avg_price", ignorenulls=True).over(earlier), F.lit(0.0)
            ),
            "freight_lag_1": F.coalesce(
                F.last("curr_avg_freight", ignorenulls=True).over(earlier), F.lit(0.0)
            ),
            "sellers_lag_1": F.coalesce(
                F.lag("curr_active_sellers").over(by_week()), F.lit(0)
            ).cast("double"),
        }
    )


def add_calendar(df: DataFrame) -> DataFrame:
    """ISO week, month, calendar year, and the month as a point on a circle."""
    week = F.col(WEEK)
    angle = calendar.month_angle(F.col("month"))
    return df.withColumns(
        {
            "week_of_year": calendar.iso_week(week),
            "month": F.month(week),
            "year": F.year(week),
        }
    ).withColumns({"month_sin": F.sin(angle), "month_cos": F.cos(angle)})


def add_freight_ratio(df: DataFrame) -> DataFrame:
    """Freight per unit of price, both of last week; 0 where undefined."""
    ratio = numeric.ratio_or(F.col("freight_lag_1"), F.col("price_lag_1"), 0.0)
    return df.withColumn("freight_ratio", ratio)


def add_price_momentum(df: DataFrame, weeks: int = ROLLING_WEEKS) -> DataFrame:
    """Last week's price against its mean over ``weeks`` rows that include it; 1 where undefined."""
    mean_name = f"price_roll_mean_{weeks}"
    recent = [F.lag("price_lag_1", k).over(by_week()) for k in range(weeks - 1, 0, -1)]
    rolled = df.withColumn(mean_name, numeric.mean_of([*recent, F.col("price_lag_1")]))
    momentum = numeric.ratio_or(F.col("price_lag_1"), F.col(mean_name), 1.0)
    return rolled.withColumn("price_momentum", momentum)


def add_sales_lags(df: DataFrame, lags: tuple[int, ...] = SALES_LAGS) -> DataFrame:
    """Units sold ``k`` grid weeks earlier, null where the series is shorter."""
    return df.withColumns(
        {f"sales_lag_{k}": F.lag(TARGET, k).over(by_week()).cast("double") for k in lags}
    )


def add_sales_rolling_stats(df: DataFrame, weeks: int = ROLLING_WEEKS) -> DataFrame:
    """Mean and sample deviation of sales over the ``weeks`` rows before this one.

    A lag is null when the row does not exist, so a partial window gives null.
    """
    mean_name, std_name = f"sales_roll_mean_{weeks}", f"sales_roll_std_{weeks}"
    names = [f"_back_{k}" for k in range(1, weeks + 1)]
    lagged = df.withColumns(
        {
            name: F.lag(TARGET, k).over(by_week()).cast("double")
            for k, name in enumerate(names, start=1)
        }
    )
    back = [F.col(name) for name in names]
    return (
        lagged.withColumn(mean_name, numeric.mean_of(back))
        .withColumn(std_name, numeric.sample_std_of(back, F.col(mean_name)))
        .drop(*names)
    )


def add_event_distance(df: DataFrame) -> DataFrame:
    """Weeks to the late-November sales event, capped at 20."""
    return df.withColumn("weeks_to_bf", calendar.weeks_to_event(F.col(WEEK)))


def add_features(grid: DataFrame) -> DataFrame:
    """All features of a trimmed grid, with the columns they come from."""
    steps = (
        add_lagged_drivers,
        add_calendar,
        add_freight_ratio,
        add_price_momentum,
        add_sales_lags,
        add_sales_rolling_stats,
        add_event_distance,
    )
    featured = grid
    for step in steps:
        featured = step(featured)
    return featured


def features_from_grid(grid: DataFrame) -> DataFrame:
    """All features of a trimmed grid; rows with any null go, then the current-week columns.

    The first eight weeks of a category have no ``sales_lag_8`` and drop out. A
    null average price of the current week drops its row as well.
    """
    return add_features(grid).na.drop("any").drop(*CURRENT_WEEK_COLUMNS)


# The model's input columns.
MODEL_FEATURES = (
    "product_category",
    "price_lag_1",
    "freight_lag_1",
    "sellers_lag_1",
    "week_of_year",
    "month",
    "month_sin",
    "month_cos",
    "freight_ratio",
    "price_roll_mean_4",
    "price_momentum",
    "sales_lag_1",
    "sales_lag_2",
    "sales_lag_3",
    "sales_lag_4",
    "sales_lag_8",
    "sales_roll_mean_4",
    "sales_roll_std_4",
    "weeks_to_bf",
)


def with_part(features: DataFrame, year: int = 2018, month: int = 6) -> DataFrame:
    """``part``: train before the cut-off month, test from it to the end of its year, else null."""
    part = F.when(_before(year, month), "train").when(_from(year, month), "test")
    return features.withColumn("part", part)


def train_rows(features: DataFrame, year: int = 2018, month: int = 6) -> DataFrame:
    """Rows before the cut-off month."""
    return features.where(_before(year, month))


def test_rows(features: DataFrame, year: int = 2018, month: int = 6) -> DataFrame:
    """Rows of the cut-off year from that month on; later years are in neither part."""
    return features.where(_from(year, month))


def _before(year: int, month: int) -> Column:
    return (F.col("year") < year) | ((F.col("year") == year) & (F.col("month") < month))


def _from(year: int, month: int) -> Column:
    return (F.col("year") == year) & (F.col("month") >= month)


def latest_week(features: DataFrame) -> DataFrame:
    """Rows of the last week in the whole table."""
    return features.where(F.col(WEEK) == features.agg(F.max(WEEK)).scalar())
