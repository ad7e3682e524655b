"""Weekly demand from a stream of order lines, and features that follow it.

Spark keeps no state for the stream; what later triggers need lies in tables by trigger. Of
each open week these hold sums per category and the different sellers per category, so a
category with a third of all lines is spread over its sellers, no week has to fit into
memory, and sellers are counted exactly. Each trigger stores what it changed under its own
batch number, so a repeated trigger overwrites its own files and nothing is counted twice.
A trigger reads and writes only the weeks that it changed, and for the features also the
eight weeks before them.

Folders below the weekly path, all of them written by trigger:

- ``changes``: sums of the trigger's own lines per category and week, by batch
- ``clock``: time of the trigger's newest line, by batch
- ``sellers``: sellers per category and week among the trigger's own lines, by batch, in
  order of weeks
- ``weeks``: rows per category and week over all triggers so far, by week and batch
- ``calendar``: weeks seen, by batch
- ``first_sales``: first sale of each category in that batch, by batch
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockloom.functions import calendar, numeric
from stockloom.operators import demand
from stockloom.operators.demand import CATEGORY, MEASURES, SALES_LAGS, TARGET, WEEK

BATCH = "batch"
WEEK_DAY = "week"
# Whether a stored grid row has all features.
COMPLETE = "is_complete"


def _sold(lines: DataFrame) -> DataFrame:
    """Lines with a category and a time, and the Monday that ends their week."""
    sold = lines.where(F.col(CATEGORY).isNotNull() & F.col(WEEK).isNotNull())
    return sold.withColumn(WEEK_DAY, calendar.week_ending_monday(F.col(WEEK)).cast("date"))


def week_sums(sold: DataFrame) -> DataFrame:
    """Tuesday-to-Monday sums per category, with the times of the first and the last line."""
    money = sold.withColumns(
        {
            "_price": numeric.money(F.col("price")),
            "_freight": numeric.money(F.col("freight_value")),
        }
    )
    return money.groupBy(CATEGORY, WEEK_DAY).agg(
        F.count("order_id").alias(TARGET),
        F.sum("_price").alias("price"),
        F.count("_price").alias("prices"),
        F.sum("_freight").alias("freight"),
        F.count("_freight").alias("freights"),
        F.min(WEEK).alias("first_sold_at"),
        F.max(WEEK).alias("last_sold_at"),
    )


def week_sellers(sold: DataFrame) -> DataFrame:
    """The different sellers per category and week. Lines without a seller add none."""
    named = sold.where(F.col("seller_id").isNotNull())
    return named.select(CATEGORY, WEEK_DAY, "seller_id").distinct()


def _in_time(spark: SparkSession, path: str, batch: int, run: int, late_by: str) -> Column:
    """Whether a week is still open: it ended less than ``late_by`` before the newest line.

    The newest line is that of the triggers before the last one, and of all runs before the one
    that began with batch ``run``, as with a watermark of Spark.
    """
    clock = spark.read.parquet(f"{path}/clock")
    known = clock.where((F.col(BATCH) < run) | (F.col(BATCH) < batch - 1))
    limit = F.max("last_sold_at") - F.expr(f"interval '{late_by}'")
    day = known.agg(F.unix_date(limit.cast("date"))).first()[0]
    return F.lit(True) if day is None else F.unix_date(WEEK_DAY) >= day


def _weekly_rows(sums: DataFrame, sellers: DataFrame) -> DataFrame:
    """Rows per category and week of sums over some triggers, and of the number of sellers."""
    price, freight = (F.col(name).cast("double") for name in ("price", "freight"))
    added = sums.groupBy(CATEGORY, WEEK_DAY).agg(
        *(F.sum(name).alias(name) for name in (TARGET, "price", "prices", "freight", "freights")),
        F.min("first_sold_at").alias("first_sold_at"),
    )
    return added.join(sellers, [CATEGORY, WEEK_DAY], "left").withColumns(
        {
            "revenue": F.coalesce(price, F.lit(0.0)),
            "curr_avg_price": F.try_divide(price, F.col("prices")),
            "curr_avg_freight": F.try_divide(freight, F.col("freights")),
            "curr_active_sellers": F.coalesce("curr_active_sellers", F.lit(0).cast("bigint")),
        }
    )


def _store(df: DataFrame, path: str, batch: int) -> None:
    """Write rows below their week and batch; what this batch wrote before is replaced.

    The number of tasks is given, or a single one would open the files of all weeks in turn
    wherever the rows are few.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.withColumn(BATCH, F.lit(batch))
        .repartition(tasks, WEEK_DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(WEEK_DAY, BATCH)
        .parquet(path)
    )


def _of_weeks(spark: SparkSession, path: str, weeks: list[date]) -> DataFrame:
    """Stored rows of some weeks; other folders are not even listed."""
    folders = (f"{path}/{WEEK_DAY}={week.isoformat()}" for week in weeks)
    return spark.read.option("basePath", path).parquet(*folders)


def _latest(stored: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The values each key had in its newest batch."""
    values = [name for name in stored.columns if name not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*values), BATCH).alias("_now")
    return stored.groupBy(*keys).agg(newest).select(*keys, "_now.*")


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn(WEEK, F.col(WEEK_DAY).cast("timestamp_ntz")).drop(WEEK_DAY)


def _seller_counts(
    spark: SparkSession, path: str, batch: int, touched: DataFrame, again: list[date], before: list[int]
) -> DataFrame:
    """Sellers per category and week that a trigger touched; weeks ``again`` had some ``before``."""
    found = spark.read.parquet(f"{path}/sellers/{BATCH}={batch}")
    if again:
        folders = (f"{path}/sellers/{BATCH}={number}" for number in before)
        had = F.col(WEEK_DAY).isin(again)
        earlier = spark.read.parquet(*folders).where(had)
        earlier = earlier.join(touched, [CATEGORY, WEEK_DAY], "left_semi")
        both = found.where(had).unionByName(earlier).distinct()
        found = found.where(~had).unionByName(both)
    return found.groupBy(CATEGORY, WEEK_DAY).agg(F.count("seller_id").alias("curr_active_sellers"))


def update_weekly(
    lines: DataFrame, path: str, batch: int, run: int | None = None, late_by: str = "7 days"
) -> list[date]:
    """Store the sums and sellers of a trigger's lines and the weekly rows that follow from them.

    ``run`` is the first batch of the run, this one by default. Lines later than ``late_by``
    drop out. Returns the weeks it changed.
    """
    spark = lines.sparkSession
    sold = _sold(lines)
    week_sums(sold).write.mode("overwrite").parquet(f"{path}/changes/{BATCH}={batch}")
    own = spark.read.parquet(f"{path}/changes/{BATCH}={batch}")
    newest = own.agg(F.max("last_sold_at").alias("last_sold_at"))
    newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/clock/{BATCH}={batch}")
    in_time = _in_time(spark, path, batch, batch if run is None else run, late_by)
    own = own.where(in_time)
    weeks = sorted(row[0] for row in own.select(WEEK_DAY).distinct().collect())
    if not weeks:
        return []
    seen = own.select(WEEK_DAY).distinct().coalesce(1)
    seen.write.mode("overwrite").parquet(f"{path}/calendar/{BATCH}={batch}")
    stored = spark.read.parquet(f"{path}/calendar").where(F.col(BATCH) < batch)
    earlier = stored.join(seen, WEEK_DAY, "left_semi").select(WEEK_DAY, BATCH).collect()
    again = sorted({row[WEEK_DAY] for row in earlier})
    before = sorted({row[BATCH] for row in earlier})

    sellers = week_sellers(sold.where(in_time)).sortWithinPartitions(WEEK_DAY)
    sellers.write.mode("overwrite").parquet(f"{path}/sellers/{BATCH}={batch}")
    touched = own.select(CATEGORY, WEEK_DAY)
    counts = _seller_counts(spark, path, batch, touched, again, before)
    sums = own.drop("last_sold_at")
    if again:
        past = _of_weeks(spark, f"{path}/weeks", again).where(F.col(BATCH) < batch)
        past = _latest(past, (CATEGORY, WEEK_DAY)).join(touched, [CATEGORY, WEEK_DAY], "left_semi")
        sums = sums.unionByName(past.select(*sums.columns))
    _store(_weekly_rows(sums, counts), f"{path}/weeks", batch)
    first = own.groupBy(CATEGORY).agg(F.min("first_sold_at").alias("first_sold_at"))
    first.write.mode("overwrite").parquet(f"{path}/first_sales/{BATCH}={batch}")
    return weeks


def start_weekly_stream(
    lines: DataFrame,
    weekly_path: str,
    checkpoint_path: str,
    features_path: str | None = None,
    late_by: str = "7 days",
) -> StreamingQuery:
    """Take what is available, update the weekly table, and stop.

    With ``features_path`` each trigger also writes the features that it
    changed. Run it on a schedule, or use the same functions with
    another trigger for a query that stays up. A trigger reads its lines twice, for the sums and
    for the sellers, and Spark's count of its input rows is twice theirs.
    """

    batches: list[int] = []

    def write(arrived: DataFrame, batch: int) -> None:
        batches.append(batch)
        weeks = update_weekly(arrived, weekly_path, batch, batches[0], late_by)
        if features_path is not None and weeks:
            refresh_features(arrived.sparkSession, weekly_path, features_path, batch, weeks)

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def current_weekly(spark: SparkSession, weekly_path: str) -> DataFrame:
    """The weekly table as of the last trigger."""
    stored = spark.read.parquet(f"{weekly_path}/weeks")
    return _labelled(_latest(stored, (CATEGORY, WEEK_DAY))).select(
        CATEGORY, WEEK, *MEASURES, "first_sold_at"
    )


def compact_weekly(spark: SparkSession, weekly_path: str, new_path: str) -> None:
    """Write the current state of all folders as the single batch of a new one.

    Every trigger adds a batch, so do this from time to time between triggers, and let
    the stream go on in the new folder.
    """
    weeks = spark.read.parquet(f"{weekly_path}/weeks")
    newest = weeks.agg(F.max(BATCH)).first()[0]
    _store(_latest(weeks, (CATEGORY, WEEK_DAY)), f"{new_path}/weeks", newest)
    sellers = spark.read.parquet(f"{weekly_path}/sellers").drop(BATCH).distinct()
    sellers = sellers.sortWithinPartitions(WEEK_DAY)
    sellers.write.mode("overwrite").parquet(f"{new_path}/sellers/{BATCH}={newest}")
    clock = spark.read.parquet(f"{weekly_path}/clock").agg(F.max("last_sold_at").alias("last_sold_at"))
    clock.write.mode("overwrite").parquet(f"{new_path}/clock/{BATCH}={newest}")
    seen = spark.read.parquet(f"{weekly_path}/calendar").select(WEEK_DAY).distinct().coalesce(1)
    seen.write.mode("overwrite").parquet(f"{new_path}/calendar/{BATCH}={newest}")
    first = _first_sales(spark, weekly_path, newest)
    first.write.mode("overwrite").parquet(f"{new_path}/first_sales/{BATCH}={newest}")


def _first_sales(spark: SparkSession, weekly_path: str, batch: int) -> DataFrame:
    stored = spark.read.parquet(f"{weekly_path}/first_sales").where(F.col(BATCH) <= batch)
    return stored.groupBy(CATEGORY).agg(F.min("first_sold_at").alias("first_sold_at"))


def _known_before(spark: SparkSession, weekly_path: str, weeks: list[date], names: DataFrame) -> DataFrame:
    """The last known price and freight of some categories within ``weeks``."""
    stored = _latest(_of_weeks(spark, f"{weekly_path}/weeks", weeks), (CATEGORY, WEEK_DAY))
    rows = _labelled(stored).join(names, CATEGORY, "left_semi")
    seen = spark.createDataFrame([(week,) for week in weeks], f"{WEEK_DAY} date")
    grid = demand.demand_grid(rows, trim=False, all_weeks=_labelled(seen))

    def last(name: str, alias: str):
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col(WEEK))).alias(alias)

    grid = grid.where(F.col(WEEK) >= F.col("first_sale_date"))
    return grid.groupBy(CATEGORY).agg(
        last("curr_avg_price", "_price"), last("curr_avg_freight", "_freight")
    )


def refresh_features(
    spark: SparkSession, weekly_path: str, features_path: str, batch: int, changed: list[date]
) -> None:
    """Features of the first changed week and later, by week, under the batch's number.

    A week that no earlier batch had belongs to the grid of every category, so then all
    categories are written; else the touched ones only. Lags need the eight observed weeks
    before; a price not known in the first of those is looked up in all weeks before it.
    """
    stored = spark.read.parquet(f"{weekly_path}/calendar").where(F.col(BATCH) <= batch)
    first_seen = stored.groupBy(WEEK_DAY).agg(F.min(BATCH).alias(BATCH)).collect()
    observed = sorted(row[WEEK_DAY] for row in first_seen)
    place = observed.index(changed[0])
    start = max(0, place - max(SALES_LAGS))
    tail = observed[start:]

    names = _first_sales(spark, weekly_path, batch)
    if all(row[BATCH] < batch for row in first_seen):
        touched = _of_weeks(spark, f"{weekly_path}/weeks", changed).where(F.col(BATCH) == batch)
        names = names.join(touched.select(CATEGORY).distinct(), CATEGORY, "left_semi")
    rows = _latest(_of_weeks(spark, f"{weekly_path}/weeks", tail), (CATEGORY, WEEK_DAY))
    rows = rows.drop("first_sold_at").withColumn("_seen", F.lit(True))
    grid = names.withColumn(WEEK_DAY, F.explode(F.array(*map(F.lit, tail))))
    grid = _labelled(grid.join(rows, [CATEGORY, WEEK_DAY], "left"))
    grid = grid.where(F.col(WEEK) >= F.col("first_sold_at")).select(
        CATEGORY,
        WEEK,
        *(demand.zero_unless(F.col("_seen").isNotNull(), name) for name in MEASURES),
        F.col("first_sold_at").alias("first_sale_date"),
    )
    opening = F.col(WEEK) == F.lit(tail[0]).cast("timestamp_ntz")
    unknown = F.col("curr_avg_price").isNull() | F.col("curr_avg_freight").isNull()
    if start > 0:
        needy = grid.where(opening & unknown).select(CATEGORY)
        if not needy.isEmpty():
            known = _known_before(spark, weekly_path, observed[:start], needy)
            grid = grid.join(known, CATEGORY, "left")
            for name, value in (("curr_avg_price", "_price"), ("curr_avg_freight", "_freight")):
                filled = F.when(opening, F.coalesce(name, value)).otherwise(F.col(name))
                grid = grid.withColumn(name, filled)
            grid = grid.drop("_price", "_freight")
    featured = demand.add_features(grid).where(F.col(WEEK) >= F.lit(changed[0]).cast("timestamp_ntz"))
    complete = F.lit(True)
    for name in featured.columns:
        complete = complete & F.col(name).isNotNull()
    featured = featured.withColumn(COMPLETE, complete).withColumn(WEEK_DAY, F.col(WEEK).cast("date"))
    _store(featured.drop(WEEK, *demand.CURRENT_WEEK_COLUMNS), features_path, batch)


def current_features(spark: SparkSession, features_path: str) -> DataFrame:
    """Features of every category and week as of the last trigger that changed them."""
    newest = _latest(spark.read.parquet(features_path), (CATEGORY, WEEK_DAY))
    return _labelled(newest.where(COMPLETE).drop(COMPLETE))
