"""Revenue over time, buying hours, payment mix, and distributions behind the charts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions import calendar, numeric
from stockloom.operators.logistics import rows_of, value_counts
from stockloom.operators.order_statistics import exact_quantiles
from stockloom.session import materialize


def monthly_revenue(
    lines: DataFrame,
    ts: str = "order_purchase_timestamp",
    price: str = "price",
) -> DataFrame:
    """Revenue per month labelled by its last day; months without rows are 0.

    Each month with rows also stands for the empty months up to the next one.
    The window has no partition key, but its input is one row per month.
    """
    months = (
        lines.where(F.col(ts).isNotNull())
        .groupBy(calendar.month_start(F.col(ts)).alias("_month"))
        .agg(F.coalesce(numeric.exact_sum(F.col(price)), F.lit(0.0)).alias("_sum"))
    )
    following = F.lead("_month").over(Window.orderBy("_month"))
    spans = months.withColumn("_last", F.coalesce(F.add_months(following, -1), "_month"))
    stretch = F.sequence(F.col("_month"), F.col("_last"), F.make_ym_interval(F.lit(0), F.lit(1)))
    filled = spans.select("_month", "_sum", F.explode(stretch).alias("_label"))
    revenue = F.when(F.col("_label") == F.col("_month"), F.col("_sum")).otherwise(0.0)
    return filled.select(
        calendar.month_end(F.col("_label")).alias("month_end"), revenue.alias("revenue")
    ).orderBy("month_end")


def weekday_hour_counts(
    df: DataFrame, ts: str = "order_purchase_timestamp", weight: str | None = None
) -> DataFrame:
    """Order lines per weekday and hour."""
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(
            calendar.weekday_name(F.col(ts)).alias("day_of_week"), F.hour(ts).alias("hour")
        )
        .agg(F.sum(rows_of(weight)).alias("orders"))
    )


def weekday_hour_pivot(
    df: DataFrame, ts: str = "order_purchase_timestamp", weight: str | None = None
) -> DataFrame:
    """Weekdays as rows, Monday first, hours as columns ``h00`` to ``h23``; empty cells are null."""
    counts = weekday_hour_counts(df, ts, weight)
    wide = counts.groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.sum("orders"))
    wide = wide.withColumnsRenamed({str(h): f"h{h:02d}" for h in range(24)})
    days = df.sparkSession.range(1, 8, 1, 1).select(
        F.col("id").cast("int").alias("day_index"),
        F.element_at(
            F.array(*(F.lit(day) for day in calendar.WEEKDAYS)), F.col("id").cast("int")
        ).alias("day_of_week"),
    )
    return days.join(wide, "day_of_week", "left").orderBy("day_index")


def payment_share(payments: DataFrame, kind: str = "payment_type") -> DataFrame:
    """Rows and share in percent per payment type, largest first; nulls do not count."""
    counts = value_counts(payments, kind).withColumnRenamed("lines", "payments")
    # Both columns are named so that the total reuses the grouped rows.
    total = counts.agg(F.struct(F.sum("payments").alias("n"), F.max(kind).alias("last"))).scalar()
    return counts.withColumn(
        "share_pct", F.round(F.col("payments") * 100.0 / total["n"], 1)
    ).orderBy(F.desc("payments"), kind)


def delay_boxplot(
    df: DataFrame,
    value: str = "delay_days",
    by: str = "customer_state",
    weight: str | None = None,
) -> DataFrame:
    """Box-plot numbers per group: quartiles, whisker ends within 1.5 IQR, and outlier count.

    Works on rows counted per (group, value), and finds the quartiles by counting digits,
    so neither many rows of a group nor many different values gather in one task. The
    counts are stored once, as they are read several times.
    """
    counts = materialize(value_counts(df, value, by, weight))
    quartiles = exact_quantiles(
        counts, value, (0.25, 0.5, 0.75), (by,), "lines", names=("q1", "median", "q3")
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col(value) >= F.col("q1") - reach) & (F.col(value) <= F.col("q3") + reach)
    return (
        counts.join(quartiles, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("lines"))), F.lit(0)).alias("outliers"),
            F.sum("lines").alias("lines"),
        )
        .orderBy(F.desc("median"), by)
    )


def _extent(counts: DataFrame, value: str) -> Column:
    """Lowest and highest value, row count and mean of counted values, as one struct.

    Attach it as a column once and use its fields: every mention of a subquery
    is another plan to optimize.
    """
    x = F.col(value).cast("double")
    return counts.agg(
        F.struct(
            F.min(x).alias("lo"),
            F.max(x).alias("hi"),
            F.sum("lines").cast("double").alias("n"),
            (F.sum(x * F.col("lines")) / F.sum("lines")).alias("mean"),
        )
    ).scalar()


def histogram(counts: DataFrame, value: str, bins: int) -> DataFrame:
    """Lines in ``bins`` equal-width bins from the lowest to the highest value.

    ``counts`` comes from ``value_counts``; it is read more than once, so pass a
    materialized table for large data. The last bin includes its right edge.
    Empty bins are rows with 0 lines. If all values are equal, the range is one
    unit wide around them.
    """
    extent = _extent(counts, value)
    pad = F.when(F.col("_e.lo") == F.col("_e.hi"), 0.5).otherwise(0.0)
    low, width = F.col("_e.lo") - pad, F.col("_e.hi") - F.col("_e.lo") + pad * 2
    # Multiplied before dividing, so that whole numbers land on bin edges exactly.
    position = F.floor((F.col(value).cast("double") - low) * float(bins) / width)
    filled = (
        counts.select(value, "lines", extent.alias("_e"))
        .groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.sum("lines").alias("_lines"))
    )
    spine = counts.sparkSession.range(0, bins, 1, 1).select(
        F.col("id").cast("int").alias("bin"), extent.alias("_e")
    )
    return (
        spine.join(filled, "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * width / float(bins)).alias("bin_start"),
            (low + (F.col("bin") + 1) * width / float(bins)).alias("bin_end"),
            F.coalesce("_lines", F.lit(0)).alias("lines"),
        )
        .orderBy("bin")
    )


def kernel_density(counts: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Gaussian density estimate at ``points`` positions from the lowest to the highest value.

    ``counts`` comes from ``value_counts``, as for ``histogram``. The bandwidth
    is the sample deviation times n^(-1/5); equal values or a single one have no
    density and give no rows. The work per distinct value is a
    fixed number of points, and partial sums leave one row per point and task
    to shuffle.
    """
    x = F.col(value).cast("double")
    gap = x - F.col("_e.mean")
    shape = (
        counts.select(value, "lines", _extent(counts, value).alias("_e"))
        .agg(F.any_value("_e").alias("_e"), F.sum(F.col("lines") * gap * gap).alias("_ss"))
        .select(
            F.struct(
                "_e.lo",
                "_e.n",
                ((F.col("_e.hi") - F.col("_e.lo")) / float(points - 1)).alias("step"),
                (
                    F.sqrt(F.try_divide(F.col("_ss"), F.col("_e.n") - 1.0))
                    * F.pow(F.col("_e.n"), F.lit(-0.2))
                ).alias("bandwidth"),
            )
        )
        .scalar()
    )
    spread = counts.select(
        x.alias("_v"),
        "lines",
        shape.alias("_s"),
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
    )
    position = F.col("_s.lo") + F.col("point") * F.col("_s.step")
    # Without any spread there is no density: a null bandwidth, or one of 0, gives no rows.
    spread = spread.where(F.col("_s.bandwidth") > 0)
    z = F.try_divide(position - F.col("_v"), F.col("_s.bandwidth"))
    kernels = F.sum(F.col("lines") * F.exp(z * z * -0.5))
    area = F.col("_s.n") * F.col("_s.bandwidth") * math.sqrt(2.0 * math.pi)
    return (
        spread.groupBy("point")
        .agg(F.any_value("_s").alias("_s"), kernels.alias("_kernels"))
        .select("point", position.alias("x"), F.try_divide(F.col("_kernels"), area).alias("density"))
        .orderBy("point")
    )


def binned_kernel_density(
    rows: DataFrame, value: str, points: int = 200, nodes: int = 32
) -> DataFrame:
    """The estimate of ``kernel_density`` for values of which nearly all differ.

    Each value is shared between its two neighbours on a grid of ``nodes`` steps per point,
    in proportion to its distance; these masses are partial sums, so one row per node and
    task is shuffled, and kernels are summed over the nodes, whatever the number of rows.
    With grid step d and bandwidth h, the density is off by at most
    d^2 / (8 h^3 sqrt(2 pi)). ``rows`` is read three times: pass a stored table. Equal
    values or a single one give no rows.
    """
    last = (points - 1) * nodes
    x = F.col(value).cast("double")
    known = rows.where(x.isNotNull() & ~F.isnan(x)).select(x.alias("_v"))
    extent = known.agg(
        F.struct(
            F.min("_v").alias("lo"),
            F.max("_v").alias("hi"),
            F.count("*").cast("double").alias("n"),
            F.avg("_v").alias("mean"),
        )
    ).scalar()
    gap = F.col("_v") - F.col("_e.mean")
    deviation = F.sqrt(F.try_divide(F.sum(gap * gap), F.any_value("_e.n") - 1.0))
    shape = (
        known.withColumn("_e", extent)
        .agg(F.any_value("_e").alias("_e"), deviation.alias("_sd"))
        .select(
            F.struct(
                "_e.lo",
                "_e.n",
                ((F.col("_e.hi") - F.col("_e.lo")) / float(last)).alias("step"),
                (F.col("_sd") * F.pow("_e.n", F.lit(-0.2))).alias("bandwidth"),
            )
        )
        .scalar()
    )
    shaped = known.withColumn("_s", shape).where(F.col("_s.bandwidth") > 0)
    place = (F.col("_v") - F.col("_s.lo")) / F.col("_s.step")
    below = F.least(F.floor(place), F.lit(last - 1)).cast("int")
    share = place - below
    both = F.array(
        F.struct(below.alias("node"), (1.0 - share).alias("mass")),
        F.struct((below + 1).alias("node"), share.alias("mass")),
    )
    masses = (
        shaped.select("_s", F.explode(both).alias("_b"))
        .groupBy("_b.node")
        .agg(F.sum("_b.mass").alias("_mass"), F.any_value("_s").alias("_s"))
    )
    spread = masses.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    z = (F.col("point") * float(nodes) - F.col("node")) * F.col("_s.step") / F.col("_s.bandwidth")
    position = F.col("_s.lo") + F.col("point") * F.col("_s.step") * float(nodes)
    area = F.col("_s.n") * F.col("_s.bandwidth") * math.sqrt(2.0 * math.pi)
    return (
        spread.groupBy("point")
        .agg(F.any_value("_s").alias("_s"), F.sum(F.col("_mass") * F.exp(z * z * -0.5)).alias("_kernels"))
        .select("point", position.alias("x"), (F.col("_kernels") / area).alias("density"))
        .orderBy("point")
    )


# Rows of one value that are drawn one by one; more of them are drawn at once.
SINGLE_DRAWS = 12


def _uniform(*keys: Column | str) -> Column:
    """A number above 0 and below 1 that depends on nothing but ``keys``."""
    return (F.shiftrightunsigned(F.xxhash64(*keys), 11) + F.lit(0.5)) * F.lit(2.0**-53)


def _poisson_one(uniform: Column) -> Column:
    """A Poisson number of mean 1, by comparing with the distribution's steps."""
    term, below, found = math.exp(-1.0), 0.0, F.lit(0)
    for k in range(18):
        below += term
        term /= k + 1
        found = found + (uniform > F.lit(below)).cast("int")
    return found


def bootstrap_mean_interval(
    df: DataFrame,
    value: str,
    by: str,
    replicates: int = 1000,
    level: float = 95.0,
    seed: int = 0,
    weight: str | None = None,
) -> DataFrame:
    """Percentile bootstrap interval of the mean per group, by Poisson weights.

    In each replicate a row has a Poisson weight of mean 1, so rows need not meet: tasks
    add up weights and weighted values per group and replicate. Rows are first counted per
    (group, value); a value's rows are drawn together, one by one up to ``SINGLE_DRAWS`` of
    them and from the normal limit of their sum above. Weights come from a hash of group,
    value and replicate, so a task that runs again draws the same. Any values will do; the
    work is that of ``replicates`` passes over the different ones.
    """
    counts = value_counts(df, value, by, weight)
    x, lines = F.col(value).cast("double"), F.col("lines")
    single = lines <= SINGLE_DRAWS
    units = F.when(single, F.sequence(F.lit(1).cast("bigint"), lines)).otherwise(
        F.array(F.lit(0).cast("bigint"))
    )
    drawn = (
        counts.withColumn("_unit", F.explode(units))
        .withColumn("_replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
        .withColumn("_u", _uniform(by, value, "_unit", "_replicate", F.lit(seed)))
    )
    other = _uniform(by, value, "_unit", "_replicate", F.lit(seed), F.lit("angle"))
    normal = F.sqrt(F.log("_u") * -2.0) * F.cos(other * (2.0 * math.pi))
    many = F.greatest(F.rint(lines + F.sqrt(lines.cast("double")) * normal), F.lit(0.0))
    weights = F.when(single, _poisson_one(F.col("_u")).cast("double")).otherwise(many)
    means = (
        drawn.withColumn("_weight", weights)
        .groupBy(by, "_replicate")
        .agg(F.try_divide(F.sum(F.col("_weight") * x), F.sum("_weight")).alias("_mean"))
    )
    tail = (100.0 - level) / 200.0
    # A group has as many means as there are replicates.
    ends = means.groupBy(by).agg(
        F.percentile("_mean", F.array(F.lit(tail), F.lit(1.0 - tail))).alias("_ends")
    )
    known = counts.groupBy(by).agg(
        F.sum("lines").alias("lines"), (F.sum(lines * x) / F.sum("lines")).alias("mean")
    )
    return (
        known.join(ends, by)
        .select(by, "lines", "mean", F.col("_ends")[0].alias("ci_low"), F.col("_ends")[1].alias("ci_high"))
        .orderBy(F.desc("mean"), by)
    )


def normal_mean_interval(
    df: DataFrame, value: str, by: str, z: float = 1.96, weight: str | None = None
) -> DataFrame:
    """The deterministic counterpart: mean plus and minus ``z`` standard errors.

    Works on whole-number values such as days, whose sums are exact.
    """
    counts = value_counts(df, value, by, weight)
    lines, x = F.col("lines"), F.col(value)
    moments = counts.groupBy(by).agg(
        F.sum("lines").alias("lines"),
        F.sum(lines * x).cast("double").alias("_s1"),
        F.sum(lines * x * x).cast("double").alias("_s2"),
    )
    mean = F.col("_s1") / lines
    variance = (F.col("_s2") - F.col("_s1") * mean) / F.nullif(lines - 1, F.lit(0))
    half = F.sqrt(variance / lines) * z
    return moments.select(
        by,
        "lines",
        mean.alias("mean"),
        (mean - half).alias("ci_low"),
        (mean + half).alias("ci_high"),
    ).orderBy(F.desc("mean"), by)


def rows_of_top(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a top-k table; that side has k rows by construction."""
    return df.join(F.broadcast(top.select(key)), key, "left_semi")
