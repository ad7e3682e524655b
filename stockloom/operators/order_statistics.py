"""Exact order statistics of any number of groups, by radix selection.

Values become whole numbers in the same order, doubles by their bits. Rows are counted by
group and leading digit; the digit at which the counts pass a wanted rank is the first
digit of the answer. The next round counts only rows with that digit, by the next one,
until all digits are known. Every round is one aggregate with partial counts for all
groups and ranks at once: no task ever orders the values of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.session import materialize

# Bits of a digit: a round makes at most 2^12 counts per task, group and open prefix.
DIGIT_BITS = 12
SIGN = -(2**63)


def ordered_key(value: Column, kind: str) -> Column:
    """A long in the order of a whole or floating value; NaN and null are null.

    The bits of a positive double are in its order, those of a negative one in reverse.
    """
    if kind not in ("double", "float"):
        return value.cast("bigint")
    # Adding zero makes both zeros equal.
    number = F.when(~F.isnan(value), value.cast("double") + F.lit(0.0))
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), number)
    bits = F.when(number.isNotNull(), bits).cast("bigint")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(2**63 - 1)))


def _digits_of(keyed: DataFrame) -> tuple[Column, int]:
    """An unsigned number in the order of ``_key``, and how many bits it has."""
    low, high = keyed.agg(F.min("_key"), F.max("_key")).first()
    if low is None:
        return F.col("_key"), 0
    if high - low < 2**63:
        return F.col("_key") - F.lit(low), (high - low).bit_length()
    return F.col("_key").bitwiseXOR(F.lit(SIGN)), 64


def select_ranks(
    df: DataFrame, value: str, ranks: DataFrame, by: tuple[str, ...] = (), weight: str | None = None
) -> DataFrame:
    """The value at each wanted rank, counted from 0 in each group.

    ``ranks`` has the columns ``by`` and rank; the result adds ``value``. A rank that a
    group does not reach is left out, as are nulls, NaN and rows without a group. ``df``
    is read once a round, at most six times: pass a materialized table. With ``weight``
    each row stands for so many. Eager: a round reads the result of the one before.
    """
    kind = dict(df.dtypes)[value]
    lines = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(*by, F.col(value).alias("_value"), lines.cast("bigint").alias("_lines"))
    rows = rows.withColumn("_key", ordered_key(F.col("_value"), kind)).where(F.col("_key").isNotNull())
    for name in by:
        rows = rows.where(F.col(name).isNotNull())
    code, bits = _digits_of(rows)
    rows = rows.withColumn("_code", code).drop("_key")
    # Zero by way of a column on both sides: equal literals would leave a join without a key.
    none = F.col("rank").cast("bigint").bitwiseAND(F.lit(0).cast("bigint"))
    open_ranks = ranks.select(*by, "rank", F.col("rank").alias("_left"), none.alias("_prefix"))
    place = bits
    while True:
        step = min(DIGIT_BITS, place)
        below = place - step
        # The first digit needs no prefix: shifting by all bits would shift by none.
        above = (
            F.col("_code").bitwiseAND(F.lit(0).cast("bigint"))
            if place == bits
            else F.shiftrightunsigned("_code", place)
        )
        prefixed = rows.withColumn("_prefix", above)
        if place < bits:
            known = open_ranks.select(*by, "_prefix").distinct()
            prefixed = prefixed.join(known, [*by, "_prefix"], "left_semi")
        keys = [*by, "_prefix", "_digit"]
        digit = F.shiftrightunsigned("_code", below).bitwiseAND(F.lit((1 << step) - 1))
        counts = (
            prefixed.withColumn("_digit", digit)
            .groupBy(*keys)
            .agg(F.sum("_lines").alias("_lines"), F.any_value("_value").alias("_value"))
        )
        in_order = Window.partitionBy(*by, "_prefix").orderBy("_digit")
        reached = F.sum("_lines").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        counts = counts.withColumn("_reached", reached)
        found = open_ranks.join(counts, [*by, "_prefix"]).where(
            (F.col("_left") < F.col("_reached"))
            & (F.col("_left") >= F.col("_reached") - F.col("_lines"))
        )
        if below == 0:
            return found.select(*by, "rank", F.col("_value").alias(value))
        open_ranks = materialize(
            found.select(
                *by,
                "rank",
                (F.col("_left") - (F.col("_reached") - F.col("_lines"))).alias("_left"),
                F.shiftleft("_prefix", step).bitwiseOR(F.col("_digit")).alias("_prefix"),
            )
        )
        place = below


def _totals(df: DataFrame, value: str, by: tuple[str, ...], weight: str | None) -> DataFrame:
    known = F.col(value).isNotNull()
    if dict(df.dtypes)[value] in ("double", "float"):
        known = known & ~F.isnan(value)
    for name in by:
        known = known & F.col(name).isNotNull()
    lines = F.lit(1) if weight is None else F.col(weight)
    total = F.sum(lines).cast("bigint").alias("_n")
    return df.where(known).groupBy(*by).agg(total).where(F.col("_n") > 0)


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: tuple[float, ...],
    by: tuple[str, ...] = (),
    weight: str | None = None,
    names: tuple[str, ...] | None = None,
) -> DataFrame:
    """Quantiles per group, one column each, with linear interpolation between two ranks.

    The same numbers as an exact percentile aggregate, which gathers the values of each
    group in one buffer; this counts digits instead. A group without values has no row;
    without ``by``, no values give one row of nulls.
    """
    names = names or tuple(f"q{i}" for i in range(len(quantiles)))
    totals = materialize(_totals(df, value, by, weight))
    spots = F.array(
        *(
            F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("_n") - 1)).alias("at"))
            for name, q in zip(names, quantiles, strict=True)
        )
    )
    wanted = totals.select(*by, F.explode(spots).alias("s")).select(
        *by,
        F.col("s.name").alias("_name"),
        F.col("s.at").alias("_at"),
        F.floor("s.at").alias("_low"),
        F.ceil("s.at").alias("_high"),
    )
    ends = wanted.select(*by, F.explode(F.array("_low", "_high")).alias("rank")).distinct()
    found = select_ranks(df, value, ends, by, weight)
    for side in ("_low", "_high"):
        own = found.select(*by, F.col("rank").alias(side), F.col(value).cast("double").alias(f"{side}_value"))
        wanted = wanted.join(own, [*by, side])
    share = (F.col("_high") - F.col("_at")) * F.col("_low_value") + (
        F.col("_at") - F.col("_low")
    ) * F.col("_high_value")
    result = F.when(F.col("_low") == F.col("_high"), F.col("_low_value")).otherwise(share)
    columns = (F.max(F.when(F.col("_name") == name, result)).alias(name) for name in names)
    return wanted.groupBy(*by).agg(*columns)


def lower_quantile(df: DataFrame, value: str, quantile: float) -> Column:
    """The smallest value that at least a share ``quantile`` of the values does not exceed."""
    totals = materialize(_totals(df, value, (), None))
    rank = F.greatest(F.ceil(F.col("_n") * F.lit(quantile)) - 1, F.lit(0))
    return select_ranks(df, value, totals.select(rank.alias("rank"))).agg(F.min(value)).scalar()
