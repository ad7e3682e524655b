"""How much a model's error grows when one feature's values are dealt to other rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.operators.demand import CATEGORY, MODEL_FEATURES, TARGET, WEEK

AS_IT_IS = "none"


def shuffled_copies(rows: DataFrame, features: tuple[str, ...], seed: int = 0) -> DataFrame:
    """Each row once as it is and once per feature, tagged with the feature's name.

    In the copy of a feature, its value comes from the next row of the same week in a
    random order that the seed and the feature give: a cycle through the week, so every
    value is used once and, with two rows or more, none stays where it was. One shuffle
    by week serves all orders. A week with one row keeps its values.
    """
    keys = (CATEGORY, WEEK)
    moved = {}
    for name in features:
        by_chance = Window.partitionBy(WEEK).orderBy(F.xxhash64(*keys, F.lit(name), F.lit(seed)), CATEGORY)
        whole = by_chance.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        after = F.row_number().over(by_chance) == F.count(F.lit(1)).over(Window.partitionBy(WEEK))
        first = F.first(name).over(whole)
        moved[f"_next_{name}"] = F.when(after, first).otherwise(F.lead(name).over(by_chance))
    wide = rows.withColumns(moved)
    others = [name for name in rows.columns if name not in features]

    def copy(tag: str):
        return F.struct(
            F.lit(tag).alias("permuted"),
            *(F.col(f"_next_{name}" if name == tag else name).alias(name) for name in features),
        )

    copies = F.explode(F.array(*(copy(tag) for tag in (AS_IT_IS, *features))))
    return wide.select(*others, copies.alias("_copy")).select(*others, "_copy.*")


def permutation_importance(
    rows: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    features: tuple[str, ...] = MODEL_FEATURES,
    seed: int = 0,
) -> DataFrame:
    """Increase of the mean absolute error per feature, largest first.

    ``score`` adds ``prediction`` to the columns it gets, as the ``transform`` of any
    fitted model does; it sees all copies in one pass.
    """
    scored = score(shuffled_copies(rows, features, seed))
    errors = scored.groupBy("permuted").agg(
        F.avg(F.abs(F.col(TARGET) - F.col("prediction"))).alias("mae")
    )
    # One row per feature; the one of unchanged rows is what they are compared with.
    base = errors.where(F.col("permuted") == AS_IT_IS).agg(F.max("mae")).scalar()
    return (
        errors.where(F.col("permuted") != AS_IT_IS)
        .select(
            F.col("permuted").alias("feature"),
            (F.col("mae") - base).alias("importance"),
            "mae",
        )
        .orderBy(F.desc("importance"), "feature")
    )
