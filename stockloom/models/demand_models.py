"""Demand models: Tweedie regression, boosted trees, boosted Tweedie.

Every fit returns a ``DemandModel`` that scores a feature table with ``transform`` and is
stored with ``save_model``. Categories enter every model as their level of earlier sales,
so nothing depends on how many there are.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.models.boosting import Forest, fit_forest
from stockloom.models.levels import LEVEL, add_levels, add_ordered_levels, final_levels
from stockloom.operators.demand import CATEGORY, MODEL_FEATURES, TARGET, WEEK
from stockloom.session import materialize

NUMERIC_FEATURES = tuple(name for name in MODEL_FEATURES if name != CATEGORY)

# Features on the scale of money or units; the linear model takes their logarithm.
SCALED_FEATURES = tuple(
    name
    for name in NUMERIC_FEATURES
    if name.startswith(("price_lag", "price_roll", "freight_lag", "sellers", "sales"))
)

TWEEDIE_POWER = 1.1
INPUTS = (LEVEL, *NUMERIC_FEATURES)


class DemandModel:
    """Category levels after the training weeks, and a model of them and the other features.

    ``model`` is a Spark pipeline or a ``Forest``. Categories not seen in training have
    the level of all categories together.
    """

    def __init__(self, levels: DataFrame, model: PipelineModel | Forest) -> None:
        self.levels, self.model = levels, model
        row = levels.where(F.col(CATEGORY).isNull()).first()
        self.unseen = 0.0 if row is None or row[LEVEL] is None else float(row[LEVEL])

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the forecast as ``prediction``."""
        known = add_levels(rows, self.levels, self.unseen)
        if isinstance(self.model, Forest):
            return known.withColumn("prediction", self.model.forecast()).drop(LEVEL)
        return self.model.transform(known).select(*rows.columns, "prediction")

    def importances(self) -> dict[str, float]:
        """What the splits on each feature gain, summing up to 1; trees only."""
        if isinstance(self.model, Forest):
            total = sum(self.model.gains) or 1.0
            values = [gain / total for gain in self.model.gains]
        else:
            values = self.model.stages[-1].featureImportances.toArray().tolist()
        names = (CATEGORY if name == LEVEL else name for name in INPUTS)
        return dict(zip(names, values, strict=True))


def mark_validation(train: DataFrame, weeks: int) -> DataFrame:
    """``is_validation``: the last ``weeks`` weeks of the training period, never the test period."""
    start = train.agg(F.max(WEEK)).scalar() - F.make_dt_interval(F.lit(7 * weeks))
    return train.withColumn("is_validation", F.col(WEEK) > start)


def _levelled(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training rows with the level before their week, and the levels to score with."""
    return materialize(add_ordered_levels(train)), materialize(final_levels(train))


def fit_tweedie_regression(
    train: DataFrame, power: float = TWEEDIE_POWER, ridge: float = 0.01
) -> DemandModel:
    """Generalized linear model with Tweedie variance and log link."""
    rows, levels = _levelled(train)
    scaled = (LEVEL, *SCALED_FEATURES)
    logs = ", ".join(f"log1p(greatest({name}, 0)) as log_{name}" for name in scaled)
    kept = [name for name in NUMERIC_FEATURES if name not in SCALED_FEATURES]
    stages = [
        SQLTransformer(statement=f"select *, {logs} from __THIS__"),
        VectorAssembler(inputCols=[*kept, *(f"log_{name}" for name in scaled)], outputCol="features"),
        GeneralizedLinearRegression(
            family="tweedie",
            variancePower=power,
            linkPower=0.0,
            labelCol=TARGET,
            regParam=ridge,
            maxIter=25,
        ),
    ]
    return DemandModel(levels, Pipeline(stages=stages).fit(rows))


def fit_boosted_trees(
    train: DataFrame,
    rounds: int = 60,
    step: float = 0.1,
    depth: int = 5,
    validation_weeks: int = 8,
    seed: int = 42,
) -> DemandModel:
    """Gradient-boosted trees with squared loss.

    With ``validation_weeks`` the number of trees is chosen on the last weeks of
    the training period.
    """
    rows, levels = _levelled(train)
    trees = GBTRegressor(
        labelCol=TARGET,
        maxIter=rounds,
        stepSize=step,
        maxDepth=depth,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=seed,
    )
    if validation_weeks:
        rows = mark_validation(rows, validation_weeks)
        trees = trees.setValidationIndicatorCol("is_validation")
    stages = [VectorAssembler(inputCols=list(INPUTS), outputCol="features"), trees]
    return DemandModel(levels, Pipeline(stages=stages).fit(rows))


def fit_boosted_tweedie(
    train: DataFrame,
    rounds: int = 40,
    step: float = 0.25,
    depth: int = 4,
    power: float = TWEEDIE_POWER,
    validation_weeks: int = 8,
    patience: int = 5,
    bins: int = 32,
) -> DemandModel:
    """Boosted trees under the Tweedie loss, which Spark's own boosted trees do not offer.

    Features are binned once; rounds stop after ``patience`` rounds without gain on the
    last ``validation_weeks`` weeks of the training period.
    """
    rows, levels = _levelled(train)
    rows = mark_validation(rows, validation_weeks)
    forest = fit_forest(rows, INPUTS, TARGET, power, rounds, step, depth, patience, bins)
    return DemandModel(levels, forest)


def feature_importance(spark: SparkSession, model: DemandModel) -> DataFrame:
    """Importance of each feature of a tree model by gain, largest first."""
    rows = [(name, float(value)) for name, value in model.importances().items()]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def save_model(model: DemandModel, path: str) -> None:
    model.levels.write.mode("overwrite").parquet(f"{path}/levels")
    if isinstance(model.model, Forest):
        text = model.levels.sparkSession.createDataFrame([(model.model.dumps(),)], "forest string")
        text.write.mode("overwrite").parquet(f"{path}/forest")
    else:
        model.model.write().overwrite().save(f"{path}/pipeline")


def load_model(path: str) -> DemandModel:
    spark = SparkSession.getActiveSession()
    levels = spark.read.parquet(f"{path}/levels")
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/forest")
    if files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
        forest = spark.read.parquet(f"{path}/forest").first().forest
        return DemandModel(levels, Forest.loads(forest))
    return DemandModel(levels, PipelineModel.load(f"{path}/pipeline"))
