import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from stockloom.models import boosting, demand_models, importance, levels, seasonal, topics, validation
from stockloom.operators import demand, evaluation
from stockloom.plans import catalog
from stockloom.session import materialize


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(11)
    start = datetime(2016, 9, 6)
    rows = []
    for number, level in enumerate((2, 8, 20, 5)):
        for week in range(95):
            season = 1.0 + 0.5 * np.sin(2 * np.pi * week / 52)
            for i in range(int(rng.poisson(level * season))):
                rows.append(
                    (
                        f"{number}-{week}-{i}",
                        f"c{number}",
                        start + timedelta(days=7 * week + int(rng.integers(0, 7))),
                        10.0 * (number + 1),
                        2.0,
                        f"s{int(rng.integers(0, 5))}",
                    )
                )
    lines = spark.createDataFrame(
        rows,
        "order_id string, product_category string, order_purchase_timestamp timestamp_ntz, "
        "price double, freight_value double, seller_id string",
    )
    grid = demand.demand_grid(materialize(demand.weekly_demand(lines)))
    return materialize(demand.features_from_grid(grid))


def errors(model, test):
    return evaluation.forecast_metrics(
        evaluation.results_table(model.transform(test))
    ).first()


FITS = {
    "tweedie_regression": demand_models.fit_tweedie_regression,
    "boosted_trees": lambda rows: demand_models.fit_boosted_trees(rows, rounds=10, step=0.3),
    "boosted_tweedie": lambda rows: demand_models.fit_boosted_tweedie(rows, rounds=8, step=0.4),
}


@pytest.mark.parametrize("name", list(FITS))
def test_models_beat_the_mean_and_survive_storage(features, name, tmp_path):
    train, test = demand.train_rows(features, 2018, 3), demand.test_rows(features, 2018, 3)
    model = FITS[name](train)
    found = errors(model, test)
    mean = train.agg(F.avg("quantity_sold")).first()[0]
    constant = test.select(F.avg(F.abs(F.col("quantity_sold") - mean))).first()[0]
    assert found.mae < 0.7 * constant
    demand_models.save_model(model, str(tmp_path / "model"))
    again = errors(demand_models.load_model(str(tmp_path / "model")), test)
    assert again.mae == pytest.approx(found.mae)


def test_boosted_tweedie_forecasts_are_positive(features):
    train, test = demand.train_rows(features, 2018, 3), demand.test_rows(features, 2018, 3)
    scored = FITS["boosted_tweedie"](train).transform(test)
    assert scored.where("prediction <= 0").count() == 0


def test_validation_rows_come_from_the_end_of_training(features):
    train = demand.train_rows(features, 2018, 3)
    marked = demand_models.mark_validation(train, 8)
    row = marked.groupBy("is_validation").agg(
        F.min("order_purchase_timestamp").alias("lo"), F.max("order_purchase_timestamp").alias("hi")
    )
    found = {r.is_validation: r for r in row.collect()}
    assert found[False].hi < found[True].lo
    assert (found[True].hi - found[True].lo).days == 7 * 7


@pytest.mark.parametrize("categories", [26, 100_000])
def test_levels_use_strictly_earlier_weeks_at_any_size(spark, categories):
    weeks = 4 if categories > 1000 else 30
    rows = spark.range(categories * weeks).selectExpr(
        f"concat('c', id % {categories}) as product_category",
        f"timestamp_ntz'2018-01-01' + make_dt_interval(cast(7 * (id div {categories}) as int)) as order_purchase_timestamp",
        "cast(pmod(hash(id), 50) as bigint) as quantity_sold",
    )
    frame = levels.add_ordered_levels(rows).toPandas()
    frame = frame.sort_values(["product_category", "order_purchase_timestamp"])
    totals = frame.groupby("order_purchase_timestamp").quantity_sold.agg(["sum", "count"])
    prior = (totals["sum"].cumsum().shift() / totals["count"].cumsum().shift()).fillna(0.0)
    own = frame.groupby("product_category").quantity_sold
    before = own.cumsum() - frame.quantity_sold
    expected = (before + 8.0 * frame.order_purchase_timestamp.map(prior)) / (own.cumcount() + 8.0)
    assert len(frame) == categories * weeks
    assert np.allclose(frame.category_level, expected)
    final = levels.final_levels(rows).toPandas().set_index("product_category").category_level
    assert len(final) == categories + 1
    mean = frame.quantity_sold.mean()
    assert np.allclose(final.loc["c7"], (frame[frame.product_category == "c7"].quantity_sold.sum() + 8 * mean) / (weeks + 8))
    assert final[final.index.isna()].iloc[0] == pytest.approx(mean)


def test_unseen_categories_have_the_level_of_all(features):
    train, test = demand.train_rows(features, 2018, 3), demand.test_rows(features, 2018, 3)
    model = FITS["boosted_tweedie"](train)
    strange = test.withColumn("product_category", F.lit("never seen"))
    assert model.transform(strange).where("prediction is null").count() == 0
    assert model.transform(test).columns == [*test.columns, "prediction"]


def test_first_tree_equals_brute_force(spark):
    """Every cut of the root is tried by hand, and the leaves are Newton steps."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = rng.poisson(np.exp(0.2 * x[:, 1])).astype(float)
    table = spark.createDataFrame(
        [(*map(float, row), float(t), bool(i % 10 == 0)) for i, (row, t) in enumerate(zip(x, y))],
        "a double, b double, c double, y double, is_validation boolean",
    ).repartition(3)
    forest = boosting.fit_forest(table, ("a", "b", "c"), "y", 1.5, 1, 1.0, 1, 5, 64)
    keep = np.arange(400) % 10 != 0
    x, y = x[keep], y[keep]
    m = math.log(y.mean())
    g = np.exp(0.5 * m) - y * np.exp(-0.5 * m)
    h = 0.5 * np.exp(0.5 * m) + 0.5 * y * np.exp(-0.5 * m)
    best = max(
        (
            g[x[:, f] <= t].sum() ** 2 / (h[x[:, f] <= t].sum() + 1)
            + g[x[:, f] > t].sum() ** 2 / (h[x[:, f] > t].sum() + 1), f, t,
        )
        for f in range(3) for t in range(11)
    )
    tree = forest.trees[0]
    assert (tree.feature[0], tree.threshold[0]) == best[1:]
    left = x[:, best[1]] <= best[2]
    assert tree.value[1] == pytest.approx(-g[left].sum() / (h[left].sum() + 1))
    assert tree.value[2] == pytest.approx(-g[~left].sum() / (h[~left].sum() + 1))
    assert boosting.Forest.loads(forest.dumps()).dumps() == forest.dumps()


def test_importances_cover_all_features(spark, features):
    model = FITS["boosted_trees"](demand.train_rows(features, 2018, 3))
    rows = demand_models.feature_importance(spark, model).collect()
    assert {r.feature for r in rows} == set(demand.MODEL_FEATURES)
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    values = [r.importance for r in rows]
    assert values == sorted(values, reverse=True)


@pytest.mark.parametrize("name", list(FITS))
def test_permutations_tell_what_each_model_uses(features, name):
    train, test = demand.train_rows(features, 2018, 3), demand.test_rows(features, 2018, 3)
    model = FITS[name](train)
    rows = importance.permutation_importance(test, model.transform).collect()
    assert {r.feature for r in rows} == set(demand.MODEL_FEATURES)
    by_name = {r.feature: r.importance for r in rows}
    assert max(by_name.values()) > 0.2
    # A feature equal for all rows of a week cannot matter within it.
    assert abs(by_name["weeks_to_bf"]) < 1e-9


def test_shuffled_copies_deal_every_value_to_another_row(spark, features):
    rows = features.select("product_category", demand.WEEK, "quantity_sold", "sales_lag_1").limit(200)
    rows = materialize(rows.withColumn("mark", F.concat_ws("|", "product_category", demand.WEEK)))
    frame = importance.shuffled_copies(rows, ("mark", "sales_lag_1"), 3).toPandas()
    assert len(frame) == 3 * rows.count()
    moved = frame[frame.permuted == "mark"]
    own = moved.product_category + "|" + moved[demand.WEEK].astype(str)
    alone = moved.groupby(demand.WEEK).mark.transform("size") == 1
    assert (moved.mark.str[:4] != own.str[:4])[~alone].all()
    assert sorted(moved.mark) == sorted(frame[frame.permuted == "none"].mark)
    again = importance.shuffled_copies(rows, ("mark", "sales_lag_1"), 3).toPandas()
    assert sorted(map(tuple, frame.astype(str).values)) == sorted(map(tuple, again.astype(str).values))


def test_cross_validation_scores_every_fold(features):
    rows = validation.cross_validation_scores(
        features, demand_models.fit_tweedie_regression, folds=2, horizon_weeks=6
    ).collect()
    assert [(r.fold, r["rows"]) for r in rows] == [(1, 24), (2, 24)]


def test_seasonal_baseline_finds_trend_and_season(spark):
    start = datetime(2015, 1, 5)
    weeks = np.arange(150)
    sold = 50 + 0.2 * weeks + 10 * np.sin(2 * np.pi * weeks * 7 / 365.25)
    grid = spark.createDataFrame(
        [("a", start + timedelta(days=7 * int(w)), float(q)) for w, q in zip(weeks, sold)],
        "product_category string, order_purchase_timestamp timestamp_ntz, quantity_sold double",
    )
    rows = seasonal.seasonal_baseline(grid).orderBy("order_purchase_timestamp").collect()
    assert len(rows) == 163 and sum(r.is_forecast for r in rows) == 13
    ahead = np.arange(150, 163)
    expected = 50 + 0.2 * ahead + 10 * np.sin(2 * np.pi * ahead * 7 / 365.25)
    assert [r.predicted for r in rows[150:]] == pytest.approx(list(expected), abs=0.5)
    assert all(r.lower <= r.predicted <= r.upper for r in rows)
    assert rows[-1].actual is None or np.isnan(rows[-1].actual)


def test_topics_separate_two_vocabularies(spark):
    parts = ["assembly screws missing instructions", "color fabric shade mismatch"]
    texts = [(f"{parts[i % 2]} the and {parts[i % 2]}",) for i in range(80)]
    df = spark.createDataFrame(texts, "review_comment_message string")
    rows = topics.topic_terms(df, topics=2, terms=4, iterations=20).collect()
    found = {frozenset(r.term for r in rows if r.topic == t) for t in (0, 1)}
    assert found == {frozenset(part.split()) for part in parts}


def test_topics_count_words_without_caching_them(spark, monkeypatch):
    """Cached arrays of words are many times a text's size; a number of texts needs none."""
    fitted = []
    monkeypatch.setattr(
        topics, "CountVectorizer", lambda **given: fitted.append(given) or CountVectorizer(**given)
    )
    texts = [("assembly screws missing",)] * 9 + [("assembly fabric",)] + [(None,)] * 10
    df = spark.createDataFrame(texts, "review_comment_message string")
    for share, least in ((0.2, 2.0), (0.0005, 1.0), (3, 3)):
        rows = topics.topic_terms(df, topics=2, terms=4, iterations=2, min_documents=share).collect()
        assert fitted[-1]["minDF"] == least
        assert ("fabric" in {row.term for row in rows}) == (least == 1.0)


@pytest.mark.parametrize(("limit", "parts"), [(40_000_000, 1), (100, 16)])
def test_texts_of_one_part_are_dealt_to_tasks_by_their_length(spark, monkeypatch, limit, parts):
    monkeypatch.setattr(topics, "CHARACTERS_PER_TASK", limit)
    seen = []
    monkeypatch.setattr(
        topics, "materialize", lambda df: seen.append(df.rdd.getNumPartitions()) or materialize(df)
    )
    texts = [("assembly screws to be missing in instructions"[:40],)] * 40
    df = spark.createDataFrame(texts, "review_comment_message string").coalesce(1)
    assert topics.topic_terms(df, topics=2, terms=3, iterations=2).count() == 6
    assert seen == [parts]


@pytest.mark.parametrize(
    ("name", "fit"),
    [
        ("demand_model_gbt", "fit_boosted_trees"),
        ("demand_model_boosted", "fit_boosted_tweedie"),
        ("feature_importance", "fit_boosted_trees"),
    ],
)
def test_registered_fits_keep_their_defaults(spark, monkeypatch, name, fit):
    class Called(Exception):
        pass

    def recorded(train, **settings):
        raise Called(settings)

    monkeypatch.setattr(demand_models, fit, recorded)
    with pytest.raises(Called) as called:
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert called.value.args == ({},)
