import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from flagstone.config import LABEL
from flagstone.plans import model, serving
from flagstone.schemas import TRAINING
from flagstone.sources import writers


@pytest.fixture(scope="module")
def table(spark):
    random.seed(5)
    data = []
    for n in range(400):
        views, category = random.randint(0, 50), random.choice(["Rice", "Soup", None])
        label = int(views + (30 if category == "Soup" else 0) + random.gauss(0, 5) > 40)
        values = dict.fromkeys(TRAINING.names, 1) | {"image_id": f"i{n}", "views_1hr": views, "category": category, LABEL: label}
        for name in ("view_velocity_per_min", "comment_to_view_ratio", "recent_engagement_score"):
            values[name] = 1.0
        data.append(tuple(values[c] for c in TRAINING.names))
    return spark.createDataFrame(data, TRAINING)


@pytest.fixture(scope="module")
def fitted(table):
    return model.train(table)


def auc(scored):
    ready = scored.selectExpr("moderation_probability", f"cast({LABEL} as double) as y")
    return BinaryClassificationEvaluator(rawPredictionCol="moderation_probability", labelCol="y").evaluate(ready)


def test_model_separates_the_classes(table, fitted):
    scored = model.score_model(fitted, table, version=3)
    assert auc(scored) > 0.95
    bounds = scored.selectExpr("min(moderation_probability)", "max(moderation_probability)", "max(model_version)").first()
    assert bounds[0] >= 0 and bounds[1] <= 1 and bounds[2] == 3
    assert scored.select(*TRAINING.names).schema == table.schema


def test_training_is_repeatable(table, fitted):
    again = model.train(table)
    assert again.stages[-1].coefficients.toArray() == pytest.approx(fitted.stages[-1].coefficients.toArray())


def test_unknown_category_is_scored(table, fitted):
    odd = table.limit(1).selectExpr("* except (category)", "'Never seen' as category")
    assert model.score_model(fitted, odd).count() == 1


def test_many_categories_are_trained(table):
    many = table.selectExpr("* except (category)", "concat('c', monotonically_increasing_id()) as category")
    wide = many.crossJoin(many.sparkSession.range(30)).selectExpr(
        "* except (category, id)", "concat(category, '-', id) as category"
    )
    assert wide.select("category").distinct().count() > 10_000
    assert model.score_model(model.train(wide, max_iter=2), wide).count() == wide.count()


def test_numeric_model(table):
    small = model.train(table, numeric_only=True)
    assert auc(model.score_model(small, table, numeric_only=True)) > 0.7


def test_store_and_reload_only_when_changed(spark, fitted, tmp_path):
    root = str(tmp_path)
    assert writers.load_latest_model(spark, root) == (None, None)
    writers.save_model(fitted, root, 1)
    loaded, pointer = writers.load_latest_model(spark, root)
    assert loaded is not None and pointer["version"] == 1
    assert writers.load_latest_model(spark, root, pointer) == (None, pointer)
    writers.save_model(fitted, root, 2)
    loaded, pointer = writers.load_latest_model(spark, root, pointer)
    assert loaded is not None and pointer["version"] == 2


def test_modes(table, fitted):
    modes = [
        serving.decide(table, use_model=use, model=m).first()["inference_mode"]
        for use, m in ((False, fitted), (True, None), (True, fitted))
    ]
    assert modes == ["heuristic", "heuristic_fallback", "model"]
