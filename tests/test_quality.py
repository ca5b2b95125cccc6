import random

import numpy as np
import pytest

from flagstone.operators import quality as q
from flagstone.operators import selection
from helpers import at, rows


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_percentiles_are_exact(spark, size):
    random.seed(size)
    values = [round(random.expovariate(0.05), 2) for _ in range(size)] + [5.0] * (size // 3)
    df = spark.createDataFrame([(v,) for v in values], "latency_ms double")
    row = q.latency_summary(df, accuracy=100).first()
    for name, p in (("p50_ms", 50), ("p95_ms", 95), ("p99_ms", 99)):
        assert row[name] == pytest.approx(np.percentile(values, p), abs=1e-9)
    assert row.mean_ms == pytest.approx(np.mean(values))
    assert row.meets_target == (np.percentile(values, 99) < 50)


@pytest.mark.parametrize("bound", [1, 40, 10**6])
def test_order_statistics_survive_brackets_that_miss(spark, monkeypatch, bound):
    random.seed(3)
    values = [float(random.choice([random.randint(0, 9), random.randint(0, 10**6)])) for _ in range(3000)]
    values += [-5.0] * 700 + [2e6] * 300
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    ordered, n = sorted(values), len(values)
    scans = []
    counted = selection._counted
    monkeypatch.setattr(selection, "_counted", lambda *a: scans.append(a[1]) or counted(*a))
    ranks = [0, 1, 699, 700, n // 2, n - 301, n - 300, n - 1]
    wrong = {0: (1e5, 2e5), 699: (0.0, 3.0), n // 2: (-5.0, -5.0), n - 1: (-5.0, 0.0)}
    found = selection.order_statistics(df, ranks, ordered[0], ordered[-1], n, wrong, 50, bound)
    assert found == {r: ordered[r] for r in ranks}
    right = {r: (ordered[max(0, r - 9)], ordered[min(n - 1, r + 9)]) for r in ranks}
    scans.clear()
    found = selection.order_statistics(df, ranks, ordered[0], ordered[-1], n, right, 50, 10**6)
    assert found == {r: ordered[r] for r in ranks} and len(scans) == 1  # after the sketch, one more


def test_percentiles_of_many_rows_take_two_scans(spark, monkeypatch):
    df = spark.range(50_000).selectExpr("pmod(xxhash64(id), 20000) / 7 as latency_ms")
    values = [r[0] for r in df.collect()]
    scans = []
    counted = selection._counted
    monkeypatch.setattr(selection, "_counted", lambda *a: scans.append(a[1]) or counted(*a))
    row = q.latency_summary(df, accuracy=1000).first()
    for name, p in (("p50_ms", 50), ("p95_ms", 95), ("p99_ms", 99)):
        assert row[name] == pytest.approx(np.percentile(values, p), abs=1e-9)
    assert len(scans) == 1 and all(low > 0 for low, _ in scans[0])


def test_percentiles_of_nothing(spark):
    row = q.latency_summary(spark.createDataFrame([], "latency_ms double")).first()
    assert row.p99_ms is None and row.mean_ms is None and not row.meets_target


def test_decision_statistics(spark):
    df = spark.createDataFrame(
        [("heuristic", 0.2, "SAFE"), ("heuristic", 0.8, "FLAG"), ("model", 0.5, "REVIEW")],
        "inference_mode string, moderation_probability double, recommendation string",
    )
    assert rows(q.decision_statistics(df)) == [("heuristic", 2, 0.5, 1, 0, 1), ("model", 1, 0.5, 0, 1, 0)]


def test_duplicates_and_topics(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "topic string, v int")
    assert rows(q.duplicates(df, ["topic", "v"])) == [("a", 1, 2)]
    assert rows(q.topic_counts(df)) == [("a", 2), ("all", 3), ("b", 1)]


def test_reconcile_reports_missing_on_either_side(spark):
    counts = spark.createDataFrame([("i", "view", 3), ("j", "view", 1)], "image_id string, event_type string, event_count long")
    raw = spark.createDataFrame([("i", "view")] * 3 + [("k", "flag")], "image_id string, event_type string")
    assert rows(q.reconcile(counts, raw)) == [("j", "view", 1, 0), ("k", "flag", 0, 1)]


def test_reports(spark):
    images = spark.createDataFrame(
        [("a", 1, at(0)), ("b", 0, at(9)), ("c", 2, at(5))], "id string, views int, uploaded_at timestamp"
    )
    assert rows(q.most_recent_active(images), "id") == [("c",)]
    assert q.random_image(images, 1).first() == q.random_image(images.repartition(3), 1).first()
    assert not q.table_exists(spark, "no_such_table")
