"""The split plans for hot keys give the same rows as a direct computation."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.operators.alerts import first_alerts, milestone_crossings
from flagstone.operators.asof import attach_latest
from flagstone.operators.skew import hot_keys, restrict, running, skew_join
from flagstone.operators.windows import rolling_counts, running_total
from flagstone.plans import training_table as tt
from helpers import EVENT, at, rows

LIMITS = (10**6, 4)


@pytest.fixture(scope="module")
def data():
    random.seed(7)
    out = []
    for n in range(260):
        key = random.choice("aaaabc")
        second = random.choice([0, 1, 2, 59, 60, 61, 299, 300, 301, 3599, 3600, 3601, 86400, 90000])
        kind = random.choice(["view", "view", "comment", "flag"])
        out.append((key, f"e{n:04d}", kind, at(second + random.choice([0, 0.000001, 0.5]))))
    return out + [out[5], out[6]]


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, EVENT)


def test_hot_keys(frame):
    assert hot_keys(frame, ["image_id"], 10**6) is None
    assert {r[0] for r in hot_keys(frame, ["image_id"], 60).collect()} == {"a"}


@pytest.mark.parametrize("limit", LIMITS)
def test_running_sum_sees_peers(frame, data, limit):
    got = running(
        frame.withColumn("us", F.unix_micros("ts")),
        ["image_id"],
        "us",
        sums={"n": F.lit(1)},
        peers={"same": F.lit(1)},
        limit=limit,
    )
    want = sorted(
        (
            k,
            e,
            sum(x[0] == k and x[3] <= t for x in data),
            sum(x[0] == k and x[3] == t for x in data),
        )
        for k, e, _, t in data
    )
    assert rows(got, "image_id", "event_id", "n", "same") == want


@pytest.mark.parametrize("limit", LIMITS)
def test_running_total_numbers_every_event_once(frame, data, limit):
    got = rows(running_total(frame, "view", limit), "image_id", "ts", "total")
    want = []
    for key in "abc":
        times = sorted(t for k, _, kind, t in data if k == key and kind == "view")
        want += [(key, t, i) for i, t in enumerate(times, 1)]
    assert got == sorted(want)


@pytest.mark.parametrize("limit", LIMITS)
def test_rolling_counts(frame, data, limit):
    settings = Settings()

    def count(key, metric, kind, t, width):
        delta = at(width) - at(0)
        hits = [
            (e, x)
            for k, e, m, x in data
            if k == key and m == metric and (t - delta < x <= t or (m != kind and x == t - delta))
        ]
        return len(set(hits) if metric == "comment" else hits)

    want = {
        (k, e, kind, t)
        + tuple(count(k, m, kind, t, w) for m in ("view", "comment") for _, w in settings.rolling)
        + tuple(sum(x[0] == k and x[2] == m and x[3] <= t for x in data) for m in ("view", "comment", "flag"))
        for k, e, kind, t in data
        if kind != "flag"
    }
    assert {tuple(r) for r in rolling_counts(frame, settings, limit=limit).collect()} == want


@pytest.mark.parametrize("limit", LIMITS)
def test_milestones(frame, data, limit):
    settings = Settings(milestones=(1, 10, 40))
    want = []
    for key in "abc":
        times = sorted(t for k, _, kind, t in data if k == key and kind == "view")
        want += [(key, m, times[m - 1]) for m in settings.milestones if len(times) >= m]
    got = milestone_crossings(frame.where("event_type = 'view'"), settings, limit)
    assert rows(got, "image_id", "milestone_value", "reached_at") == sorted(want)


def test_alerts_do_not_depend_on_the_split(frame):
    settings = Settings(viral_views_5min=5, suspicious_comments_1min=3, popular_views_1hr=9)
    plain, split = (
        rows(first_alerts(rolling_counts(frame, settings, limit=n), settings)) for n in LIMITS
    )
    assert plain and plain == split


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join(spark, limit, how):
    fact = spark.createDataFrame(
        [("a", i) for i in range(20)] + [("b", 1), ("c", 2), (None, 3)], "k string, v int"
    )
    dim = spark.createDataFrame([("a", 10), ("b", 20), ("d", 30)], "k string, w int")
    want = fact.join(dim, ["k"], how)
    got = skew_join(fact, dim, ["k"], how, limit)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_restrict_keeps_rows_of_the_keys(frame):
    keys = frame.where("image_id <> 'a'")
    kept = restrict(frame, keys, ["image_id"])
    assert kept.where("image_id = 'a'").count() == 0
    assert kept.count() == keys.count()


@pytest.mark.parametrize("limit", LIMITS)
def test_as_of_join(spark, limit):
    facts = spark.createDataFrame(
        [("a", i, at(i)) for i in range(12)] + [("b", 99, at(1)), (None, 98, at(9))],
        "k string, id int, ts timestamp",
    )
    versions = spark.createDataFrame(
        [("a", at(2), "x"), ("a", at(5), "y"), ("c", at(0), "z"), (None, at(1), "n")], "k string, since timestamp, v string"
    )
    got = attach_latest(facts, versions, ["k"], "ts", "since", limit=limit)
    want = [("a", i, None if i < 2 else "x" if i < 5 else "y") for i in range(12)] + [("b", 99, None), (None, 98, None)]
    assert sorted(map(str, got.select("k", "id", "v").collect())) == sorted(
        f"Row(k={k!r}, id={i!r}, v={v!r})" for k, i, v in want
    )


def test_training_table_does_not_depend_on_the_split(spark):
    random.seed(3)
    users = spark.createDataFrame([("u1", "n1", at(-90000)), ("u2", "n2", at(5))], "id string, username string, created_at timestamp")
    images = spark.createDataFrame(
        [(f"i{n}", random.choice(["u1", "u1", "u2", "gone"]), None, "Rice", at(300 * n)) for n in range(40)],
        "id string, user_id string, caption string, category string, uploaded_at timestamp",
    )
    flags = spark.createDataFrame([(f"i{n}", at(300 * n + 50)) for n in range(0, 40, 3)], "image_id string, created_at timestamp")
    windows = spark.createDataFrame(
        [(f"i{n}", at(300 * m), at(300 * m + 300), n + m) for n in range(40) for m in range(n, n + 8)],
        "image_id string, window_start timestamp, window_end timestamp, event_count long",
    )
    comments = spark.createDataFrame([(f"i{n % 4}", at(37.0 * n)) for n in range(200)], "image_id string, created_at timestamp")
    milestones = spark.createDataFrame(
        [(f"i{n}", "views", v, at(300 * n + v)) for n in range(40) for v in (10, 100)],
        "image_id string, milestone_type string, milestone_value int, reached_at timestamp",
    )
    for mode in ("windows", "milestone"):
        results = [
            rows(
                tt.build_training_data(
                    users, images, flags, windows, windows, replace(Settings(), hot_rows=limit), mode, comments, milestones
                )
            )
            for limit in LIMITS
        ]
        assert results[0] and results[0] == results[1]
