import pytest

from flagstone.config import Settings
from flagstone.operators import quality as q
from flagstone.operators.windows import tumbling_counts
from flagstone.plans import training_table as tt
from flagstone.schemas import TRAINING
from helpers import at, events, rows

DAY = 86400
USERS = "id string, username string, created_at timestamp"
IMAGES = "id string, user_id string, caption string, category string, uploaded_at timestamp"
WINDOWS = "image_id string, window_start timestamp, window_end timestamp, event_count long"
FLAGS = "image_id string, created_at timestamp"


def build(spark, images, flags=(), views=(), comments=(), users=None, **kwargs):
    users = users or [("u", "n", at(-3 * DAY))]
    make = spark.createDataFrame
    return tt.build_training_data(
        make(users, USERS),
        make(images, IMAGES),
        make(list(flags), FLAGS),
        make(list(views), WINDOWS),
        make(list(comments), WINDOWS),
        **kwargs,
    )


def test_a_bucket_counts_only_if_it_lies_between_upload_and_cutoff(spark):
    views = [(i, at(s), at(s + 300), n) for i in ("on", "off") for s, n in ((-300, 1), (0, 2), (300, 4), (1500, 8))]
    images = [("on", "u", None, None, at(0)), ("off", "u", None, None, at(1))]
    table = build(spark, images, views=views)
    assert rows(table, "image_id", "decision_point_minutes", "views_5min", "views_1hr") == [
        ("off", 0, 0, 0),
        ("off", 5, 0, 0),
        ("off", 30, 8, 12),
        ("on", 0, 0, 0),
        ("on", 5, 2, 2),
        ("on", 30, 8, 14),
    ]
    assert q.leakage(table).count() == 0
    assert q.inconsistent_features(table).count() == 0


def test_label_interval_includes_both_ends(spark):
    images = [(f"i{n}", "u", None, None, at(0)) for n in range(5)]
    flags = [("i0", at(0)), ("i1", at(DAY)), ("i2", at(DAY + 0.000001)), ("i3", at(-0.000001)), (None, at(5))]
    labelled = tt.labels(spark.createDataFrame(images, IMAGES), spark.createDataFrame(flags, FLAGS))
    assert rows(labelled) == [("i0",), ("i1",)]


def test_label_with_flags_on_both_sides(spark):
    images = [("i", "u", None, None, at(0)), ("j", "u", None, None, at(0))]
    flags = [("i", at(-50)), ("i", at(DAY + 50)), ("j", at(-50)), ("j", at(100)), ("j", at(DAY + 50))]
    labelled = tt.labels(spark.createDataFrame(images, IMAGES), spark.createDataFrame(flags, FLAGS))
    assert rows(labelled) == [("j",)]


def test_user_features(spark):
    users = [("u", "n", at(-1.5 * DAY)), ("late", "m", at(1.5 * DAY))]
    images = [
        ("a", "u", "hi", "Soup", at(0)),
        ("b", "u", "", None, at(300)),
        ("c", "late", None, "Odd", at(0)),
        ("d", "nobody", None, None, at(0)),
    ]
    table = build(spark, images, users=users)
    got = rows(table, "image_id", "decision_point_minutes", "user_image_count", "user_age_days", "category")
    assert got == [
        ("a", 0, 1, 1, "Soup"),
        ("a", 5, 2, 1, "Soup"),
        ("a", 30, 2, 1, "Soup"),
        ("b", 0, 2, 1, "Unknown"),
        ("b", 5, 2, 1, "Unknown"),
        ("b", 30, 2, 1, "Unknown"),
        ("c", 0, 1, -1, "Odd"),
        ("c", 5, 1, -1, "Odd"),
        ("c", 30, 1, -1, "Odd"),
    ]
    content = table.select("image_id", "caption_length", "has_caption", "hour_of_day", "day_of_week", "is_weekend")
    assert rows(content.distinct()) == [("a", 2, 1, 10, 0, 0), ("b", 0, 0, 10, 0, 0), ("c", 0, 0, 10, 0, 0)]
    assert table.schema.names == TRAINING.names


def test_only_mature_images(spark):
    images = [("a", "u", None, None, at(0)), ("b", "u", None, None, at(10))]
    assert rows(build(spark, images, mature_at=at(DAY)).select("image_id").distinct()) == [("a",)]


def test_milestone_mode(spark):
    make = spark.createDataFrame
    table = tt.build_training_data(
        make([("u", "n", at(0))], USERS),
        make([("i", "u", None, None, at(0))], IMAGES),
        make([], FLAGS),
        mode="milestone",
        comments=make([("i", at(s)) for s in (-1, 0, 300, 301, 1800)], "image_id string, created_at timestamp"),
        milestones=make(
            [("i", "views", 10, at(100)), ("i", "views", 100, at(1800)), ("i", "likes", 1000, at(1))],
            "image_id string, milestone_type string, milestone_value int, reached_at timestamp",
        ),
    )
    got = rows(table, "decision_point_minutes", "views_1hr", "views_5min", "comments_1hr", "comments_5min")
    assert got == [(0, 0, 0, 1, 1), (5, 10, 10, 2, 2), (30, 100, 16, 4, 0)]


def test_schema_check(spark):
    table = build(spark, [("a", "u", None, None, at(0))])
    assert q.schema_problems(table) == []
    bad = table.drop("category").withColumnRenamed("views_5min", "views_1min")
    assert q.schema_problems(bad) == [("views_5min", "missing"), ("category", "missing"), ("views_1min", "forbidden")]


def test_settings_scale_the_formulas(spark):
    settings = Settings(window_5min=600)
    views = [("i", at(0), at(300), 6), ("i", at(300), at(600), 6)]
    table = build(spark, [("i", "u", None, None, at(0))], views=views, settings=Settings(window_5min=600, decision_points=(10,)))
    assert rows(table, "views_5min", "view_velocity_per_min") == [(12, 12 / (settings.window_5min / 60))]


def test_history_outside_the_uploads_is_pruned_in_the_scan(spark, tmp_path):
    from datetime import timedelta

    users = spark.createDataFrame([("u", at(-86_400))], "id string, created_at timestamp")
    images = [("a", "u", None, None, at(0)), ("b", "u", "x", "Rice", at(7200)), ("c", "u", "y", "Rice", at(90_000))]
    images = spark.createDataFrame(images, "id string, user_id string, caption string, category string, uploaded_at timestamp")
    flags = [("a", at(5)), ("b", at(90_000)), ("b", at(200_000)), ("c", at(90_001))]
    log = [(i, "view", 300.0 * k) for k in range(600) for i in "abc"]
    windows = tumbling_counts(events(spark, log))
    for name, frame in (("w", windows), ("f", spark.createDataFrame(flags, "image_id string, created_at timestamp"))):
        frame.write.parquet(str(tmp_path / name))
    windows, flags = (spark.read.parquet(str(tmp_path / n)) for n in "wf")
    assert tt.upload_range(images.where("id <> 'c'")) == (at(0), at(7200) + timedelta(microseconds=1))
    assert tt.upload_range(images.limit(0)) is None
    whole = tt.build_training_data(users, images, flags, windows=windows)
    some = tt.build_training_data(users, images, flags, windows=windows, uploaded=(at(0), at(7201)))
    assert rows(some) == [r for r in rows(whole) if r[0] != "c"] and some.count() == 6
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = some._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(window_start," in plan and "LessThan(window_start," in plan
    assert "GreaterThanOrEqual(created_at," in plan and "LessThanOrEqual(created_at," in plan


def test_daily_job_keeps_one_copy_and_takes_whole_days(spark):
    from flagstone.plans.daily import run_daily

    day = at(0).replace(hour=0)
    users = spark.createDataFrame([("u", at(-86_400))], "id string, created_at timestamp")
    images = spark.createDataFrame(
        [(f"i{k}", "u", None, None, at(3600 * 10 * k)) for k in range(8)],
        "id string, user_id string, caption string, category string, uploaded_at timestamp",
    )
    flags = spark.createDataFrame([("i0", at(60)), ("i3", at(3600 * 31))], "image_id string, created_at timestamp")
    windows = tumbling_counts(events(spark, [(f"i{k}", "view", 36_000.0 * k + 1) for k in range(8)]))
    job = lambda a, b: run_daily(users, images, flags, windows, a, b, "daily_a.training")
    counts = rows(job(day, day.replace(day=day.day + 2)))
    assert counts == [(0, 6), (1, 6)]  # four images, two of them flagged within a day
    for _ in range(2):
        job(day, day.replace(day=day.day + 4))
    table = spark.table("daily_a.training")
    assert table.count() == 24 and table.select("image_id", "decision_point_minutes").distinct().count() == 24
    with pytest.raises(ValueError, match="whole days"):
        job(at(0), at(3600))
