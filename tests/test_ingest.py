import json

from pyspark.sql import functions as F

from flagstone.functions.text import category_from_path, object_key
from flagstone.functions.times import parse_instant
from flagstone.operators import ingest as ing
from flagstone.schemas import ENVELOPE
from helpers import at, rows


def envelope(spark, *values):
    data = [
        ("t", 0, n, at(1000 + n), v if isinstance(v, str) else json.dumps(v))
        for n, v in enumerate(values)
    ]
    return spark.createDataFrame(data, ENVELOPE)


def test_instants(spark):
    texts = [
        ("2024-03-04T10:00:00Z", at(0)),
        ("2024-03-04T10:00:00+00:00", at(0)),
        ("2024-03-04T05:00:00-05:00", at(0)),
        ("2024-03-04T10:00:00", at(0)),
        ("2024-03-04T10:00:00.000001", at(0.000001)),
        ("junk", None),
        ("10:00:00", None),
        ("2024", None),
        (None, None),
    ]
    df = spark.createDataFrame(texts, "text string, want timestamp")
    wrong = df.where(~parse_instant(F.col("text")).eqNullSafe(F.col("want")))
    assert wrong.count() == 0


def test_reject_reasons(spark):
    raw = envelope(
        spark,
        {"event_type": "view", "image_id": "i", "viewed_at": "2024-03-04T10:00:00"},
        {"event_type": "view", "image_id": "", "viewed_at": "2024-03-04T10:00:00"},
        {"event_type": "view", "image_id": "i", "viewed_at": "soon"},
        {"event_type": "comment", "image_id": "i", "created_at": "2024-03-04T10:00:00Z"},
        {"event_type": "flag", "flag_id": "f", "comment_id": "c", "created_at": "2024-03-04T10:00:00Z"},
        {"event_type": "flag", "flag_id": "f", "created_at": "2024-03-04T10:00:00Z"},
        {"event_type": "dance", "image_id": "i"},
        {"image_id": "i"},
        '{"event_type": "view", ',
        {"event_type": "view", "image_id": "i", "timestamp": 1709546400.5},
    )
    checked = ing.validate(ing.parse_envelopes(raw))
    assert [r[0] for r in checked.orderBy("offset").select("reject_reason").collect()] == [
        None,
        "missing_key",
        "bad_time",
        "missing_key",
        "comment_flag",
        "no_target",
        "unknown_type",
        "unknown_type",
        "bad_json",
        None,
    ]
    assert rows(ing.good(checked), "event_id", "ts") == [("t-0-0", at(0)), ("t-0-9", at(0.5))]


def test_missing_time_is_arrival_in_streams_only(spark):
    raw = envelope(spark, {"event_type": "view", "image_id": "i"})
    parsed = ing.parse_envelopes(raw)
    assert ing.good(ing.validate(parsed)).count() == 0
    assert rows(ing.validate(parsed, arrival_fallback=True), "ts") == [(at(1000),)]


def test_messages_survive_a_round_trip(spark):
    views = spark.createDataFrame([("i", at(0.25))], "image_id string, ts timestamp")
    sent = ing.view_messages(views)
    raw = sent.select(
        "topic", F.lit(0).alias("partition"), F.lit(7).cast("long").alias("offset"), F.lit(at(9)).alias("timestamp"), "value"
    )
    back = ing.good(ing.validate(ing.parse_envelopes(raw)))
    assert rows(back, "image_id", "event_type", "ts") == [("i", "view", at(0.25))]


def test_first_user_wins(spark):
    users = spark.createDataFrame(
        [("2", "ann", at(5)), ("1", "ann", at(5)), ("3", "ann", at(9)), ("4", "bob", at(1))],
        "id string, username string, created_at timestamp",
    )
    assert rows(ing.first_user_per_name(users), "username", "id") == [("ann", "1"), ("bob", "4")]


def test_paths_and_keys(spark):
    paths = [
        ("/x/class_07/a.jpg", "Rice"),
        ("class_00/a.jpg", "Bread"),
        ("/x/class_11/a.jpg", "Unknown"),
        ("/x/class_7b/a.jpg", "Unknown"),
        ("/class_03/y/a.jpg", "Unknown"),
        ("/x/a.jpg", "Unknown"),
    ]
    df = spark.createDataFrame(paths, "path string, want string")
    assert df.where(category_from_path(F.col("path")) != F.col("want")).count() == 0
    key = df.limit(1).select(object_key(F.lit("id"), F.lit("a.tar.gz"))).first()[0]
    assert key == "id.gz"


def test_replay_opens_only_files_that_can_hold_the_range(spark, tmp_path):
    from flagstone.sources import readers

    path, index = str(tmp_path / "log"), str(tmp_path / "index")
    schema = "partition int, offset long, timestamp timestamp, value string, topic string"

    def send(hours):
        rows = [(0, h, at(3600 * h + m), "x", t) for h in hours for m in (0, 3599) for t in ("views", "flags")]
        for h in hours:
            frame = spark.createDataFrame([r for r in rows if r[1] == h], schema)
            frame.coalesce(1).write.mode("append").partitionBy("topic").parquet(path)

    send(range(5))
    assert readers.index_messages(spark, path, index) == 10
    assert readers.index_messages(spark, path, index) == 0
    replay = lambda a, b: readers.read_topics_between(spark, at(a), at(b), path=path, index=index)
    hour = replay(7200, 10_800)
    assert len(hour.inputFiles()) == 2 and hour.count() == 4
    whole = readers.read_topics_between(spark, at(7200), at(10_800), path=path)
    assert len(whole.inputFiles()) == 10 and rows(whole, "topic", "timestamp") == rows(hour, "topic", "timestamp")
    assert replay(-7200, -3600).count() == 0
    send([7])  # not indexed yet
    assert replay(7 * 3600, 8 * 3600).count() == 4 and readers.index_messages(spark, path, index) == 2
    assert len(readers.read_topics_between(spark, at(0), at(1), ["views"], path=path, index=index).inputFiles()) == 1
