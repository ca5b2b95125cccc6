"""Stream behaviour that has no SQL form: late data, restarts, reloads."""

from pyspark.sql import functions as F

from flagstone.config import Settings
from flagstone.operators.windows import rolling_counts
from flagstone.plans import model
from flagstone.sources import writers
from flagstone.streaming import jobs
from flagstone.streaming import state as st
from helpers import at, events, rows

COUNTED = "image_id string, event_type string, ts timestamp, n long"


def counted(spark, data):
    return spark.createDataFrame([(i, k, at(s), n) for i, k, s, n in data], COUNTED)


def feed(spark, tmp_path, batches, build, target=None, mode="append"):
    """Run one micro-batch per frame and return the output folder and the last query."""
    source, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    for batch in batches:
        batch.write.mode("append").parquet(source)
        stream = spark.readStream.schema(batch.schema).parquet(source)
        query = jobs.run_available(build(stream), target or out, checkpoint, mode)
    return out, query


def test_state_equals_batch_over_restarts(spark, tmp_path):
    data = [("i", ("view", "view", "comment")[n % 3], n * 7.5) for n in range(90)]
    frame = events(spark, data)
    parts = [
        frame.where((F.col("event_id") >= f"e{lo:05d}") & (F.col("event_id") < f"e{lo + 30:05d}"))
        .select("image_id", "event_type", "ts", F.lit(1).cast("long").alias("n"))
        for lo in (0, 30, 60)
    ]
    out, _ = feed(spark, tmp_path, parts, lambda s: st.rolling_state(s, Settings(), "1 minute"))
    names = ["event_type", "ts"] + [f"{m}_{w}" for m in ("views", "comments") for w in ("1min", "5min", "1hr")]
    assert rows(spark.read.parquet(out), *names, "total_views") == rows(rolling_counts(frame), *names, "total_views")


def test_images_of_one_slot_are_counted_apart_in_one_call(spark, tmp_path):
    # Times 200 years apart: not all images have room on one line of times.
    data = [(f"i{n % 901}", ("view", "view", "comment", "flag")[n % 4], n * 0.5) for n in range(4000)]
    data += [(f"far{n}", "view", 6_300_000_000.0 + n) for n in range(5)]
    frame = events(spark, data)
    parts = [
        frame.where(F.col("event_id").between(low, high)).select("image_id", "event_type", "ts", F.lit(1).cast("long").alias("n"))
        for low, high in (("e00000", "e01999"), ("e02000", "e04004"))
    ]
    one, _ = feed(spark, tmp_path / "one", parts, lambda s: st.rolling_state(s, Settings(), "1 minute", slots=1))
    names = ["image_id", "event_type", "ts"] + [f"{m}_{w}" for m in ("views", "comments") for w in ("1min", "5min", "1hr")]
    names += ["total_views", "total_comments", "total_flags"]
    assert rows(spark.read.parquet(one), *names) == rows(rolling_counts(frame), *names)


def test_many_images_take_few_calls(spark, tmp_path):
    batch = spark.range(3000).select(
        F.concat(F.lit("i"), "id").alias("image_id"), F.lit("view").alias("event_type"),
        F.lit(at(1)).cast("timestamp").alias("ts"), F.lit(1).cast("long").alias("n"),
    )
    out, query = feed(spark, tmp_path, [batch], lambda s: st.rolling_state(s, Settings(), "1 minute"))
    assert spark.read.parquet(out).where("total_views = 1").count() == 3000
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 512  # a state row is a call


def test_alerts_and_milestones_fire_once_over_batches(spark, tmp_path):
    parts = [counted(spark, [("i", "view", n + 60 * b, 1) for n in range(60)]) for b in range(3)]
    sink = str(tmp_path / "sinks")
    feed(spark, tmp_path, parts, lambda s: st.rolling_state(s, Settings(), "1 minute"), jobs.state_sinks(sink))
    read = lambda name: spark.read.option("recursiveFileLookup", "true").parquet(f"{sink}/{name}")
    assert rows(read("alerts"), "alert_type", "alert_ts", "observed") == [
        ("popular", at(49), 50),
        ("viral", at(99), 100),
    ]
    assert rows(read("milestones"), "milestone_value", "reached_at") == [(10, at(9)), (100, at(99))]
    assert read("requests").count() == 1


def test_a_grain_with_many_events_reaches_its_milestones(spark, tmp_path):
    part = counted(spark, [("i", "view", 0, 250), ("i", "view", 1, 800)])
    out, _ = feed(spark, tmp_path, [part], lambda s: st.rolling_state(s, Settings(), "1 minute"))
    got = rows(st.milestones_of(spark.read.parquet(out)), "milestone_value", "reached_at")
    assert got == [(10, at(0)), (100, at(0)), (1000, at(1))]


def test_idle_image_keeps_totals_only(spark, tmp_path):
    parts = [
        counted(spark, [("i", "view", 0, 5), ("j", "view", 0, 1)]),
        counted(spark, [("j", "view", 20000, 1)]),
        counted(spark, [("j", "view", 20001, 1)]),
        counted(spark, [("i", "view", 20002, 1)]),
    ]
    out, _ = feed(spark, tmp_path, parts, lambda s: st.rolling_state(s, Settings(), "1 minute"))
    mine = spark.read.parquet(out).where("image_id = 'i'")
    assert rows(mine, "ts", "views_1hr", "total_views") == [(at(0), 5, 5), (at(20002), 1, 6)]


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    parts = [
        events(spark, [("i", "view", 0), ("i", "view", 7200)]),
        events(spark, [("i", "view", 10), ("i", "view", 7300)]),
    ]
    out, query = feed(spark, tmp_path, parts, lambda s: jobs.tumbling_stream(s, watermark="10 minutes"))
    assert jobs.run_statistics(query) == {"batches": 2, "input_rows": 2, "late_rows": 1}
    assert rows(spark.read.parquet(out), "window_start", "event_count") == [(at(0), 1)]


def test_decisions_pick_up_a_new_model(spark, tmp_path):
    root, out = str(tmp_path / "models"), str(tmp_path / "decisions")
    data = events(spark, [("i", "view", n) for n in range(30)])
    images = spark.createDataFrame(
        [("i", "u", "hi", "Rice", at(-10))], "id string, user_id string, caption string, category string, uploaded_at timestamp"
    )
    users = spark.createDataFrame([("u", at(-100000))], "id string, created_at timestamp")
    sink = jobs.DecisionSink(out, lambda: data, lambda: images, lambda: users, model_root=root, check_seconds=0)
    requests = spark.createDataFrame(
        [("i", "r1", at(40), "viral"), ("gone", "r2", at(40), "viral")],
        "image_id string, event_id string, ts timestamp, trigger string",
    )
    sink(requests, 0)
    table = spark.createDataFrame(
        [(float(n % 2),) * 13 + (0, 1, "Rice", n % 2) for n in range(40)],
        [*model.MODEL_NUMERIC, *model.MODEL_CATEGORICAL, model.LABEL],
    )
    writers.save_model(model.train(table, max_iter=5), root, 1)
    sink(requests, 1)
    sink(requests, 1)
    stored = spark.read.parquet(f"{out}/decisions")
    assert rows(stored, "batch_id", "image_id", "inference_mode", "trigger_type") == [
        (0, "i", "heuristic_fallback", "viral"),
        (1, "i", "model", "viral"),
    ]


def test_requests_start_at_the_latest(spark, tmp_path):
    from datetime import datetime, timedelta, timezone

    from flagstone.operators.ingest import parse_requests
    from flagstone.schemas import ENVELOPE
    from flagstone.sources.readers import stream_requests

    now = datetime.now(timezone.utc)
    value = '{"image_id":"%s","trigger":"viral","context":{"views_5min":100},"timestamp":12.5}'
    raw = [
        ("moderation_requests", 0, n, now + timedelta(hours=h), value % name)
        for n, (h, name) in enumerate([(-1, "old"), (1, "new")])
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(raw, ENVELOPE).write.parquet(source)
    jobs.run_available(parse_requests(stream_requests(spark, path=source)), out)
    assert rows(spark.read.parquet(out), "image_id", "trigger") == [("new", "viral")]


def test_requests_between_two_starts_are_read(spark, tmp_path):
    from datetime import datetime, timedelta, timezone

    from flagstone.schemas import ENVELOPE
    from flagstone.sources.readers import stream_requests

    source, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    for name, late in [("old", -3600), ("between", 0)]:
        raw = [("moderation_requests", 0, 0, datetime.now(timezone.utc) + timedelta(seconds=late), name)]
        spark.createDataFrame(raw, ENVELOPE).write.mode("append").parquet(source)
        jobs.run_available(stream_requests(spark, path=source, checkpoint=checkpoint), out, checkpoint)
    assert rows(spark.read.parquet(out), "value") == [("between",)]


def test_ingest_stream_uses_arrival_time(spark, tmp_path):
    from flagstone.schemas import ENVELOPE

    raw = spark.createDataFrame([("views", 0, 1, at(5), '{"event_type":"view","image_id":"i"}')], ENVELOPE)
    out, _ = feed(spark, tmp_path, [raw], lambda s: jobs.parsed_stream(s).select("image_id", "ts"))
    assert rows(spark.read.parquet(out)) == [("i", at(5))]


def test_state_has_no_more_partitions_than_cores(spark, tmp_path):
    from pathlib import Path

    from flagstone.plans import queries_streams

    log = [(n, at(n * 40.0), n % 5, ("view", "click", "error", "signup")[n % 4], 1.0, '{"k": 1}') for n in range(60)]
    types = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(log, types).write.parquet(str(tmp_path / "events.parquet"))
    shared, cores = Path(spark.conf.get("spark.checkpoint.dir")), spark.sparkContext.defaultParallelism

    def state_partitions(name, run):
        before = set(shared.glob(f"{name}-checkpoint-*"))
        run()
        (checkpoint,) = set(shared.glob(f"{name}-checkpoint-*")) - before
        return len([d for d in (checkpoint / "state" / "0").iterdir() if d.name.isdigit()])

    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", cores + 4)
    try:
        by_grain = lambda: queries_streams.t2_stream_rolling_by_grain(spark, str(tmp_path)).collect()
        assert state_partitions("rolling", by_grain) == cores
        assert state_partitions("counts", lambda: queries_streams._state_output(spark, str(tmp_path))) == cores
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(cores + 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_state_jobs_are_fed_what_they_count(spark, tmp_path):
    from pathlib import Path

    from flagstone.plans import queries_streams
    from flagstone.sources import eventlog

    log = [(n, at(n * 40.0), n % 3, "view", 1.0, '{"k": 1}') for n in range(12)]
    types = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(log, types).write.parquet(str(tmp_path / "events.parquet"))
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("grains-*"))
    counts = queries_streams._grains(eventlog.load_log(spark, str(tmp_path)), "1 hour")
    assert sum(r.n for r in counts.collect()) == 12
    (fed,) = [d for d in set(shared.glob("grains-*")) - before if list(d.glob("*.parquet"))]
    assert spark.read.parquet(str(fed)).columns == ["image_id", "event_type", "ts"]
