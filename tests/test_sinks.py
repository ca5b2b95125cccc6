from flagstone.plans.hourly import write_window_tables
from flagstone.operators.windows import tumbling_counts
from flagstone.sources import readers, writers
from helpers import at, events, rows


def test_window_tables_do_not_double_on_a_second_run(spark):
    data = events(spark, [("i", "view", s) for s in (0, 10, 400, 4000)] + [("i", "comment", 3)])
    counts = tumbling_counts(data)
    write_window_tables(counts, "lake_a")
    write_window_tables(counts, "lake_a")
    first_hour = tumbling_counts(data, start=at(0), end=at(3600))
    write_window_tables(first_hour, "lake_a")
    table = readers.scan_table(spark, "lake_a.view_windows_5min")
    assert rows(table, "window_start", "event_count") == [(at(0), 2), (at(300), 1), (at(3900), 1)]
    assert readers.scan_table(spark, "lake_a.flag_windows_5min").count() == 0


def test_plain_append_and_replace(spark):
    df = spark.range(3)
    writers.append_table(df, "lake_b.t")
    writers.append_table(df, "lake_b.t")
    assert spark.table("lake_b.t").count() == 6
    writers.replace_table(df, "lake_b.t")
    assert spark.table("lake_b.t").count() == 3


def test_insert_if_absent(spark, tmp_path):
    path = str(tmp_path / "m")
    schema = "image_id string, milestone_type string, milestone_value int, reached_at timestamp"
    df = spark.createDataFrame([("i", "views", 10, at(5)), ("i", "views", 10, at(2)), ("i", "views", 100, at(9))], schema)
    writers.insert_if_absent(df, path)
    writers.insert_if_absent(df, path)
    assert rows(spark.read.parquet(path), "milestone_value", "reached_at") == [(10, at(2)), (100, at(9))]


def test_latest_state_replays_and_compacts(spark, tmp_path):
    path, compact = str(tmp_path / "s"), str(tmp_path / "c")
    make = lambda *r: spark.createDataFrame(list(r), "image_id string, ts timestamp, v int")
    writers.put_latest(make(("i", at(1), 1), ("j", at(1), 1)), path, 0)
    for _ in range(2):
        writers.put_latest(make(("i", at(2), 2)), path, 1)
    schema = make(("i", at(1), 1)).schema
    assert rows(writers.get_latest(spark, path, schema), "image_id", "v") == [("i", 2), ("j", 1)]
    assert rows(writers.get_latest(spark, path, schema, prefix="i"), "image_id", "v") == [("i", 2)]
    writers.compact_latest(spark, path, compact, schema)
    assert spark.read.parquet(compact).count() == 2
    # a stream with a new checkpoint starts at batch 0 again and loses nothing
    writers.write_batch(make(("i", at(3), 3)), compact, 0, run="later")
    assert rows(writers.get_latest(spark, compact, schema), "image_id", "v") == [("i", 3), ("j", 1)]


def test_new_checkpoints_keep_old_batches(spark, tmp_path):
    from flagstone.streaming import jobs

    path, source = str(tmp_path / "state"), str(tmp_path / "in")
    schema = "image_id string, ts timestamp, v int"
    for n, key in enumerate("ij"):
        spark.createDataFrame([(key, at(n), n)], schema).write.mode("overwrite").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        sink = lambda batch, i: writers.put_latest(batch, path, i)
        jobs.run_available(stream, sink, str(tmp_path / f"checkpoint{n}"))
    found = writers.get_latest(spark, path, spark.createDataFrame([], schema).schema)
    assert rows(found, "image_id", "v") == [("i", 0), ("j", 1)]


def test_latest_state_with_two_keys(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([("i", 1, 2), ("i", 1, 5), ("i", 2, 1)], "a string, b int, n int")
    writers.put_latest(df, path, 0)
    assert rows(writers.get_latest(spark, path, df.schema, ("a", "b"), ("n",))) == [("i", 1, 5), ("i", 2, 1)]


def test_entities_and_image_folder(spark, tmp_path):
    root = str(tmp_path)
    for name, schema in readers.ENTITY_TABLES.items():
        writers.overwrite_snapshot(spark.createDataFrame([], schema), f"{root}/{name}/latest.parquet")
    assert set(readers.read_entities(spark, root)) == set(readers.ENTITY_TABLES)
    folder = tmp_path / "pics" / "class_02"
    folder.mkdir(parents=True)
    (folder / "x.jpg").write_bytes(b"123")
    assert rows(readers.image_folder(spark, str(tmp_path / "pics")), "length", "category") == [(3, "Dessert")]


def test_csv_has_a_header_per_file(spark, tmp_path):
    path = str(tmp_path / "csv")
    writers.append_csv(spark.range(2), path)
    writers.append_csv(spark.range(2), path)
    back = spark.read.option("header", True).schema("id long").csv(path)
    assert rows(back) == [(0,), (0,), (1,), (1,)]


def test_hourly_job_reads_its_messages_once_and_keeps_one_copy(spark, tmp_path):
    from flagstone.plans.hourly import aggregate_range, run_hourly, run_metrics

    body = '{{"event_type": "{}", "image_id": {}, "viewed_at": "{}", "created_at": "{}", "comment_id": "c"}}'
    raw = [
        ("t", 0, k, at(s), body.format(kind, image, at(s).isoformat(), at(s).isoformat()))
        for k, (kind, image, s) in enumerate(
            [("view", '"i"', 0), ("view", '"i"', 10), ("view", "null", 20), ("comment", '"i"', 400), ("view", '"j"', 7300), ("odd", '"i"', 1)]
        )
    ]
    path = str(tmp_path / "raw")
    spark.createDataFrame(raw, "topic string, partition int, offset long, timestamp timestamp, value string").write.parquet(path)
    messages = spark.read.parquet(path)
    counts, metrics = aggregate_range(messages, at(0), at(3600))
    assert rows(metrics) == rows(run_metrics(messages, at(0), at(3600))) == [
        ("comment_windows", 1), ("events_in_range", 3), ("events_read", 6), ("events_skipped", 2), ("view_windows", 1)
    ]
    assert path not in counts._jdf.queryExecution().executedPlan().toString()  # written: parsed no more
    for _ in range(2):
        run_hourly(messages, at(0), at(7200), "lake_h")
    assert rows(readers.scan_table(spark, "lake_h.view_windows_5min"), "image_id", "event_count") == [("i", 2)]
    assert readers.scan_table(spark, "lake_h.comment_windows_5min").count() == 1
