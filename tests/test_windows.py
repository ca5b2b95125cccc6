"""Counts, alerts and milestones with the default settings, at the edges."""

from flagstone.config import Settings
from flagstone.operators import alerts as al
from flagstone.operators import windows as win
from helpers import at, events, rows


def viral(spark):
    return events(spark, [("i", "view", n * 0.2) for n in range(105)])


def test_viral_alert_fires_once_at_the_threshold(spark):
    found = rows(al.first_alerts(win.rolling_counts(viral(spark))))
    assert found == [
        ("i", "popular", at(49 * 0.2), 50, 50),
        ("i", "viral", at(99 * 0.2), 100, 100),
    ]


def test_milestones_of_a_viral_image(spark):
    assert rows(al.milestone_crossings(viral(spark)), "milestone_value", "reached_at") == [
        (10, at(9 * 0.2)),
        (100, at(99 * 0.2)),
    ]


def test_suspicious_alert_at_the_tenth_comment(spark):
    data = events(spark, [("i", "comment", n * 0.25) for n in range(12)])
    alerts = al.first_alerts(win.rolling_counts(data))
    assert rows(alerts) == [("i", "suspicious", at(9 * 0.25), 10, 10)]
    request = al.moderation_requests(alerts).collect()
    assert [(r.image_id, r.trigger, r.context) for r in request] == [
        ("i", "suspicious", {"comments_1min": 10})
    ]


def test_popular_post_makes_no_request(spark):
    data = events(spark, [("i", "view", n * 60) for n in range(55)])
    alerts = al.first_alerts(win.rolling_counts(data))
    assert [r.alert_type for r in alerts.collect()] == ["popular"]
    assert al.moderation_requests(alerts).count() == 0


def test_quiet_image_has_no_alert(spark):
    data = events(spark, [("i", "view", n) for n in range(5)] + [("i", "comment", 9), ("i", "comment", 9.5)])
    assert al.first_alerts(win.rolling_counts(data)).count() == 0


def test_exact_totals(spark):
    data = events(
        spark, [("i", "view", n) for n in range(7)] + [("i", "comment", n) for n in range(3)] + [("i", "flag", 4)]
    )
    assert rows(win.totals(data)) == [("i", 7, 3, 1)]
    sums = win.tumbling_counts(data).groupBy("event_type").sum("event_count")
    assert rows(sums) == [("comment", 3), ("flag", 1), ("view", 7)]


def test_event_window_is_open_on_the_left_and_read_window_closed(spark):
    data = events(spark, [("i", "view", 0), ("i", "view", 60), ("i", "comment", 60)])
    found = rows(win.rolling_counts(data), "event_type", "ts", "views_1min", "total_views")
    assert found == [("comment", at(60), 2, 2), ("view", at(0), 1, 1), ("view", at(60), 1, 2)]
    assert rows(win.window_counts(data, at(60)), "views_1min", "comments_1min") == [(2, 1)]
    assert rows(win.window_counts(data, at(60.000001)), "views_1min") == [(1,)]


def test_windows_expire_and_totals_stay(spark):
    data = events(spark, [("i", "view", n) for n in range(20)] + [("i", "view", 90)])
    last = rows(win.rolling_counts(data), "ts", "views_1min", "views_5min", "total_views")[-1]
    assert last == (at(90), 1, 21, 21)


def test_redelivered_comment_counts_once_in_windows_and_twice_in_totals(spark):
    once = events(spark, [("i", "comment", 0), ("i", "comment", 1)])
    again = once.unionByName(once.limit(1))
    assert rows(win.rolling_counts(again), "ts", "comments_1min", "total_comments") == [
        (at(0), 1, 2),
        (at(1), 2, 3),
    ]


def test_tumbling_edges_and_range(spark):
    data = events(spark, [("i", "view", -0.000001), ("i", "view", 0), ("i", "view", 299.999999), ("i", "view", 300)])
    counted = win.tumbling_counts(data, Settings())
    assert rows(counted, "window_start", "event_count") == [(at(-300), 1), (at(0), 2), (at(300), 1)]
    limited = win.tumbling_counts(data, Settings(), at(0), at(300))
    assert rows(limited, "window_start", "event_count") == [(at(0), 2)]


def test_order_of_input_does_not_matter(spark):
    data = events(spark, [("i", k, s) for s in range(30) for k in ("view", "comment")])
    shuffled = data.orderBy("event_type", "ts", ascending=False)
    assert rows(win.rolling_counts(data)) == rows(win.rolling_counts(shuffled))
