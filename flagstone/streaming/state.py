"""Keyed streaming state: rolling counts, running totals, alerts and milestones per image.

The stream is first reduced to counts per (image, type, time grain), a built-in aggregation
that combines before its shuffle. The keyed state then holds one entry per grain of the
longest window, so neither its size nor its input grows with an image's traffic.

Images are dealt to a fixed number of slots by a hash, and a slot is the key of the state: its images
are counted together in array operations, so the calls into Python are bounded by the slots of a
micro-batch, not by its images. A call costs as much as hundreds of rows, so there are few slots, but more than
cores; a call holds its slot's rows of the micro-batch and its state, so very large micro-batches want more
(`slots`). A touched slot's state is written anew as a whole. Start the stream with
`partitions(spark)` (`jobs.run_available`): a partition of the state costs a Python task and state files
in every micro-batch, however few slots it has, and adaptive execution joins none of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flagstone.config import Settings
from flagstone.functions.times import SECOND, micros
from flagstone.operators.alerts import alert_rules

GRAIN = "1 second"
SLOTS = 512
SHUFFLES = "spark.sql.shuffle.partitions"
KINDS = np.array(["comment", "flag", "view"], dtype=object)
COMMENT, FLAG, VIEW = range(3)

# Per image of the slot: its totals and alerts. Per entry: its image's place, and what was counted when.
STATE = (
    "images array<string>, views array<bigint>, comments array<bigint>, flags array<bigint>, "
    "fired array<array<string>>, "
    "place array<int>, kind array<int>, us array<bigint>, n array<bigint>"
)
OUTPUT = (
    "image_id string, event_type string, ts timestamp, n bigint, "
    "views_1min bigint, views_5min bigint, views_1hr bigint, "
    "comments_1min bigint, comments_5min bigint, comments_1hr bigint, "
    "total_views bigint, total_comments bigint, total_flags bigint, "
    "fired array<string>, reached array<int>"
)


def grain_counts(events: DataFrame, watermark: str, grain: str = GRAIN) -> DataFrame:
    """The same as a stream; in append mode a grain comes out once the watermark has passed it.

    `ts` is the start of the grain. Write this as a table or topic and read it back as the
    input of `rolling_state`; `jobs.grain_sink` does so without holding anything back.
    """
    return grain_totals(events.withWatermark("ts", watermark), grain)


def grain_totals(events: DataFrame, grain: str = GRAIN) -> DataFrame:
    """Counts per image, type and grain of the rows at hand, combined before the shuffle."""
    return (
        events.where(
            F.col("event_type").isin("view", "comment", "flag")
            & F.col("image_id").isNotNull()
        )
        .groupBy("image_id", "event_type", F.window("ts", grain))
        .agg(F.count("*").alias("n"))
        .select("image_id", "event_type", F.col("window.start").alias("ts"), "n")
    )


class Timeline:
    """Sorted times of several images with counts; answers how many of an image fall in a window."""

    def __init__(self, at: np.ndarray, n: np.ndarray):
        order = np.argsort(at, kind="stable")
        self.at = at[order]
        self.cumulative = np.concatenate([[0], np.cumsum(n[order])])

    def window(self, at: np.ndarray, width: int, closed: np.ndarray) -> np.ndarray:
        start = np.where(
            closed,
            np.searchsorted(self.at, at - width, side="left"),
            np.searchsorted(self.at, at - width, side="right"),
        )
        end = np.searchsorted(self.at, at, side="right")
        return self.cumulative[end] - self.cumulative[start]


class Slot:
    """The state of a slot: its images with their totals and alerts, and the entries windows can reach."""

    def __init__(self, held: tuple | None) -> None:
        images, views, comments, flags, fired, *entries = held or ([],) * 9
        self.images, self.fired = list(images), [set(names) for names in fired]
        self.totals = {
            kind: np.asarray(old, np.int64) for kind, old in ((VIEW, views), (COMMENT, comments), (FLAG, flags))
        }
        self.place, self.kind, self.us, self.n = (np.asarray(e, np.int64) for e in entries)

    def places(self, images: pd.Series) -> np.ndarray:
        """Places of images in the slot; new ones are added."""
        codes, found = pd.factorize(images, use_na_sentinel=False)
        known = {image: i for i, image in enumerate(self.images)}
        names = [None if pd.isna(image) else image for image in found]
        new = [image for image in names if image not in known]
        known.update((image, len(self.images) + i) for i, image in enumerate(new))
        self.images += new
        self.fired += [set() for _ in new]
        self.totals = {k: np.concatenate([t, np.zeros(len(new), np.int64)]) for k, t in self.totals.items()}
        return np.array([known[image] for image in names], np.int64)[codes]

    def add(self, place: np.ndarray, kind: np.ndarray, us: np.ndarray, n: np.ndarray) -> None:
        for metric, total in self.totals.items():
            np.add.at(total, place[kind == metric], n[kind == metric])
        mine = kind != FLAG  # flags have no windows
        parts = ((self.place, place), (self.kind, kind), (self.us, us), (self.n, n))
        self.place, self.kind, self.us, self.n = (np.concatenate([old, new[mine]]) for old, new in parts)

    def since(self, oldest: int) -> None:
        keep = self.us >= oldest
        self.place, self.kind, self.us, self.n = (e[keep] for e in (self.place, self.kind, self.us, self.n))

    def first_idle(self) -> int | None:
        """The newest entry of the image whose newest entry is the oldest."""
        if not len(self.us):
            return None
        newest = np.full(len(self.images), np.iinfo(np.int64).min)
        np.maximum.at(newest, self.place, self.us)
        return int(newest[np.unique(self.place)].min())

    def row(self) -> tuple:
        entries = (e.tolist() for e in (self.place, self.kind, self.us, self.n))
        totals = (self.totals[kind].tolist() for kind in (VIEW, COMMENT, FLAG))
        return (self.images, *totals, [sorted(names) for names in self.fired], *entries)


def _combined(slot: Slot, batches: Iterator[pd.DataFrame]) -> tuple[np.ndarray, ...]:
    """Places, times, types and counts of a slot's rows in order, one entry per image, time and type."""
    rows = pd.concat(list(batches), ignore_index=True)
    place = slot.places(rows["image_id"])
    us, kind, n = (rows[c].to_numpy(np.int64) for c in ("us", "kind", "n"))
    order = np.lexsort((kind, us, place))
    place, us, kind, n = place[order], us[order], kind[order], n[order]
    same = (place[1:] == place[:-1]) & (us[1:] == us[:-1]) & (kind[1:] == kind[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    return place[first], us[first], kind[first], np.add.reduceat(n, first)


def _windows(
    slot: Slot, settings: Settings, place: np.ndarray, us: np.ndarray, kind: np.ndarray, n: np.ndarray
) -> dict[str, np.ndarray]:
    """Window counts at each row over the slot's entries and the rows."""
    longest = max(seconds for _, seconds in settings.rolling) * SECOND
    times = np.concatenate([slot.us, us])
    base = int(times.min()) - longest - 1
    span = int(times.max()) - base + 1  # an image's times lie in a span of its own
    together = max(1, (1 << 62) // span)  # so many images have room on one line
    out = {
        f"{KINDS[metric]}s_{name}": np.zeros(len(us), np.int64)
        for metric in (VIEW, COMMENT)
        for name, _ in settings.rolling
    }
    for low in range(0, len(slot.images), together):
        old = (slot.place >= low) & (slot.place < low + together)
        mine = (place >= low) & (place < low + together)
        if not mine.any():
            continue
        held = (slot.place[old] - low) * span + (slot.us[old] - base)
        at = (place[mine] - low) * span + (us[mine] - base)
        for metric in (VIEW, COMMENT):
            is_old, is_new = slot.kind[old] == metric, kind[mine] == metric
            line = Timeline(
                np.concatenate([held[is_old], at[is_new]]),
                np.concatenate([slot.n[old][is_old], n[mine][is_new]]),
            )
            for name, seconds in settings.rolling:
                out[f"{KINDS[metric]}s_{name}"][mine] = line.window(at, seconds * SECOND, ~is_new)
    return out


def _advance(settings: Settings):
    rules = alert_rules(settings)
    longest = max(seconds for _, seconds in settings.rolling) * SECOND

    def advance(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        slot = Slot(state.get if state.exists else None)
        out = None if state.hasTimedOut else count(slot, batches)
        watermark = state.getCurrentWatermarkMs()
        if watermark > 0:
            slot.since(watermark * 1000 - longest)
        state.update(slot.row())
        idle = slot.first_idle()
        if idle is not None:
            state.setTimeoutTimestamp(max((idle + longest) // 1000 + 1, watermark + 1))
        if out is not None:
            yield out

    def count(slot: Slot, batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
        place, us, kind, n = _combined(slot, batches)
        out = _windows(slot, settings, place, us, kind, n)
        image_start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        image = np.repeat(image_start, np.diff(np.append(image_start, len(place))))
        # Rows of one image and time see each other, whatever their type.
        time_start = np.concatenate([[True], (place[1:] != place[:-1]) | (us[1:] != us[:-1])])
        last_of_time = np.append(np.flatnonzero(time_start)[1:], len(us))[np.cumsum(time_start) - 1] - 1
        running = {}
        for metric in (VIEW, COMMENT, FLAG):
            moved = np.where(kind == metric, n, 0)
            so_far = np.cumsum(moved)
            running[metric] = slot.totals[metric][place] + so_far - (so_far - moved)[image]
            out[f"total_{KINDS[metric]}s"] = running[metric][last_of_time]

        news: list[list[str]] = [[] for _ in range(len(us))]
        for name, (column, threshold, kinds) in rules.items():
            hits = np.flatnonzero((out[column] >= threshold) & np.isin(KINDS[kind], kinds))
            images, first = np.unique(place[hits], return_index=True)
            for i, row in zip(images.tolist(), hits[first].tolist()):
                if name not in slot.fired[i]:
                    news[row].append(name)
                    slot.fired[i].add(name)
        after = running[VIEW]
        before = after - np.where(kind == VIEW, n, 0)
        reached: list[list[int]] = [[] for _ in range(len(us))]
        for milestone in settings.milestones:
            for row in np.flatnonzero((before < milestone) & (milestone <= after)).tolist():
                reached[row].append(milestone)

        slot.add(place, kind, us, n)
        shown = np.flatnonzero(kind != FLAG)
        names = np.array(slot.images, dtype=object)
        columns = {"image_id": names[place], "event_type": KINDS[kind], "ts": us.astype("datetime64[us]"), "n": n, **out}
        return pd.DataFrame(
            {c: values[shown] for c, values in columns.items()}
            | {"fired": [news[i] for i in shown], "reached": [reached[i] for i in shown]}
        )

    return advance


def rolling_state(
    counts: DataFrame,
    settings: Settings = Settings(),
    watermark: str | None = None,
    slots: int = SLOTS,
) -> DataFrame:
    """One row per incoming (image, type, time) with the state after that time.

    `counts` has image_id, event_type, ts and n. With raw events, n is 1 and times are
    exact; with `grain_counts` they are exact to the grain. Each alert type and milestone
    appears once per image in `fired` and `reached`. Entries older than the watermark less
    the longest window are dropped; an image idle for the longest window keeps only its
    totals and fired alerts. `slots` stays the same for the life of a checkpoint.
    """
    if watermark is not None:
        counts = counts.withWatermark("ts", watermark)
    return (
        counts.where(F.col("event_type").isin(*KINDS))
        .select(
            F.pmod(F.xxhash64("image_id"), F.lit(slots)).cast("int").alias("slot"),
            "image_id",
            "ts",
            micros("ts").alias("us"),
            (F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("event_type")) - 1)
            .cast("int")
            .alias("kind"),
            "n",
        )
        .groupBy("slot")
        .applyInPandasWithState(
            _advance(settings),
            OUTPUT,
            STATE,
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )


def partitions(spark: SparkSession) -> int:
    """Partitions of the state: one a core, and no more than the session's shuffles have.

    A task takes its slots one by one, so a larger partition needs no more of a worker's memory. A checkpoint
    keeps the number it began with.
    """
    return min(int(spark.conf.get(SHUFFLES)), spark.sparkContext.defaultParallelism)


def alerts_of(state_rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Alert rows from the state output."""
    observed, threshold = F.lit(None).cast("long"), F.lit(None).cast("long")
    for name, (column, limit, _) in alert_rules(settings).items():
        here = F.col("alert_type") == name
        observed = F.when(here, F.col(column)).otherwise(observed)
        threshold = F.when(here, F.lit(limit).cast("long")).otherwise(threshold)
    return state_rows.withColumn("alert_type", F.explode("fired")).select(
        "image_id",
        "alert_type",
        F.col("ts").alias("alert_ts"),
        observed.alias("observed"),
        threshold.alias("threshold"),
    )


def milestones_of(state_rows: DataFrame) -> DataFrame:
    """Milestone rows from the state output."""
    return state_rows.select(
        "image_id",
        F.lit("views").alias("milestone_type"),
        F.explode("reached").alias("milestone_value"),
        F.col("ts").alias("reached_at"),
    )
