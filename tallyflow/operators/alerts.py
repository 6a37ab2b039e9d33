"""Coupon-abuse alerts: several accounts take coupons on one device in a sliding window, and
nobody on that device looks at an item.

Alerting windows are found by a sweep line.  A coupon account seen in a pane of time belongs to an interval of
window starts; the intervals of one account are cut so that they do not overlap, and running sums over
their ends tell for every start how many accounts its window holds.  Clicks are swept the same way.
Only the stretches of starts with enough accounts and no click are written out as windows, and only
these windows' parts are read.

The list of all events of a device is carried as counts per event id and written out for the
alerts only, so a busy device costs counters, not lists.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.functions import columns as C
from tallyflow.operators.latest import latest_per_key
from tallyflow.session import shuffle_tasks

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def micros(period: str) -> int:
    number, unit = period.split()
    seconds = int(number) * _UNITS[unit.rstrip("s")]
    return seconds * 1_000_000


def _is(event: str) -> Column:
    return F.col("evid").eqNullSafe(event)


def _floor(at: Column, step: int) -> Column:
    return at - F.pmod(at, F.lit(step))


# What a profile is made of: events by id, coupon accounts, coupon items.
EVENT, ACCOUNT, ITEM = "event", "account", "item"


def parts(events: DataFrame) -> DataFrame:
    """Each event as one to three parts (kind, name) of its device's profile.

    Kept apart, a device costs the sum of its event ids, accounts and items, not their product.
    """
    def part(kind: str, name: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(name).cast("string").alias("name"))

    all_parts = F.when(_is(fixed.EVENT_COUPON), F.array(
        part(EVENT, "evid"), part(ACCOUNT, "uid"), part(ITEM, "itemid"))).otherwise(
            F.array(part(EVENT, "evid")))
    return (events.select("event_time", "mid", F.explode(all_parts).alias("_part"))
            .select("event_time", "mid", "_part.*")
            .where((F.col("kind") == EVENT) | F.col("name").isNotNull()))


def pane_size(window: str, slide: str) -> int:
    """Microseconds of a pane: windows begin and end at borders of panes."""
    return gcd(micros(window), micros(slide))


def pane_counts(events: DataFrame, window: str, slide: str) -> DataFrame:
    """(pane, mid, kind, name, n): how often each part occurs in a pane; combined before the shuffle."""
    pane = _floor(F.unix_micros("event_time"), pane_size(window, slide))
    return (parts(events).groupBy(pane.alias("pane"), "mid", "kind", "name")
            .agg(F.count(F.lit(1)).alias("n")))


def stream_pane_counts(events: DataFrame, window: str, slide: str) -> DataFrame:
    """The same from a stream, given out once a pane is complete; state of fixed size per part."""
    pane = f"{pane_size(window, slide) // 1000} milliseconds"
    counts = (parts(events).groupBy(F.window("event_time", pane).alias("p"), "mid", "kind", "name")
              .agg(F.count(F.lit(1)).alias("n")))
    return counts.select(F.unix_micros("p.start").alias("pane"), F.col("mid").cast("string").alias("mid"),
                         "kind", "name", "n")


# Blocks of a sweep, in windows: a hot device is swept in pieces, a few intervals are cut in two.
SWEEP = 16


def _is_click() -> Column:
    return (F.col("kind") == EVENT) & F.col("name").eqNullSafe(fixed.EVENT_CLICK_ITEM)


def alert_stretches(panes: DataFrame, window: str, slide: str,
                    min_accounts: int = fixed.ALERT_MIN_ACCOUNTS) -> DataFrame:
    """(mid, first, last): runs of window starts (microseconds, ``slide`` apart) whose windows alert.

    A part in pane p is in the windows that start after p - window, up to p.  Of the starts that the
    part's pane before covers already, none is counted again.
    """
    width, step = micros(window), micros(slide)
    size = SWEEP * width - SWEEP * width % step
    marks = panes.where((F.col("kind") == ACCOUNT) | _is_click()).select(
        "mid", "kind", "name", "pane", _floor(F.col("pane"), step).alias("last"))
    same = Window.partitionBy("mid", "kind", "name").orderBy("pane")
    first = F.greatest(_floor(F.col("pane") - width, step), F.lag("last").over(same)) + step
    spans = marks.withColumn("first", first).where("first <= last")
    block = _floor(F.col("first"), size)
    border = block + size
    pieces = spans.select("mid", "kind", F.explode(F.when(F.col("last") < border, F.array(
        F.struct(block.alias("block"), "first", "last"))).otherwise(F.array(
            F.struct(block.alias("block"), "first", (border - step).alias("last")),
            F.struct(border.alias("block"), border.alias("first"), "last")))).alias("x"))
    ends = pieces.select("mid", "x.block", "kind", F.explode(F.array(
        F.struct(F.col("x.first").alias("at"), F.lit(1).alias("by")),
        F.struct((F.col("x.last") + step).alias("at"), F.lit(-1).alias("by")))).alias("e"))

    def change(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("e.by")).otherwise(0))

    points = ends.groupBy("mid", "block", F.col("e.at").alias("at")).agg(
        change(F.col("kind") == ACCOUNT).alias("accounts"), change(F.col("kind") != ACCOUNT).alias("clicks")
    ).where("accounts <> 0 or clicks <> 0")  # where one interval goes over into the next, nothing changes
    line = Window.partitionBy("mid", "block").orderBy("at")
    swept = points.select("mid", F.col("at").alias("first"), F.sum("accounts").over(line).alias("accounts"),
                          F.sum("clicks").over(line).alias("clicks"), F.lead("at").over(line).alias("next"))
    return (swept.where((F.col("accounts") >= min_accounts) & (F.col("clicks") == 0) & F.col("next").isNotNull())
            .select("mid", "first", (F.col("next") - step).alias("last")))


def all_starts(stretches: DataFrame, slide: str) -> DataFrame:
    """(mid, start) of every alerting window."""
    return stretches.select("mid", F.explode(F.sequence("first", "last", F.lit(micros(slide)))).alias("start"))


def last_starts(stretches: DataFrame, window: str, slide: str) -> DataFrame:
    """(mid, start) of the last alerting window of each device that ends in a minute."""
    width, step, minute = micros(window), micros(slide), micros("1 minute")
    if step >= minute:
        return all_starts(stretches, slide)
    first, last = F.col("first") + width, F.col("last") + width
    ends = F.sequence(_floor(first, minute), _floor(last, minute), F.lit(minute))
    start = _floor(F.least(F.col("last"), F.col("minute") + F.lit(minute - 1 - width)), step)
    return (stretches.select("mid", "first", "last", F.explode(ends).alias("minute"))
            .select("mid", "minute", start.alias("start"), "first").where("start >= first")
            .groupBy("mid", "minute").agg(F.max("start").alias("start")).select("mid", "start"))


def _near_blocks(starts: DataFrame, width: int) -> DataFrame:
    """(mid, block) of the panes that the windows hold: a window lies in its block and the next."""
    block = _floor(F.col("start"), width)
    return starts.select("mid", F.explode(F.array(block, block + width)).alias("block")).distinct()


def of_blocks(rows: DataFrame, at: Column, starts: DataFrame, window: str) -> DataFrame:
    """The rows of these devices and times; a device without id is a device, too."""
    width = micros(window)
    left = rows.withColumn("_block", _floor(at, width)).alias("e")
    right = _near_blocks(starts, width).alias("s")
    same = F.col("e.mid").eqNullSafe(F.col("s.mid")) & (F.col("e._block") == F.col("s.block"))
    return left.join(right, same, "left_semi").drop("_block")


def window_profiles(panes: DataFrame, starts: DataFrame, window: str) -> DataFrame:
    """Profiles of the given windows (mid, start) from the panes.

    A pane goes to its own block and the one before, as long as a window, and there to the windows that
    hold it; parts are summed up per window where they meet, with no further shuffle.
    """
    width = micros(window)
    block = _floor(F.col("pane"), width)
    near = panes.select("mid", "pane", "kind", "name", "n",
                        F.explode(F.array(block, block - width)).alias("block")).alias("p")
    wanted = starts.select("mid", "start", _floor(F.col("start"), width).alias("block")).alias("w")
    inside = (F.col("p.mid").eqNullSafe(F.col("w.mid")) & (F.col("p.block") == F.col("w.block"))
              & (F.col("p.pane") >= F.col("w.start")) & (F.col("p.pane") < F.col("w.start") + width))
    counts = (near.join(wanted, inside).select("p.mid", "p.block", "start", "kind", "name", "n")
              .groupBy("mid", "block", "start", "kind", "name").agg(F.sum("n").alias("n")))

    def names(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("name"))))

    return counts.groupBy("mid", "block", "start").agg(
        names(ACCOUNT).alias("uids"), names(ITEM).alias("item_ids"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == EVENT, F.struct(
            F.col("name").alias("evid"), "n")))).alias("event_counts")).select(
        F.timestamp_micros("start").alias("window_start"),
        F.timestamp_micros(F.col("start") + width).alias("window_end"), "mid", "uids", "item_ids", "event_counts")


def device_profiles(events: DataFrame, window: str, slide: str) -> DataFrame:
    """Per window and device: coupon accounts and items, events, whether an item was clicked.

    A 5 min window that slides by 5 s holds each event 60 times, but the events are not copied
    60 times through a shuffle.  Their parts are counted in panes (the common divisor of window
    and slide), combined before the shuffle: a device has at most as many rows in a pane as event
    ids, accounts and items together.  The panes are then gathered per device and time block: a
    window that starts in a block as long as itself ends in the next one, so each pane goes to two
    blocks, and the windows are cut out of a block's panes in place.

    The blocks are spread over a set number of tasks; partitions coalesced to suit the panes
    would be too large for the windows that come out of them.
    """
    width, step = micros(window), micros(slide)
    pane = _floor(F.unix_micros("event_time"), gcd(width, step))
    panes = (parts(events).groupBy(pane.alias("pane"), "mid", "kind", "name")
             .agg(F.count(F.lit(1)).alias("n")))
    block = _floor(F.col("pane"), width)
    blocks = (panes.withColumn("_block", F.explode(F.array(block, block - width)))
              .repartition(shuffle_tasks(events.sparkSession), "mid", "_block")
              .groupBy("mid", "_block")
              .agg(F.collect_list(F.struct("pane", "kind", "name", "n")).alias("_panes")))

    first = F.col("_block") + F.pmod(-F.col("_block"), F.lit(step))
    starts = F.sequence(first, F.col("_block") + F.lit(width - 1), F.lit(step))
    start, end = F.col("_start"), F.col("_start") + width
    inside = F.filter("_panes", lambda p: (p["pane"] >= start) & (p["pane"] < end))

    def of_kind(kind: str) -> Column:
        return F.filter("_inside", lambda p: p["kind"] == kind)

    def distinct(kind: str) -> Column:
        return F.array_sort(F.array_distinct(F.transform(of_kind(kind), lambda p: p["name"])))

    clicked = F.exists("_inside", lambda p: (p["kind"] == EVENT)
                       & p["name"].eqNullSafe(fixed.EVENT_CLICK_ITEM))
    return (C.with_computed(blocks.withColumn("_start", F.explode(starts)), "_inside", inside)
            .filter(F.size("_inside") > 0)
            .select(F.timestamp_micros(start).alias("window_start"),
                    F.timestamp_micros(end).alias("window_end"), "mid",
                    distinct(ACCOUNT).alias("uids"), distinct(ITEM).alias("item_ids"),
                    F.array_sort(F.transform(of_kind(EVENT), lambda p: F.struct(
                        p["name"].alias("evid"), p["n"].alias("n")))).alias("event_counts"),
                    clicked.alias("clicked")))


def coupon_alerts(profiles: DataFrame,
                  min_accounts: int = fixed.ALERT_MIN_ACCOUNTS) -> DataFrame:
    """Profiles with enough coupon accounts and no clicked item.  A null account is not counted."""
    return (profiles.filter((F.size("uids") >= min_accounts) & ~F.col("clicked"))
                    .drop("clicked"))


def _found(events: DataFrame, window: str, slide: str, min_accounts: int, last: bool) -> DataFrame:
    """Profiles of the alerting windows.  The sweep reads coupon and click events only, the profiles the
    events of devices and times that alert."""
    marks = events.filter(F.col("evid").isin(fixed.EVENT_COUPON, fixed.EVENT_CLICK_ITEM))
    stretches = alert_stretches(pane_counts(marks, window, slide), window, slide, min_accounts)
    starts = last_starts(stretches, window, slide) if last else all_starts(stretches, slide)
    near = of_blocks(events, F.unix_micros("event_time"), starts, window)
    return window_profiles(pane_counts(near, window, slide), starts, window)


def find_alerts(events: DataFrame, window: str = fixed.ALERT_WINDOW,
                slide: str = fixed.ALERT_SLIDE,
                min_accounts: int = fixed.ALERT_MIN_ACCOUNTS) -> DataFrame:
    """All alerting windows of a batch of events."""
    return _found(events, window, slide, min_accounts, last=False)


def find_documents(events: DataFrame, window: str = fixed.ALERT_WINDOW,
                   slide: str = fixed.ALERT_SLIDE,
                   min_accounts: int = fixed.ALERT_MIN_ACCOUNTS) -> DataFrame:
    """One document per device and minute of a batch of events."""
    return alert_documents(_found(events, window, slide, min_accounts, last=True))


def documents_of_panes(panes: DataFrame, window: str, slide: str, min_accounts: int,
                       after: int | None, until: int) -> DataFrame:
    """Documents of the windows that end after ``after`` and not after ``until`` (microseconds)."""
    width, step = micros(window), micros(slide)
    stretches = alert_stretches(panes, window, slide, min_accounts).withColumn(
        "last", F.least(F.col("last"), _floor(F.lit(until - width), step)))
    if after is not None:
        stretches = stretches.withColumn(
            "first", F.greatest(F.col("first"), _floor(F.lit(after - width), step) + step))
    starts = last_starts(stretches.where("first <= last"), window, slide)
    near = of_blocks(panes, F.col("pane"), starts, window)
    return alert_documents(window_profiles(near, starts, window))


def event_list(event_counts: Column) -> Column:
    """Counts per event id written out as the list of all events."""
    return F.flatten(F.transform(
        event_counts, lambda e: F.array_repeat(e["evid"], e["n"].cast("int"))))


def alert_documents(alerts: DataFrame) -> DataFrame:
    """One document per device and minute; the last window of the minute wins."""
    ts = F.unix_millis("window_end")
    keyed = alerts.withColumn("ts", ts).withColumn("alert_id", C.minute_key(F.col("mid"), ts))
    return (latest_per_key(keyed, ["alert_id"], ["ts"])
            .select("alert_id", "mid", "uids", "item_ids",
                    event_list(F.col("event_counts")).alias("events"), "ts",
                    C.day_text(F.col("window_end")).alias("alert_date")))
