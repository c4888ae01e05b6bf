"""Coupon-fraud alerts over sliding event-time windows.

Rule, per device and window: at least ``min_uids`` distinct accounts took
a coupon and nobody clicked an item.  The alert lists the coupon accounts,
the coupon item ids and the window's events as (evid, count) pairs, and is
stamped with the window end.

Batch plan (``coupon_alert_parts``): raw events are aggregated once per
(device, pane) where a pane is one slide long; only those small pane rows
are then fanned out to the ``window / slide`` windows that contain them and
merged.  The raw data is never multiplied by the fan-out and every
aggregation has a map-side partial step.  Distinct accounts and items are
computed as (device, window, value) groups - the value is in the key, so a
device holding a third of all events spreads over tasks - and counted, not
collected.  Alerts come out normalized: a header row per alert plus
(alert, event id, count), (alert, account) and (alert, item) rows, with
whatever event ids the logs hold; ``coupon_alerts`` gathers them into one
document per alert when a sink needs that shape.

Streaming plan (``alert_values_stream``): the same in two chained stateful
aggregations in append mode.  Events are counted per pane, a closed pane's
rows are fanned out to the windows that contain it, and windows are emitted
once the watermark has passed them; each micro-batch then turns its closed
windows into alerts with the batch code (``parts_from_values``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.functions.scalar import alert_id
from martlane.operators.common import pick_per_key

# The coupon and click event ids, and the demo window, slide and
# threshold.
COUPON = "coupon"
CLICK = "clickItem"
WINDOW_SECONDS = 30
SLIDE_SECONDS = 5
MIN_UIDS = 3
BUCKET_SECONDS = 60


def _with_pane(events: DataFrame, slide_ms: int) -> DataFrame:
    # exact integer pane index, also for times before the epoch
    return events.withColumn("pane", ((F.col("ts") - F.pmod(F.col("ts"), F.lit(slide_ms)))
                                      / F.lit(slide_ms)).cast("long"))


def _spread(panes: DataFrame, fan_out: int, slide_ms: int) -> DataFrame:
    """Each pane row once per window that contains it (``window_start`` in ms)."""
    out = panes.select("*", F.explode(F.sequence(F.lit(0), F.lit(fan_out - 1))).alias("_k"))
    return out.withColumn("window_start", (F.col("pane") - F.col("_k")) * F.lit(slide_ms)) \
        .drop("_k", "pane")


KIND_EVENT, KIND_UID, KIND_ITEM = "evid", "uid", "item"


def _tagged(events: DataFrame) -> DataFrame:
    """Each event as (mid, ts, kind, value) rows: its event id (none: empty), and
    for a coupon also its account and its item (nulls are not members)."""
    evid = F.col("evid")
    is_coupon = evid == COUPON
    tags = F.array(
        F.struct(F.lit(KIND_EVENT).alias("kind"), F.coalesce(evid, F.lit("")).alias("value")),
        F.when(is_coupon & F.col("uid").isNotNull(),
               F.struct(F.lit(KIND_UID).alias("kind"), F.col("uid").alias("value"))),
        F.when(is_coupon & F.col("itemid").isNotNull(),
               F.struct(F.lit(KIND_ITEM).alias("kind"), F.col("itemid").alias("value"))),
    )
    rows = events.select("mid", "ts", F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("t"))
    return rows.select("mid", "ts", F.col("t.kind").alias("kind"), F.col("t.value").alias("value"))


def window_values(events: DataFrame, window_seconds: int, slide_seconds: int) -> DataFrame:
    """(mid, window_start, kind, value, n) for every window.

    kind 'evid': n events of that id; kind 'uid' / 'item': one row per
    distinct coupon account / item.  One scan of the events, one partial
    aggregation per (device, pane, kind, value), one merge per window.  The
    value is part of every key, so a device with millions of accounts is
    spread over tasks by account; nothing is collected.
    """
    slide_ms = slide_seconds * 1000
    panes = (_with_pane(_tagged(events), slide_ms)
             .groupBy("mid", "pane", "kind", "value").agg(F.count(F.lit(1)).alias("n")))
    return (_spread(panes, window_seconds // slide_seconds, slide_ms)
            .groupBy("mid", "window_start", "kind", "value").agg(F.sum("n").alias("n")))


def coupon_alert_parts(events: DataFrame, window_seconds: int = WINDOW_SECONDS,
                       slide_seconds: int = SLIDE_SECONDS, min_uids: int = MIN_UIDS,
                       bucket_seconds: int = BUCKET_SECONDS):
    """Batch alerts in normalized form: (header, uids, items, events).

    header: alert_id, mid, window_start, n_uids, n_items, ts
    uids / items / events: (alert_id, ts, mid, window_start, uid / itemid / evid
    and n) rows of flagged windows; ``ts`` (the window end) tells windows of
    one minute apart.
    Windows are ``[start, start + window)`` with starts on multiples of the
    slide since the epoch, the same alignment as ``F.window``.
    """
    if window_seconds % slide_seconds != 0:
        raise ValueError("window must be a whole number of slides (use coupon_alerts)")
    return parts_from_values(window_values(events, window_seconds, slide_seconds),
                             window_seconds, min_uids, bucket_seconds)


def parts_from_values(values: DataFrame, window_seconds: int, min_uids: int = MIN_UIDS,
                      bucket_seconds: int = BUCKET_SECONDS):
    """(header, uids, items, events) from per-window values (see ``window_values``)."""
    key = ["mid", "window_start"]
    kind, value = F.col("kind"), F.col("value")
    counts = values.groupBy(*key).agg(
        F.count_if((kind == KIND_EVENT) & (value == CLICK)).alias("_clicks"),
        F.count_if(kind == KIND_UID).alias("n_uids"),
        F.count_if(kind == KIND_ITEM).alias("n_items"))
    flagged = counts.filter((F.col("n_uids") >= min_uids) & (F.col("_clicks") == 0))
    flagged = flagged.withColumn("window_end", F.col("window_start") + F.lit(window_seconds * 1000))
    header = flagged.select(
        alert_id("mid", "window_end", bucket_seconds).alias("alert_id"), "mid", "window_start",
        "n_uids", "n_items", F.col("window_end").alias("ts"))
    # Catalyst pushes the kind filter below the aggregates, so each member
    # side reads the (column-pruned) values again but carries only its own
    # kind through its shuffles.
    members = values.join(header.select("alert_id", "ts", *key), key, "inner")
    of = lambda k, *cols: members.filter(kind == k).select("alert_id", "ts", "mid", "window_start", *cols)
    return (header, of(KIND_UID, value.alias("uid")), of(KIND_ITEM, value.alias("itemid")),
            of(KIND_EVENT, value.alias("evid"), F.col("n").cast("long").alias("n")))


def coupon_alerts(events: DataFrame, window_seconds: int = WINDOW_SECONDS,
                  slide_seconds: int = SLIDE_SECONDS, min_uids: int = MIN_UIDS,
                  bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Batch alerts as one document per alert (sorted uid and item arrays).

    Built from ``coupon_alert_parts``: the arrays are gathered per flagged
    alert only, as the document store wants them.  Pipelines that must not
    hold one alert's account list in one row use the parts directly.
    """
    if window_seconds % slide_seconds != 0:
        return _coupon_alerts_native(events, window_seconds, slide_seconds, min_uids,
                                     bucket_seconds)
    return alert_documents(*coupon_alert_parts(events, window_seconds, slide_seconds, min_uids,
                                               bucket_seconds))


def with_events(header: DataFrame, events: DataFrame) -> DataFrame:
    """``header`` with its events as an array of (evid, n), sorted by id."""
    e = events.groupBy("mid", "window_start").agg(
        F.array_sort(F.collect_list(F.struct("evid", "n"))).alias("events"))
    return header.join(e, ["mid", "window_start"], "inner")


def alert_documents(header: DataFrame, uids: DataFrame, items: DataFrame, events: DataFrame) -> DataFrame:
    """One document per flagged window: header plus sorted account, item and event arrays."""
    key = ["mid", "window_start"]
    u = uids.groupBy(*key).agg(F.array_sort(F.collect_list("uid")).alias("uids"))
    i = items.groupBy(*key).agg(F.array_sort(F.collect_list("itemid")).alias("item_ids"))
    out = with_events(header, events).join(u, key, "inner").join(i, key, "left")
    return out.select("alert_id", "mid", "uids",
                      F.coalesce(F.col("item_ids"), F.array().cast("array<string>")).alias("item_ids"),
                      "events", "ts")


def _coupon_alerts_native(events, window_seconds, slide_seconds, min_uids, bucket_seconds):
    """Fallback when the window is not a whole number of slides: values on ``F.window``."""
    t = F.timestamp_millis(F.col("ts"))
    w = F.window(t, f"{window_seconds} seconds", f"{slide_seconds} seconds")
    values = (_tagged(events).groupBy(w.alias("w"), "mid", "kind", "value")
              .agg(F.count(F.lit(1)).alias("n"))
              .select("mid", F.unix_millis(F.col("w.start")).alias("window_start"),
                      "kind", "value", "n"))
    return alert_documents(*parts_from_values(values, window_seconds, min_uids, bucket_seconds))


def alert_values_stream(events: DataFrame, window_seconds: int = WINDOW_SECONDS,
                        slide_seconds: int = SLIDE_SECONDS,
                        watermark: str = "1 minute") -> DataFrame:
    """Streaming ``window_values``: (mid, window_start, kind, value, n) per closed window.

    Two stateful aggregations, chained, with a watermark on the event time.
    The first counts per (device, slide-long pane, kind, value); a pane is
    emitted once the watermark has passed it, and only then meets the
    ``window / slide`` windows that contain it, by its ``window_time``, in the
    second.  So what is multiplied are panes, not events.  A window's rows are
    emitted when the watermark passes its end, all in one micro-batch.  State
    is one count per (pane or window, device, kind, value), spread over keys by
    account, so no state entry grows with a device's number of accounts.
    ``events`` carries epoch-ms ``ts``.
    """
    if window_seconds % slide_seconds:
        raise ValueError("window must be a whole number of slides")
    timed = _tagged(events).withColumn("event_time", F.timestamp_millis(F.col("ts")))
    timed = timed.withWatermark("event_time", watermark)
    pane = F.window("event_time", f"{slide_seconds} seconds")
    panes = timed.groupBy(pane.alias("p"), "mid", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    w = F.window(F.window_time("p"), f"{window_seconds} seconds", f"{slide_seconds} seconds")
    agg = panes.groupBy(w.alias("w"), "mid", "kind", "value").agg(F.sum("n").alias("n"))
    return agg.select("mid", F.unix_millis(F.col("w.start")).alias("window_start"),
                      "kind", "value", "n")


def alert_per_bucket(alerts: DataFrame) -> DataFrame:
    """One alert per ``alert_id`` (device and minute): the latest window wins."""
    return pick_per_key(alerts, ["alert_id"], ["ts"], latest=True)


def events_text(col: str | Column) -> Column:
    """``[(evid, n)]`` -> ``'evid:n,evid:n'``, one pair per event id."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(c, lambda p: F.concat(p["evid"], F.lit(":"),
                                                          p["n"].cast("string"))), ",")


def alerts_flat(alerts: DataFrame) -> DataFrame:
    """Arrays as comma-joined text (``evid:n`` for events), for reports and diffs."""
    return alerts.select(
        "alert_id", "mid",
        F.array_join("uids", ",").alias("uids"),
        F.array_join("item_ids", ",").alias("item_ids"),
        events_text("events").alias("events"),
        "ts",
    )
