"""Alerts: what is worth telling, to whom, and what was told a moment ago."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import column, column_type, epoch_micros
from ..operators.chains import follow
from ..session import materialise
from .monitor import in_ranges, with_next

# Severities by rank; an unknown one ranks as an error.
SEVERITY_RANK = {"info": 0, "warning": 1, "error": 2, "critical": 3}
UNKNOWN_RANK = 2

# Keys, subjects and bodies of alerts, and a line of a body.
QUALITY_KEY = "quality:%s:%s"
QUALITY_SUBJECT = "Data quality failure in %s/%s"
QUALITY_BODY = "Pipeline: %s\nStage: %s\nRun: %s\nQuality score: %.2f%%\nFailed expectations (%s):\n%s"
QUALITY_LINE = "- %s (%s): %s"
RUN_KEY = "run:%s"
RUN_SUBJECT = "Pipeline %s finished with status %s"
RUN_BODY = "Pipeline: %s\nRun: %s\nStatus: %s\nFailed stages (%s):\n%s"
RUN_LINE = "- %s: %s"

#: Minutes during which an alert is not repeated.
SUPPRESSION_MINUTES = 30
#: Distinct moments of alerts that a task holds, on average.
RANGE_ROWS = 500_000
#: Failures listed in a quality alert.
LISTED_FAILURES = 10


def dedup_key(key: Column, severity: Column) -> Column:
    """Identity of an alert: its key and a digest of key and severity."""
    digest = F.sha1(F.concat_ws("|", key, severity).cast("binary"))
    return F.concat(key, F.lit(":"), F.substring(digest, 1, 16))


def severity_rank(severity: Column) -> Column:
    rank = F.lit(UNKNOWN_RANK)
    for name, value in SEVERITY_RANK.items():
        rank = F.when(severity == name, value).otherwise(rank)
    return rank


def above_threshold(alerts: DataFrame, minimum: str = "error") -> DataFrame:
    """Alerts at least as severe as ``minimum``."""
    least = SEVERITY_RANK.get(minimum, UNKNOWN_RANK)
    return alerts.where(severity_rank(F.col("severity")) >= least)


def quality_alerts(metrics: DataFrame, scores: DataFrame, pipeline: Column) -> DataFrame:
    """One alert per run and stage with a failed error rule, listing the first of them.

    Picking the first failures per stage is limited before the shuffle, and the
    list collected for a message never has more than that many entries.
    """
    stage = ["run_id", "stage_name"]
    failed = metrics.where(~F.col("success") & (F.col("severity") == "error"))
    place = Window.partitionBy(*stage).orderBy("position", "expectation_name")
    listed = failed.withColumn("_place", F.row_number().over(place)).where(
        F.col("_place") <= LISTED_FAILURES
    )
    line = F.format_string(QUALITY_LINE, "expectation_name", "expectation_type", "message")
    lines = listed.groupBy(*stage).agg(
        F.sort_array(F.collect_list(F.struct("_place", line.alias("line"))))["line"].alias("lines")
    )
    counts = failed.groupBy(*stage).agg(F.count("*").alias("failures"))
    found = counts.join(lines, stage).join(scores.select(*stage, "score"), stage)
    score = F.col("score").cast("double") * 100
    body = F.format_string(
        QUALITY_BODY, pipeline, "stage_name", "run_id", score, "failures", F.array_join("lines", "\n")
    )
    return found.select(
        *stage,
        F.format_string(QUALITY_KEY, pipeline, "stage_name").alias("key"),
        F.format_string(QUALITY_SUBJECT, pipeline, "stage_name").alias("subject"),
        body.alias("body"),
        F.lit("error").alias("severity"),
    )


def run_failure_alerts(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """One alert per finished run that did not fully succeed, naming its failed stages."""
    line = F.format_string(RUN_LINE, "stage_name", F.coalesce("error_message", F.lit("None")))
    failed = stages.where(F.col("status") == "failed").groupBy("run_id").agg(
        F.count("*").alias("failures"),
        F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("lines"),
    )
    bad = runs.where(F.col("status").isin("partial", "failed"))
    found = bad.join(failed, "run_id", "left")
    body = F.format_string(
        RUN_BODY, "pipeline_name", "run_id", "status", F.coalesce("failures", F.lit(0)), F.coalesce("lines", F.lit(""))
    )
    return found.select(
        "run_id",
        F.format_string(RUN_KEY, "pipeline_name").alias("key"),
        F.format_string(RUN_SUBJECT, "pipeline_name", "status").alias("subject"),
        body.alias("body"),
        F.lit("error").alias("severity"),
    )


# -- suppression ----------------------------------------------------------------------------
#
# An alert is sent if no alert of its key was *sent* in the minutes before it. That makes
# each decision depend on the one before, along the whole history of a key. The alerts lie
# in ranges of key and time, of a bounded number of rows; a range is decided by itself once
# it is known when the key's last alert before the range was sent.
#
# For keys that reach over several ranges, each range is first reduced to steps: whichever
# alert of the range is the first to be sent, the step says which is the last. From a step's
# last alert the way leads to the step of a later range that holds the next alert sent. So
# the steps of a key are a linked list that visits a range once at most, and doubling the
# links marks the steps on the way in as many rounds as the number of ranges has bits.


def _following(times: np.ndarray, window: int) -> np.ndarray:
    """For each alert, if it is sent, the place of the next one that is."""
    return np.searchsorted(times, times + window, side="right")


def _micros(rows: pa.Table, name: str) -> np.ndarray:
    return rows[name].combine_chunks().to_numpy(zero_copy_only=False)


def _range_function(window: int):
    def reduce_range(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        times = np.sort(_micros(rows, "_at"))
        follow = _following(times, window)
        # Follow the chain of sent alerts from every possible first one to its end in the
        # range, doubling the stride each time.
        places = np.arange(len(times))
        last = np.where(follow < len(times), follow, places)
        while not np.array_equal(last, last[last]):
            last = last[last]
        # Whatever was sent before is no later than the range's first alert.
        firsts = np.searchsorted(times, times[0] + window, side="right") + 1
        exits, starts = times[last[:firsts]], times[:firsts]
        final = np.append(exits[1:] != exits[:-1], True)
        starts, exits = starts[final], exits[final]
        named = [pa.repeat(part, len(starts)) for part in key]
        return pa.table([*named, starts, exits], names=["_key", "_range", "_start", "_exit"])

    return reduce_range


def _entered(moments: DataFrame, window: int, ranges: int) -> DataFrame:
    """``moments`` with ``_before``, the last alert sent before the range; without ranges that none is sent in."""
    spanning = moments.groupBy("_key").agg(F.min("_range").alias("a"), F.max("_range").alias("b"))
    # at most one key for each range
    spanning = materialise(spanning.where("a != b").select("_key"), "spanning")
    spread = moments.select("_key", "_range", "_at").join(spanning, "_key", "left_semi")
    steps = spread.groupBy("_key", "_range").applyInArrow(
        _range_function(window), "_key string, _range int, _start long, _exit long"
    )
    steps = materialise(steps, "steps")
    ends = steps.select("*", (F.col("_exit") + window).alias("_after"))
    points = steps.select("_key", F.col("_start").alias("_after"))
    steps = materialise(with_next(ends, points, "_key", "_after", "_next", ranges).drop("_after"), "linked-steps")
    starts = steps.groupBy("_key").agg(F.min("_start").alias("_start"))
    marked = follow(steps, starts, ["_key"], "_start", "_next", ranges)
    visited = steps.join(marked, ["_key", "_start"], "left_semi")
    visited = materialise(visited, "visited")
    before = visited.where("_next is not null").select("_key", F.col("_next").alias("_start"), F.col("_exit").alias("_before"))
    entries = materialise(visited.join(before, ["_key", "_start"], "left").select("_key", "_range", "_before"), "entries")
    alone = moments.join(spanning, "_key", "left_anti").withColumn("_before", F.lit(None).cast("bigint"))
    return alone.unionByName(moments.join(entries, ["_key", "_range"]))


def _decide(window: int):
    """Which alerts of a range are sent. Keys are numbered, so no text becomes an object of Python's."""

    def decide_range(rows: pa.Table) -> pa.Table:
        number = rows["_key"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        times = _micros(rows, "_at")
        order = np.lexsort((times, number))
        number, times = number[order], times[order]
        entered = rows["_before"].combine_chunks()
        known = entered.is_valid().to_numpy(zero_copy_only=False)[order]
        before = entered.fill_null(0).to_numpy(zero_copy_only=False)[order]
        chosen = []
        starts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        for start, end in zip(starts, np.append(starts[1:], len(times))):
            own = times[start:end]
            place = int(np.searchsorted(own, before[start] + window, side="right")) if known[start] else 0
            follow = _following(own, window)
            while place < len(own):
                chosen.append(start + place)
                place = int(follow[place])
        sent = rows["_id"].take(pa.array(order[np.array(chosen, dtype=np.int64)]))
        return pa.table([sent], names=["_sent"])

    return decide_range


def suppress_repeats(
    alerts: DataFrame, key: str = "alert_key", at: str = "created_at", id_column: str = "alert_id",
    minutes: int = SUPPRESSION_MINUTES,
) -> DataFrame:
    """Add ``suppressed``: an alert of the same key was sent at most ``minutes`` ago.

    ``id_column`` identifies an alert; of several at one instant the lowest id
    goes first. Alerts without a key are of one key; alerts without a time are sent.
    """
    window = minutes * 60_000_000
    micros = epoch_micros(column(at), column_type(alerts, at))
    id_type = column_type(alerts, id_column).simpleString()
    named = F.concat(F.when(column(key).isNull(), "-").otherwise("+"), F.coalesce(column(key).cast("string"), F.lit("")))
    moments = alerts.where(column(at).isNotNull()).groupBy(named.alias("_key"), micros.alias("_at")).agg(
        F.min(column(id_column)).alias("_id")
    )
    moments = materialise(moments, "instants")
    ranges = moments.count() // RANGE_ROWS + 1
    moments = in_ranges(moments, "_key", ["_at"], "moments", ranges)
    if ranges > 1:
        moments = _entered(moments, window, ranges)
    else:
        moments = moments.withColumn("_before", F.lit(None).cast("bigint"))
    sent = moments.groupBy("_range").applyInArrow(_decide(window), f"_sent {id_type}")
    flagged = alerts.join(materialise(sent, "sent"), column(id_column) == F.col("_sent"), "left")
    return flagged.withColumn("suppressed", F.col("_sent").isNull() & column(at).isNotNull()).drop("_sent")


def alert_log_rows(alerts: DataFrame, channels: Sequence[str], minimum: str = "error") -> DataFrame:
    """What the alert log records: a row per channel, or one for all when suppressed.

    ``alerts`` carries ``suppressed``; alerts below the threshold leave no row.
    ``sent`` says that the alert is handed to the channel, whose sender reads it here.
    """
    every = F.array(*[F.lit(c) for c in channels]) if channels else F.array().cast("array<string>")
    channel = F.explode(F.when(F.col("suppressed"), F.array(F.lit("all"))).otherwise(every))
    return above_threshold(alerts, minimum).withColumns(
        {"channel": channel, "sent": ~F.col("suppressed")}
    )


def keyed(alerts: DataFrame, minimum: str = "error") -> DataFrame:
    """Alerts worth sending, with their ``alert_key``."""
    loud = above_threshold(alerts, minimum)
    return loud.withColumn("alert_key", dedup_key(F.col("key"), F.col("severity")))


def dispatch(
    alerts: DataFrame,
    channels: Sequence[str],
    at: str = "created_at",
    id_column: str = "alert_id",
    minimum: str = "error",
    minutes: int = SUPPRESSION_MINUTES,
) -> DataFrame:
    """Log rows for a whole history of alerts: threshold, key, suppression, channels."""
    if not channels:  # nothing is sent, so nothing is suppressed or recorded either
        return alert_log_rows(alerts.withColumn("suppressed", F.lit(False)), [], minimum)
    flagged = suppress_repeats(keyed(alerts, minimum), "alert_key", at, id_column, minutes)
    return alert_log_rows(flagged, channels, minimum)


def dispatch_new(
    alerts: DataFrame,
    log: DataFrame,
    channels: Sequence[str],
    now: Column,
    minimum: str = "error",
    minutes: int = SUPPRESSION_MINUTES,
) -> DataFrame:
    """Log rows for alerts of this moment, one per key, given what was sent before."""
    since = F.timestamp_add("MINUTE", F.lit(-minutes), now)
    recent = log.where(F.col("sent") & (F.col("created_at") >= since)).select("alert_key").distinct()
    flagged = keyed(alerts, minimum).join(
        recent.withColumn("suppressed", F.lit(True)), "alert_key", "left"
    )
    flagged = flagged.withColumn("suppressed", F.coalesce("suppressed", F.lit(False)))
    return alert_log_rows(flagged, channels, minimum)
