"""Monitoring queries over the history tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import column
from ..operators.chains import downstream
from ..session import materialise


def in_ranges(df: DataFrame, key: str, order: Sequence[str], label: str, ranges: int | None = None) -> DataFrame:
    """``df`` written in ranges of ``key`` and ``order``, each row with the number of its range.

    However many rows a key has, and however they lie in time, a range is one partition's
    rows: a busy key is cut into as many ranges as it fills. ``ranges`` is their number,
    where it shall follow the number of rows.
    """
    by = [column(c) for c in (key, *order)]
    ranged = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    return materialise(ranged.withColumn("_range", F.spark_partition_id()), label)


def ranges_before(ranged: DataFrame, key: str, value: Column, order: Column) -> DataFrame:
    """For every range of a key but its first, the value of the last row of the range before.

    Only keys that reach over several ranges are looked at: at most one for each range.
    """
    spanning = ranged.groupBy(column(key).alias("_key")).agg(F.min("_range").alias("a"), F.max("_range").alias("b"))
    spanning = spanning.where("a != b").select("_key")
    rows = ranged.join(spanning, column(key).eqNullSafe(F.col("_key")), "left_semi")
    lasts = rows.groupBy(column(key).alias("_key"), "_range").agg(F.max_by(F.struct(value.alias("v")), order).alias("_held"))
    before = F.lag("_held").over(Window.partitionBy("_key").orderBy("_range"))
    return lasts.select("_key", F.col("_range").alias("_at_range"), before.alias("_carried")).where("_carried is not null")


def with_previous(df: DataFrame, key: str, at: str, value: str, name: str, ties: Sequence[str] = ()) -> DataFrame:
    """Add the ``value`` of the row before, per ``key`` in the order of ``at`` and ``ties``.

    Rows lie in ranges of key and time, so a key with a very long history, or with all of
    it in one instant, is spread over many tasks; the first row of a range takes the last
    value of the key's range before.
    """
    order = F.struct(*[column(c) for c in (at, *ties)])
    ranged = in_ranges(df, key, (at, *ties), "ranges")
    carried = materialise(ranges_before(ranged, key, column(value), order), "carried")
    inside = Window.partitionBy(column(key), "_range").orderBy(order.asc_nulls_first())
    held = F.lag(F.struct(column(value).alias("v"))).over(inside)
    paired = ranged.withColumn("_held", held).join(
        carried, column(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_at_range")), "left"
    )
    previous = F.coalesce("_held", "_carried")["v"]
    return paired.select(*[column(c) for c in df.columns], previous.alias(name))


def with_next(rows: DataFrame, points: DataFrame, key: str, at: str, name: str, ranges: int) -> DataFrame:
    """Add the least ``at`` of ``points`` of the same key that is greater than the row's ``at``.

    Rows and points lie in ``ranges`` ranges of key and value together; what a range does not
    hold is the first point of the key's next range that holds one.
    """
    whole = F.struct(*[column(c) for c in rows.columns]).alias("_whole")
    asked = rows.select(column(key).alias("_key"), column(at).alias("_at"), F.lit(1).alias("_asks"), whole)
    held = points.select(
        column(key).alias("_key"), column(at).alias("_at"), F.lit(0).alias("_asks"), F.lit(None).cast(rows.select(whole).schema[0].dataType).alias("_whole")
    )
    ranged = in_ranges(asked.union(held), "_key", ["_at", "_asks"], "next", ranges)
    point = F.when(F.col("_asks") == 0, F.col("_at"))
    # from above: Spark carries a value downwards in one pass, but not upwards
    above = Window.partitionBy("_key", "_range").orderBy(F.desc("_at"), F.desc("_asks")).rowsBetween(Window.unboundedPreceding, -1)
    found = ranged.withColumn("_next", F.last(point, ignorenulls=True).over(above)).where("_asks = 1")
    firsts = ranged.groupBy("_key", "_range").agg(F.min(point).alias("_first"))
    later = Window.partitionBy("_key").orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select(F.col("_key").alias("_of"), F.col("_range").alias("_in"), F.last("_first", ignorenulls=True).over(later).alias("_later"))
    joined = found.join(materialise(firsts.where("_later is not null"), "later"), (F.col("_key") == F.col("_of")) & (F.col("_range") == F.col("_in")), "left")
    return joined.select("_whole.*", F.coalesce("_next", "_later").alias(name))


def failure_reach(stages: DataFrame, dependencies: DataFrame) -> DataFrame:
    """``(run_id, stage_name, distance)``: the stages that failed ones keep from running.

    ``stages`` holds ``run_id``, ``stage_name`` and ``status``, ``dependencies`` a list
    ``depends_on`` for ``run_id`` and ``stage_name``. A stage is reached if it depends on a
    failed or a reached one; ``distance`` counts the steps from the nearest failed stage.
    """
    edges = dependencies.select("run_id", "stage_name", F.explode("depends_on").alias("after"))
    failed = stages.where("status = 'failed'").select("run_id", "stage_name")
    return downstream(edges, failed, ["run_id"], "stage_name", "after").where("distance > 0")


def run_totals(stages: DataFrame) -> DataFrame:
    """Rows extracted, loaded and quarantined per run."""
    sums = [F.sum(F.coalesce(column(c), F.lit(0))).alias(c)
            for c in ("rows_extracted", "rows_loaded", "rows_quarantined")]
    return stages.groupBy("run_id").agg(*sums)


def status_of(success: Column) -> Column:
    """Aggregate: all stages succeeded, some did, or none did."""
    return (
        F.when(F.bool_and(success), "success")
        .when(F.bool_or(success), "partial")
        .otherwise("failed")
    )


def run_status(stages: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Status per run; a run listed in ``runs`` without any stage has failed."""
    found = stages.groupBy("run_id").agg(status_of(F.col("status") == "success").alias("status"))
    if runs is None:
        return found
    return runs.select("run_id").distinct().join(found, "run_id", "left").withColumn(
        "status", F.coalesce("status", F.lit("failed"))
    )


def filter_runs(runs: DataFrame, pipeline: str | None = None, status: str | None = None) -> DataFrame:
    if pipeline is not None:
        runs = runs.where(F.col("pipeline_name") == pipeline)
    if status is not None:
        runs = runs.where(F.col("status") == status)
    return runs


def run_kpis(runs: DataFrame) -> DataFrame:
    """Number of runs, share of successes, rows loaded and quarantined; one row."""
    total, good = F.count(F.lit(1)), F.count_if(F.col("status") == "success")

    def whole(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("bigint")).alias(name)

    return runs.agg(
        total.alias("total_runs"),
        good.alias("success_runs"),
        F.try_divide(good, total).alias("success_rate"),
        whole("rows_loaded"),
        whole("rows_quarantined"),
    )


def run_duration(runs: DataFrame) -> DataFrame:
    """Add the duration in seconds; 0 while a run is open."""
    started, finished = F.col("started_at"), F.col("finished_at")
    micros = F.timestamp_diff("MICROSECOND", started, finished)
    return runs.withColumn("duration_seconds", F.coalesce(micros / 1e6, F.lit(0.0)))


def quarantine_rate(stages: DataFrame) -> DataFrame:
    """Add the share of extracted rows that was quarantined; 0 when nothing was extracted."""
    share = F.try_divide(F.col("rows_quarantined"), F.col("rows_extracted"))
    return stages.withColumn("quarantine_rate", F.coalesce(share, F.lit(0.0)))


def volume_by_metric(runs: DataFrame, ids: Sequence[str] = ("started_at",)) -> DataFrame:
    """Row counts of every run in long form, one row per run and metric."""
    metrics = ["rows_extracted", "rows_loaded", "rows_quarantined"]
    return runs.unpivot([column(i) for i in ids], metrics, "metric", "rows")


def latest_score(scores: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """The newest known score per data set."""
    order = F.struct(*[column(c) for c in ("recorded_at", *ties)])
    known = F.when(F.col("score").isNotNull(), order)
    return scores.groupBy("dataset").agg(F.max_by("score", known).alias("score"))


def score_trend(scores: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Scores with the change since the data set's last score."""
    trend = with_previous(scores, "dataset", "recorded_at", "score", "previous_score", ties=ties)
    drift = F.col("score") - F.col("previous_score")
    return trend.withColumn("drift", drift)


def schema_change_type(snapshot: str, previous: str) -> Column:
    """How a snapshot, a map of column types, differs from the one before."""
    now, before = F.map_keys(snapshot), F.map_keys(previous)
    retyped = F.exists(now, lambda c: F.col(snapshot)[c] != F.col(previous)[c])
    return (
        F.when(F.col(previous).isNull(), "initial")
        .when(F.size(F.array_except(now, before)) > 0, "added")
        .when(F.size(F.array_except(before, now)) > 0, "removed")
        .when(retyped, "changed")
        .otherwise("unchanged")
    )


def schema_changes(snapshots: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Classify every schema snapshot against the data set's one before."""
    paired = with_previous(snapshots, "dataset", "recorded_at", "schema_snapshot", "_previous", ties=ties)
    return paired.withColumn("change_type", schema_change_type("schema_snapshot", "_previous")).drop("_previous")
