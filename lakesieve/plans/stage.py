"""A stage: extract, check, separate, quarantine, transform, load, record."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import normalise_missing
from ..operators.rules import RuleSet, ValidationReport
from ..operators.split import find_duplicates, split
from ..operators.transforms import apply_steps
from ..operators.validate import validate
from ..session import ROW, landed
from ..sinks.quarantine import quarantine_path, quarantine_rows
from ..sinks.tables import Table, write_jdbc
from ..sources import Source, extract_rows
from ..sources.files import watermark
from . import alerts
from .history import History, latest_state, quality_rows

log = logging.getLogger(__name__)

#: ``Stage.since``: go on where the target table ends.
LATEST = "latest"

DEFAULT_REASON = "quality_failure"
ROW_COUNTS = ("rows_extracted", "rows_loaded", "rows_quarantined")


@dataclass(frozen=True)
class Stage:
    """What to load from where, under which rules, and how.

    ``source`` is a source description or a DataFrame. ``target_table`` is a
    folder name under the warehouse, the stage's name by default. ``target``
    names another place: ``{"type": "parquet", "path": ...}`` or, for a table of a
    database, ``{"type": "jdbc", "url": ..., "options": {...}}``, which appends or
    replaces but does not upsert.

    ``since`` limits an incremental source to newer rows; :data:`LATEST` means newer
    than the newest key the target table holds.

    ``profile`` names loaded columns of which every run keeps sketches in its history.
    """

    name: str
    source: Source | DataFrame
    rules: RuleSet | None = None
    steps: Sequence[Mapping[str, Any]] = ()
    target_table: str | None = None
    load_strategy: str = "full"
    incremental_key: str | None = None
    depends_on: Sequence[str] = ()
    order_by: Sequence[str] = ()
    since: Any = None
    target: Mapping[str, Any] | None = None
    profile: Sequence[str] = ()

    def __post_init__(self) -> None:
        if self.load_strategy not in ("full", "incremental"):
            raise ValueError(f"stage {self.name!r}: unknown load strategy {self.load_strategy!r}")
        if self.target and self.target.get("type", "parquet") not in ("parquet", "jdbc"):
            raise ValueError(f"stage {self.name!r}: unknown target type {self.target['type']!r}")

    @property
    def table(self) -> str:
        return self.target_table or self.name


def stages_from_config(
    pipeline: Mapping[str, Any],
    sources: Mapping[str, Mapping[str, Any]],
    rule_sets: Mapping[str, Mapping[str, Any]],
    targets: Mapping[str, Mapping[str, Any]] | None = None,
) -> list[Stage]:
    """Stages of a pipeline configuration whose sources, rule sets and targets are given by name.

    A target that ``targets`` does not hold is the warehouse. A stage's ``since`` is a value,
    or ``latest``.
    """
    stages = []
    for entry in pipeline.get("stages", ()):
        source = sources[entry["source"]]
        rules = entry.get("quality_rule_set")
        stages.append(
            Stage(
                entry["name"],
                Source(source["name"], source["type"], source.get("options") or {}),
                RuleSet.from_config(rule_sets[rules]) if rules else None,
                entry.get("transforms") or (),
                entry.get("target_table"),
                entry.get("load_strategy", "full"),
                entry.get("incremental_key"),
                entry.get("depends_on") or (),
                since=entry.get("since"),
                target=(targets or {}).get(entry.get("target")),
            )
        )
    return stages


@dataclass
class StageResult:
    name: str
    status: str
    rows_extracted: int = 0
    rows_loaded: int = 0
    rows_quarantined: int = 0
    quality_score: float | None = None
    quality_passed: bool | None = None
    error: str | None = None
    quarantine_path: str | None = None


@dataclass
class PipelineResult:
    run_id: str
    pipeline_name: str
    status: str
    started_at: dt.datetime
    finished_at: dt.datetime | None = None
    stages: list[StageResult] = field(default_factory=list)

    def total(self, name: str) -> int:
        return sum(getattr(s, name) for s in self.stages)

    @property
    def duration_seconds(self) -> float:
        """0 while the run is open."""
        return (self.finished_at - self.started_at).total_seconds() if self.finished_at else 0.0

    def to_dict(self) -> dict[str, Any]:
        totals = {c: self.total(c) for c in ROW_COUNTS}
        return {**asdict(self), **totals, "duration_seconds": self.duration_seconds}


@dataclass(frozen=True)
class Places:
    """Where a pipeline keeps its tables, its rejected rows and its history."""

    warehouse: str
    quarantine: str
    history: str | None = None


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def source_rows(spark: SparkSession, stage: Stage, since: Any) -> tuple[DataFrame, DataFrame]:
    """The stage's input, safe to read several times: with ``_row``, and without."""
    if isinstance(stage.source, Source):
        return extract_rows(spark, stage.source, since)
    df = normalise_missing(stage.source)
    return (df, df.drop(ROW)) if ROW in df.columns else landed(df, "rows")


def target_name(stage: Stage, places: Places) -> str:
    """Where the stage's table lies: a folder, or a database."""
    target = stage.target or {}
    return (target.get("url") or target.get("path") or places.warehouse).rstrip("/")


def newest_loaded(spark: SparkSession, stage: Stage, places: Places) -> Any:
    """The newest value of the source's incremental key that the target table holds."""
    key = stage.source.options.get("incremental_key") if isinstance(stage.source, Source) else None
    table = Table(spark, f"{target_name(stage, places)}/{stage.table}")
    if not key or not table.exists():
        return None
    rows = table.read()
    return watermark(rows, key) if key in rows.columns else None


def noted(write: Callable, *values: Any) -> Any:
    """Write to the history; what cannot be written is logged and changes nothing else."""
    try:
        return write(*values)
    except Exception as exc:
        log.warning("history not written: %s", exc)
        return None


def load(spark: SparkSession, df: DataFrame, stage: Stage, places: Places, strategy: str, version: str) -> int:
    """Load the stage's rows into its target and return their number."""
    if stage.target and stage.target.get("type") == "jdbc":
        return write_jdbc(df, stage.target["url"], stage.table, strategy, **stage.target.get("options") or {})
    table = Table(spark, f"{target_name(stage, places)}/{stage.table}")
    return table.load(df, strategy, stage.incremental_key, version).rows_loaded


def run_stage(
    spark: SparkSession,
    stage: Stage,
    places: Places,
    pipeline: str = "pipeline",
    run_id: str | None = None,
    at: dt.datetime | None = None,
    full_refresh: bool = False,
) -> tuple[StageResult, ValidationReport | None]:
    """Run one stage; valid rows are loaded even when rules fail.

    The input is read by the checks (only the columns rules name), and by the split:
    where copies must be told apart, which takes a join, its rows are written once and
    both sides read from there; otherwise each side evaluates the rules on its own scan.
    """
    history = History(spark, places.history) if places.history else None
    notes: dict[str, list[dict[str, Any]]] = {}
    try:
        with ThreadPoolExecutor(3) as side_jobs:
            return _run_stage(
                spark, stage, places, pipeline, run_id or uuid.uuid4().hex, at or utc_now(),
                full_refresh, side_jobs, history, notes,
            )
    finally:
        if history and notes:
            noted(history.record_all, notes)


def _run_stage(spark, stage, places, pipeline, run_id, started, full_refresh, side_jobs, history, notes):
    """Jobs that do not wait for each other run side by side: looking for duplicated keys
    beside the other checks, and the last schema. ``notes`` gathers what the history is to
    hold, by table, to be written by one job."""
    strategy = "full" if full_refresh else stage.load_strategy
    since = stage.since
    if since == LATEST:
        since = newest_loaded(spark, stage, places) if strategy == "incremental" else None
    df, data = source_rows(spark, stage, since)
    schema = side_jobs.submit(noted, history.schema_rows, run_id, stage.name, data, started) if history else None

    report, rejected, path = None, 0, None
    if stage.rules is not None:
        duplicates = side_jobs.submit(find_duplicates, df, stage.rules, stage.order_by, data)
        report = validate(data, stage.rules, stage.name, duplicates.result)
        notes.update(quality_rows(run_id, stage.name, report, started))
        sides = split(df, stage.rules, stage.order_by, report, duplicates.result()).settled()
        rejected = quarantine_rows(
            sides.quarantined.drop(ROW), places.quarantine, pipeline, stage.name, run_id, started
        )
        if rejected:
            path = quarantine_path(places.quarantine, pipeline, stage.name, run_id)
        df = sides.valid

    if stage.steps:
        df = apply_steps(df, stage.steps)
    loaded = load(spark, df.drop(ROW), stage, places, strategy, f"{run_id}/{stage.name}")
    extracted = report.row_count if report else data.count()

    if history and stage.profile:
        noted(history.record_profiles, run_id, stage.name, df, stage.profile, started)
    if history:
        notes.update(schema.result() or {})
        named = stage.source if isinstance(stage.source, Source) else Source("dataframe", "dataframe")
        base, target = {"run_id": run_id, "stage_name": stage.name}, target_name(stage, places)
        notes.update({
            "quarantine_log": [{
                **base, "pipeline_name": pipeline, "row_count": rejected,
                "reason": DEFAULT_REASON, "file_path": path, "recorded_at": started,
            }] if rejected else [],
            "stage_runs": [{
                **base, "source_name": named.name, "target_name": target,
                "target_table": stage.table, "load_strategy": strategy, "status": "success",
                "rows_extracted": extracted, "rows_loaded": loaded,
                "rows_quarantined": rejected, "started_at": started, "finished_at": utc_now(),
            }],
            "lineage": [{
                **base, "pipeline_name": pipeline, "source_name": named.name,
                "source_type": named.type, "target_name": target,
                "target_table": stage.table, "recorded_at": started,
            }],
        })
    result = StageResult(
        stage.name, "success", extracted, loaded, rejected,
        report.score if report else None, report.success if report else None,
        quarantine_path=path,
    )
    return result, report


def overall_status(statuses: Sequence[str]) -> str:
    """Success if every stage succeeded, partial if some did, failed otherwise."""
    good = sum(s == "success" for s in statuses)
    if not good:
        return "failed"
    return "success" if good == len(statuses) else "partial"


def run_pipeline(
    spark: SparkSession,
    name: str,
    stages: Sequence[Stage],
    places: Places,
    run_id: str | None = None,
    full_refresh: bool = False,
    triggered_by: str = "manual",
    channels: Sequence[str] = (),
) -> PipelineResult:
    """Run stages whose dependencies succeeded, in listed order; skip the others.

    A failed stage does not stop the ones that do not depend on it. With
    ``channels``, failed rules and stages leave alerts for them in the history.
    """
    run_id, started = run_id or uuid.uuid4().hex, utc_now()
    history = History(spark, places.history) if places.history else None
    if history:
        noted(history.start_run, run_id, name, started, triggered_by)
        listed = [
            {"run_id": run_id, "stage_name": s.name, "pipeline_name": name, "depends_on": list(s.depends_on), "recorded_at": started}
            for s in stages if s.depends_on
        ]
        noted(history.record, "stage_dependencies", listed)
    result = PipelineResult(run_id, name, "running", started)
    waiting, done = list(stages), set()
    while ready := next((s for s in waiting if done.issuperset(s.depends_on)), None):
        waiting.remove(ready)
        try:
            outcome, _ = run_stage(
                spark, ready, places, name, run_id, started, full_refresh
            )
            done.add(ready.name)
        except Exception as exc:
            outcome = StageResult(ready.name, "failed", error=str(exc))
            if history:
                noted(_record_failure, history, run_id, ready, places, exc)
        result.stages.append(outcome)
    for stage in waiting:
        unmet = [d for d in stage.depends_on if d not in done]
        result.stages.append(
            StageResult(stage.name, "skipped", error=f"Unmet dependencies: {unmet}")
        )
    result.status = overall_status([s.status for s in result.stages])
    result.finished_at = utc_now()
    if history:
        rows = {c: result.total(c) for c in ROW_COUNTS}
        noted(
            history.finish_run, run_id, name, result.status, started, result.finished_at, rows, triggered_by
        )
        if channels:
            noted(record_alerts, history, run_id, name, channels, result.finished_at)
    return result


def record_alerts(
    history: History, run_id: str, pipeline: str, channels: Sequence[str], at: dt.datetime
) -> None:
    """Write the alerts of a run to the alert log, unless the same were sent just before."""
    mine = F.col("run_id") == run_id
    quality = alerts.quality_alerts(
        history.table("quality_metrics").where(mine),
        history.table("quality_scores").where(mine),
        F.lit(pipeline),
    )
    failure = alerts.run_failure_alerts(
        latest_state(history.table("pipeline_runs").where(mine)),
        history.table("stage_runs").where(mine),
    )
    raised = quality.unionByName(failure, allowMissingColumns=True)
    earlier = history.table("alert_log").where(~mine)
    rows = alerts.dispatch_new(raised, earlier, channels, F.lit(str(at)).cast("timestamp"))
    # At most one alert per stage and one for the run.
    history.record("alert_log", [{**row.asDict(), "created_at": at} for row in rows.collect()])


def _record_failure(history, run_id, stage, places, exc) -> None:
    named = stage.source.name if isinstance(stage.source, Source) else "dataframe"
    now = utc_now()
    history.record("stage_runs", [{
        "run_id": run_id, "stage_name": stage.name, "source_name": named,
        "target_name": target_name(stage, places), "status": "failed", "error_message": str(exc),
        "rows_extracted": 0, "rows_loaded": 0, "rows_quarantined": 0,
        "started_at": now, "finished_at": now,
    }])
    history.log_error(run_id, str(exc), now, stage.name)
