"""Loading into plain Parquet tables: replace, keyed upsert, append.

A table is a folder of immutable segments plus a manifest naming the segments
that make up its current state. Every attempt of a load writes into a folder of
its own, and publishes it with one manifest entry last, so readers see all of a
load or nothing, and no file that a manifest names is ever overwritten. An entry
is one file that appears whole, under a number of its own: of two writers that
began with the same state the second to publish fails, and its load has no effect.
An upsert rewrites only the files that hold a key of the batch.

Each segment remembers the version whose rows it holds. Loading under a version
again, however many others came in between, takes the place of what that version
loaded before, so a retried or replayed load is not applied twice.

Only the newest whole manifest entry is read; what a dead writer left is passed over.
``compact`` merges segments and ``vacuum`` removes what old entries alone name, and what
no entry names, so it must not run beside a writer.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import column
from ..session import materialise, small_frame
from ..storage import delete, is_folder, names, put_once

MANIFEST_SCHEMA = (
    "seq bigint, version string, strategy string, rows bigint, "
    "segments array<struct<version:string,name:string,without:array<string>>>, columns string"
)

#: The folders of an upsert's rewritten segments.
PART = "__part"
#: What a manifest entry of the folder kind holds once it is whole.
WHOLE = "_SUCCESS"


class Conflict(RuntimeError):
    """Another load was published since this one read the table."""


@dataclass(frozen=True)
class LoadResult:
    table: str
    strategy: str
    rows_loaded: int
    version: str
    #: Stored rows that were written again because their file held a key of the batch.
    rows_rewritten: int = 0


@dataclass(frozen=True)
class Segment:
    """The files of a folder, but for those ``without`` which it was left."""

    version: str
    name: str
    without: tuple[str, ...] = ()


def counted_write(df: DataFrame, write) -> int:
    """Run ``write`` on ``df`` and return its row count, observed on the way."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def merge_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Delete the target rows whose key is in the batch, then add the batch.

    Rows without a key are never deleted, and the batch is taken as it is.
    """
    return without_keys(target, batch, key).unionByName(batch)


def without_keys(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target rows whose key does not occur in the batch.

    The distinct keys are written once: their known size decides whether they
    are broadcast, and otherwise a hot key of the target is split at run time.
    """
    keys = batch.select(column(key)).dropna().distinct()
    return target.join(materialise(keys, "keys"), key, "left_anti")


class Table:
    """A Parquet table under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _entries(self) -> list[str]:
        """The names of whole manifest entries, in ascending order."""
        folder = f"{self.path}/_manifest"
        visible = [n for n in names(self.spark, folder) if not n.startswith((".", "_"))]
        return [n for n in visible if not is_folder(self.spark, f"{folder}/{n}") or WHOLE in names(self.spark, f"{folder}/{n}")]

    def _next(self) -> int:
        """A number that no entry has, whole or not."""
        taken = [int(n) for n in names(self.spark, f"{self.path}/_manifest") if n.isdigit()]
        return max(taken, default=-1) + 1

    def state(self) -> Row | None:
        """The newest manifest entry; None for a table that was never loaded."""
        entries = self._entries()
        if not entries:
            return None
        return self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.path}/_manifest/{entries[-1]}").first()

    def exists(self) -> bool:
        return self.state() is not None

    def _files(self, segment: Segment) -> list[str]:
        """The paths of a segment: its folder, or its files where it was left without some."""
        folder = f"{self.path}/{segment.name}"
        if not segment.without:
            return [folder]
        left = set(names(self.spark, folder)) - set(segment.without)
        return [f"{folder}/{n}" for n in sorted(left) if not n.startswith((".", "_"))]

    def _segments(self, segments: list[Segment], schema: T.StructType) -> DataFrame:
        paths = [path for segment in segments for path in self._files(segment)]
        if not paths:
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
            return self.spark.range(0).select(*empty)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self) -> DataFrame:
        state = self.state()
        if state is None:
            raise FileNotFoundError(f"{self.path} was never loaded")
        return self._segments(_listed(state), _stored_schema(state))

    def load(
        self,
        df: DataFrame,
        strategy: str = "full",
        key: str | None = None,
        version: str | None = None,
    ) -> LoadResult:
        """Load ``df``: ``full`` replaces table and schema, ``incremental`` upserts by
        ``key``, or appends when there is no key, no such column or no table yet."""
        if strategy not in ("full", "incremental"):
            raise ValueError(f"Unknown load strategy: {strategy}")
        attempt = uuid.uuid4().hex
        version = version or attempt
        number, base = self._next(), self.state()
        fresh = strategy == "full" or base is None
        schema = df.schema if fresh else _stored_schema(base)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        if not fresh:
            df = self._fitted(df, schema)
        batch = Segment(version, f"segments/{attempt}/batch")
        rows = counted_write(df, lambda d: self._write(d, batch.name))
        kept, rewritten = [] if fresh else [s for s in _listed(base) if s.version != version], 0
        if key and key in df.columns:
            kept, rewritten = self._delete_keys(kept, batch, schema, key, attempt)
        self._publish(number, version, strategy, rows, [*kept, batch], schema)
        return LoadResult(self.path, strategy, rows, version, rewritten)

    def compact(self) -> None:
        """Write the current rows as one segment. Versions before can no longer be replayed."""
        number, state = self._next(), self.state()
        if state is None or (len(state["segments"]) < 2 and not any(s.without for s in _listed(state))):
            return
        attempt = uuid.uuid4().hex
        merged = Segment(attempt, f"segments/{attempt}/batch")
        rows = counted_write(self.read(), lambda d: self._write(d, merged.name))
        self._publish(number, attempt, "compact", rows, [merged], _stored_schema(state))

    def vacuum(self, keep: int = 10) -> None:
        """Remove all but the newest ``keep`` manifest entries, and the files none of these names.

        Whoever still reads a state older than these loses its files.
        """
        folder, entries = f"{self.path}/_manifest", self._entries()
        if not entries:
            return
        for entry in set(names(self.spark, folder)) - set(entries[-keep:]):
            delete(self.spark, f"{folder}/{entry}")
        left = self.spark.read.schema(MANIFEST_SCHEMA).json([f"{folder}/{entry}" for entry in entries[-keep:]])
        unread: dict[str, set[str]] = {}
        for state in left.collect():
            for segment in _listed(state):
                unread[segment.name] = unread.get(segment.name, set(segment.without)) & set(segment.without)
        named = {name.split("/")[1] for name in unread}
        for attempt in set(names(self.spark, f"{self.path}/segments")) - named:
            delete(self.spark, f"{self.path}/segments/{attempt}")
        for name, files in unread.items():
            for file in files:
                delete(self.spark, f"{self.path}/{name}/{file}")

    def _fitted(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """The batch in the table's column order and types; absent columns are null."""
        extra = [c for c in df.columns if c not in schema.names]
        if extra:
            raise ValueError(f"{self.path} has no columns {extra}")
        return df.to(schema)

    def _delete_keys(
        self, kept: list[Segment], batch: Segment, schema: T.StructType, key: str, attempt: str
    ) -> tuple[list[Segment], int]:
        """Segments without the batch's keys, and the rows written again.

        A file that holds none of the keys stays where it is; the others' rows that remain
        are written to a segment beside, of the same version.
        """
        keys = self._segments([batch], schema).select(column(key)).dropna().distinct()
        keys = materialise(keys, "keys")
        low, high = keys.agg(F.min(column(key)), F.max(column(key))).first()
        if low is None or not kept:
            return kept, 0
        # The range of the batch's keys lets the scan skip row groups by their statistics.
        stored = self._segments(kept, schema).select(column(key), F.col("_metadata.file_path").alias("_file"))
        hit = stored.where(column(key).between(F.lit(low), F.lit(high))).join(keys, key, "left_semi")
        place = F.regexp_extract("_file", r"(segments/.+)/([^/]+)$", 1), F.regexp_extract("_file", r"([^/]+)$", 1)
        touched: dict[str, set[str]] = {}
        for name, file in hit.select("_file").distinct().select(*place).collect():  # names of files, as a manifest lists them
            touched.setdefault(name, set()).add(unquote(file))
        if not touched:
            return kept, 0
        # Every segment is rewritten into one of its own, so that it stays its version's.
        number = {name: i for i, name in enumerate(sorted(touched))}
        numbered = small_frame(self.spark, [{"_name": n, PART: i} for n, i in number.items()], f"_name string, {PART} int")
        paths = [f"{self.path}/{name}/{file}" for name, files in touched.items() for file in sorted(files)]
        old = self.spark.read.schema(schema).parquet(*paths)
        old = old.withColumn("_name", F.regexp_extract("_metadata.file_path", r"(segments/.+)/[^/]+$", 1))
        left = old.join(keys, key, "left_anti").join(numbered, "_name").select(*[column(c) for c in schema.names], PART)
        target = f"{self.path}/segments/{attempt}/kept"
        rewritten = counted_write(left, lambda d: d.write.partitionBy(PART).parquet(target))
        written = set(names(self.spark, target))
        segments = []
        for segment in kept:
            without = touched.get(segment.name)
            if without is None:
                segments.append(segment)
                continue
            rest = replace(segment, without=tuple(sorted({*segment.without, *without})))
            if self._files(rest):
                segments.append(rest)
            part = f"{PART}={number[segment.name]}"
            if part in written:
                segments.append(Segment(segment.version, f"segments/{attempt}/kept/{part}"))
        return segments, rewritten

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.parquet(f"{self.path}/{name}")

    def _publish(
        self, number: int, version: str, strategy: str, rows: int, segments: list[Segment], schema: T.StructType
    ) -> None:
        entry = {"seq": number, "version": version, "strategy": strategy, "rows": rows,
                 "segments": [asdict(s) for s in segments], "columns": schema.json()}
        if not put_once(self.spark, f"{self.path}/_manifest/{number:012d}", json.dumps(entry)):
            raise Conflict(f"{self.path}: another load was published as number {number}; this one has no effect")


def _listed(state: Row) -> list[Segment]:
    return [Segment(s["version"], s["name"], tuple(s["without"] or ())) for s in state["segments"]]


def _stored_schema(state: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(state["columns"]))


def write_jdbc(df: DataFrame, url: str, table: str, strategy: str = "full", **options: str) -> int:
    """Replace or append a database table; returns the rows written.

    Appends only: a keyed delete inside the database is not something Spark's
    JDBC writer does.
    """
    mode = {"full": "overwrite", "incremental": "append"}[strategy]
    options = {"batchsize": "5000", **options}
    return counted_write(df, lambda d: d.write.jdbc(url, table, mode, options))
