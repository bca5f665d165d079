"""Loads, their atomicity and repetition, and the quarantine."""

import datetime as dt

import pytest
from conftest import rows_of

from lakesieve import Table, storage
from lakesieve.sinks import quarantine
from lakesieve.sinks.tables import Conflict, merge_by_key

AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def target(spark, folder):
    return Table(spark, folder())


def test_full_load_replaces_rows_and_schema(target, frame):
    first = target.load(frame("id int, v string", (1, "a"), (2, "b")))
    assert (first.rows_loaded, first.strategy) == (2, "full")
    assert target.load(frame("id int, w double", (3, 1.5))).rows_loaded == 1
    assert rows_of(target.read()) == [(3, 1.5)]
    assert target.read().columns == ["id", "w"]


def test_upsert(target, frame):
    target.load(frame("id int, v string", (1, "a"), (2, "b")))
    result = target.load(frame("id int, v string", (2, "B"), (3, "c")), "incremental", "id")
    assert (result.rows_loaded, result.strategy) == (2, "incremental")
    assert rows_of(target.read()) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_keeps_null_keys_and_copies_in_the_batch(target, frame):
    target.load(frame("id int, v string", (None, "n"), (1, "a"), (1, "b")))
    target.load(frame("id int, v string", (1, "x"), (1, "y"), (None, "m")), "incremental", "id")
    assert rows_of(target.read()) == [(None, "m"), (None, "n"), (1, "x"), (1, "y")]


def test_upsert_agrees_with_the_plain_merge(spark, target):
    old = spark.range(100).selectExpr("id % 40 as k", "id as v")
    new = spark.range(50).selectExpr("id * 3 as k", "-id as v")
    target.load(old)
    target.load(new, "incremental", "k")
    assert rows_of(target.read()) == rows_of(merge_by_key(old, new, "k"))


def test_incremental_without_key_column_or_table_appends(target, frame):
    batch = frame("id int, v string", (1, "a"))
    target.load(batch, "incremental", "id")
    target.load(batch, "incremental")
    target.load(batch, "incremental", "absent")
    assert target.read().count() == 3


def test_batch_columns_must_fit_the_table(target, frame):
    target.load(frame("id bigint, v string", (1, "a")))
    target.load(frame("id int", (2,)), "incremental")
    assert rows_of(target.read()) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError, match="zzz"):
        target.load(frame("id int, zzz int", (2, 2)), "incremental")
    assert target.read().count() == 2


def test_untouched_segments_are_not_rewritten(target, frame):
    target.load(frame("id int", (1,), (2,)), version="v1")
    target.load(frame("id int", (3,), (4,)), "incremental", "id", version="v2")
    target.load(frame("id int", (4,), (5,)), "incremental", "id", version="v3")
    segments = target.state()["segments"]
    assert [s["version"] for s in segments] == ["v1", "v2", "v3"]
    assert [s["name"].split("/", 2)[2].split("=")[0] for s in segments] == ["batch", "kept/__part", "batch"]
    assert rows_of(target.read()) == [(1,), (2,), (3,), (4,), (5,)]


def test_one_key_rewrites_one_file(spark, target):
    """A full load in eight files, by ranges of the key; then upserts of single keys."""
    whole = spark.range(0, 8000, 1, 8).selectExpr("id", "'old' as v")
    target.load(whole)
    for key, rewritten in ((17, 999), (18, 998), (7999, 999), (99_999, 0)):
        result = target.load(spark.range(key, key + 1).selectExpr("id", "'new' as v"), "incremental", "id")
        assert (result.rows_loaded, result.rows_rewritten) == (1, rewritten)
    expected = [(i, "new" if i in (17, 18, 7999) else "old") for i in range(8000)] + [(99_999, "new")]
    assert rows_of(target.read()) == sorted(expected)
    first = target.state()["segments"][0]
    assert len(first["without"]) == 2 and len(target.state()["segments"]) > 2
    target.compact()
    assert len(target.state()["segments"]) == 1 and rows_of(target.read()) == sorted(expected)
    result = target.load(spark.range(5, 6).selectExpr("id", "'newer' as v"), "incremental", "id")
    assert result.rows_rewritten < 8000


def test_a_segment_that_loses_all_files_is_gone(spark, target):
    target.load(spark.range(0, 40, 1, 4).selectExpr("id", "1 as v"), version="a")
    result = target.load(spark.range(40).selectExpr("id", "2 as v"), "incremental", "id", version="b")
    assert result.rows_rewritten == 0
    assert [s["version"] for s in target.state()["segments"]] == ["b"]
    assert rows_of(target.read()) == [(i, 2) for i in range(40)]


def test_vacuum_removes_files_that_upserts_replaced(spark, target):
    target.load(spark.range(0, 400, 1, 4).selectExpr("id", "0 as v"))
    segment = target.state()["segments"][0]["name"]
    for i in range(3):
        target.load(spark.range(i * 100, i * 100 + 1).selectExpr("id", "1 as v"), "incremental", "id")
    rows = rows_of(target.read())
    files = lambda: [n for n in storage.names(spark, f"{target.path}/{segment}") if n.startswith("part-")]
    target.vacuum(keep=4)
    assert len(files()) == 4
    target.vacuum(keep=1)
    assert len(files()) == 1 and rows_of(target.read()) == rows


# -- one entry, whole or not at all ------------------------------------------------------------


def half_written(spark, target, number):
    """What a writer leaves that dies while Spark writes its entry as a folder."""
    context = spark._jvm.org.apache.hadoop.fs.Path(f"{target.path}/_manifest/{number:012d}/_temporary/0")
    context.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(context)


def test_a_half_written_entry_is_passed_over(spark, target, frame):
    rows = [(i,) for i in range(12)]
    target.load(frame("id int", *rows[:5]))
    half_written(spark, target, 1)
    assert target.exists() and rows_of(target.read()) == rows[:5]
    assert target.load(frame("id int", *rows[5:]), "incremental").rows_loaded == 7
    assert rows_of(target.read()) == rows
    half_written(spark, target, 7)
    assert rows_of(target.read()) == rows
    target.compact()
    target.vacuum(keep=1)
    assert rows_of(target.read()) == rows
    assert len(storage.names(spark, f"{target.path}/_manifest")) == 1


def test_a_half_written_first_entry(spark, target, frame):
    half_written(spark, target, 0)
    assert not target.exists()
    target.load(frame("id int", (1,)), "incremental")
    assert rows_of(target.read()) == [(1,)]


def test_a_hidden_entry_is_none(spark, target, frame):
    """A writer that dies between writing an entry and revealing it."""
    target.load(frame("id int", (1,)))
    assert storage.put_once(spark, f"{target.path}/_manifest/.{1:012d}.dead", "{ half of an ent")
    assert rows_of(target.read()) == [(1,)]
    target.load(frame("id int", (2,)), "incremental")
    target.vacuum(keep=1)
    assert rows_of(target.read()) == [(1,), (2,)]
    assert storage.names(spark, f"{target.path}/_manifest") == [f"{1:012d}"]


def test_entries_that_spark_wrote_as_folders_are_read(spark, target, frame):
    target.load(frame("id int", (1,)))
    entry = f"{target.path}/_manifest/{0:012d}"
    old = spark.read.text(entry).first()[0].replace(', "without": []', "")
    storage.delete(spark, entry)
    spark.createDataFrame([(old,)], "value string").coalesce(1).write.text(entry)
    assert rows_of(target.read()) == [(1,)]
    target.load(frame("id int", (1,), (2,)), "incremental", "id")
    assert rows_of(target.read()) == [(1,), (2,)]


def test_of_two_writers_one_fails(target, frame, spark, monkeypatch):
    """The second reads the table, then the first publishes."""
    target.load(frame("id int, v string", (1, "a")))
    other = Table(spark, target.path)
    write, waiting = Table._write, [True]

    def late(self, df, name):
        write(self, df, name)
        if self is other and waiting.pop():
            target.load(frame("id int, v string", (2, "first")), "incremental", "id")

    monkeypatch.setattr(Table, "_write", late)
    with pytest.raises(Conflict):
        other.load(frame("id int, v string", (1, "second")), "incremental", "id")
    assert rows_of(target.read()) == [(1, "a"), (2, "first")]
    monkeypatch.undo()
    other.load(frame("id int, v string", (1, "second")), "incremental", "id")
    assert rows_of(target.read()) == [(1, "second"), (2, "first")]


@pytest.mark.parametrize("way", ["link", "rename"])
def test_a_name_is_given_once(spark, folder, monkeypatch, way):
    from concurrent.futures import ThreadPoolExecutor

    if way == "rename":  # as on a file system without links
        monkeypatch.setattr(storage, "_linked", lambda files, hidden, found: storage._renamed(spark, hidden, found))
    path = folder()
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: storage.put_once(spark, f"{path}/entry", str(i)), range(8 if way == "link" else 1)))
    assert sum(won) == 1
    assert not storage.put_once(spark, f"{path}/entry", "late")
    assert spark.read.text(f"{path}/entry").first()[0] == str(won.index(True))
    assert storage.names(spark, path) == ["entry"] or way == "rename"


def test_a_failed_load_changes_nothing(target, frame, spark):
    target.load(frame("id int", (1,)))
    bad = spark.range(3).selectExpr("cast(raise_error('boom') as int) as id")
    with pytest.raises(Exception, match="boom"):
        target.load(bad, "incremental", "id")
    with pytest.raises(Exception, match="boom"):
        target.load(bad, "full")
    assert rows_of(target.read()) == [(1,)]


def test_a_repeated_load_is_applied_once(target, frame):
    target.load(frame("id int, v int", (1, 1)), version="a")
    for _ in range(2):
        target.load(frame("id int, v int", (1, 2), (2, 2)), "incremental", version="b")
    assert rows_of(target.read()) == [(1, 1), (1, 2), (2, 2)]
    for _ in range(2):
        target.load(frame("id int, v int", (1, 3)), "incremental", "id", version="c")
    assert rows_of(target.read()) == [(1, 3), (2, 2)]


@pytest.mark.parametrize("key", [None, "id"])
def test_an_older_load_again_takes_its_own_place(target, frame, key):
    first = frame("id int, v string", (1, "a"), (2, "a"), (None, "a"), (None, "a"), (5, "a"))
    second = frame("id int, v string", (11, "b"), (12, "b"), (13, "b"), (14, "b"), (15, "b"), (None, "b"), (17, "b"))
    for rows, version in ((first, "r1"), (second, "r2"), (first, "r1"), (second, "r2"), (first, "r1")):
        target.load(rows, "incremental", key, version)
    assert rows_of(target.read()) == rows_of(first.union(second))


def test_rewritten_segments_stay_their_versions(target, frame):
    target.load(frame("id int, v string", (1, "a"), (2, "a"), (3, "a")), "incremental", "id", "r1")
    target.load(frame("id int, v string", (3, "b"), (4, "b")), "incremental", "id", "r2")
    assert rows_of(target.read()) == [(1, "a"), (2, "a"), (3, "b"), (4, "b")]
    target.load(frame("id int, v string", (9, "a")), "incremental", "id", "r1")
    assert rows_of(target.read()) == [(3, "b"), (4, "b"), (9, "a")]


def test_a_retry_does_not_disturb_readers(target, frame):
    target.load(frame("id int", (1,), (2,)), version="a")
    before = target.read()
    target.load(frame("id int", (1,), (2,), (3,)), version="a")
    target.load(frame("id int", (2,)), "incremental", "id", version="b")
    assert rows_of(before) == [(1,), (2,)]


def test_compact_and_vacuum(target, frame, spark):
    for i in range(5):
        target.load(frame("id int", (i,), (i + 1,)), "incremental", "id", version=str(i))
    rows = rows_of(target.read())
    target.compact()
    assert len(target.state()["segments"]) == 1 and rows_of(target.read()) == rows
    target.vacuum(keep=1)
    assert storage.names(spark, f"{target.path}/_manifest") == [f"{5:012d}"]
    assert len(storage.names(spark, f"{target.path}/segments")) == 1 and rows_of(target.read()) == rows
    target.load(frame("id int", (9,)), "incremental")
    assert len(rows_of(target.read())) == len(rows) + 1


def test_empty_loads(target, frame):
    assert target.load(frame("id int")).rows_loaded == 0
    assert target.read().count() == 0
    target.load(frame("id int", (1,)), "incremental", "id")
    target.load(frame("id int"), "incremental", "id")
    assert rows_of(target.read()) == [(1,)]


def test_unknown_strategy_and_unloaded_table(target, frame):
    with pytest.raises(ValueError):
        target.load(frame("id int"), "sideways")
    assert not target.exists()
    with pytest.raises(FileNotFoundError):
        target.read()


def test_quarantine(spark, frame, folder):
    root = folder()
    rows = frame("id int, _violations array<string>", (1, ["a", "b"]), (2, ["b"]))
    assert quarantine.quarantine_rows(rows, root, "p", "s", "r1", AT) == 2
    assert quarantine.quarantine_rows(rows, root, "p", "s", "r1", AT) == 2
    assert quarantine.quarantine_rows(rows.where("id = 1"), root, "p", "t", "r2", AT, "test") == 1
    assert rows_of(quarantine.quarantine_summary(spark, root)) == [
        ("p", "s", "r1", 2), ("p", "t", "r2", 1)]
    stored = quarantine.quarantine_sample(spark, root, "p", "s", "r1", limit=1, order_by=("id",))
    assert rows_of(stored, "id", "_quarantine_reason") == [(1, "a,b")]
    other = quarantine.quarantine_sample(spark, root, "p", "t", "r2")
    assert rows_of(other, "id", "_quarantine_reason") == [(1, "test")]
    assert other.selectExpr("unix_timestamp(_quarantined_at)").first()[0] == int(AT.timestamp())


def test_empty_quarantine_writes_nothing(spark, frame, folder):
    root = folder()
    assert quarantine.quarantine_rows(frame("id int"), root, "p", "s", "r", AT) == 0
    assert quarantine.quarantine_summary(spark, root).count() == 0
    assert quarantine.quarantine_summary(spark, folder()).count() == 0
