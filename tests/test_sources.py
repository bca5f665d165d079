"""Sources: formats, missing values, nested records, page cut-off, incremental reads."""

import json

import pandas as pd
import pytest
from conftest import rows_of

from lakesieve import Source, extract, register_source
from lakesieve.session import ROW
from lakesieve.sources import READERS, api_pages, extract_rows, files
from lakesieve.sources.files import infer_types, read_csv, read_json
from lakesieve.sources.jdbc import jdbc_url, reader_options


@pytest.fixture
def write(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text) if isinstance(text, bytes) else path.write_text(text)
        return str(path)

    return put


def test_csv_types_and_missing_values(spark, write):
    path = write("a.csv", "id;name;price;ok;day;none\n1;NA;1.5;True;2024-01-01;\n2;x;n/a;false;;\n"
                          '3;"a ""quoted"";b";3;True;2024-01-03;NULL\n')
    df = read_csv(spark, path, delimiter=";")
    assert dict(df.dtypes) == {"id": "bigint", "name": "string", "price": "double",
                               "ok": "boolean", "day": "string", "none": "double"}
    assert rows_of(df, "id", "name", "price", "ok") == [
        (1, None, 1.5, True), (2, "x", None, False), (3, 'a "quoted";b', 3.0, True)]


def test_csv_declared_schema_is_tolerant(spark, write):
    path = write("a.csv", "id,price\n1,2\nx,y\n2.5,1e3\n")
    df = read_csv(spark, path, schema="id bigint, price double")
    assert rows_of(df) == [(None, None), (1, 2.0), (2, 1000.0)]


def test_csv_agrees_with_pandas(spark, write):
    text = "a,b,c,d\n1,1.0,x,007\n,2,NaN,8\n3,inf,None,9\n"
    path = write("p.csv", text)
    expected = pd.read_csv(path)
    got = read_csv(spark, path).toPandas().sort_values("d").reset_index(drop=True)
    for name in "abcd":
        assert got[name].isna().tolist() == expected[name].isna().tolist(), name
    assert got["d"].tolist() == expected["d"].tolist()
    assert got["b"].tolist() == expected["b"].tolist()


def test_glob_of_equal_files_and_missing_files(spark, write, tmp_path):
    write("g/a.csv", "id\n1\n")
    write("g/b.csv", "id\n2\n")
    source = Source("g", "csv", {"path": str(tmp_path / "g" / "*.csv")})
    assert rows_of(extract(spark, source)) == [(1,), (2,)]
    for union in (False, True):
        with pytest.raises((FileNotFoundError, Exception), match="No files|PATH_NOT_FOUND"):
            read_csv(spark, str(tmp_path / "absent*.csv"), union_columns=union)


def test_glob_of_different_headers(spark, write, tmp_path):
    write("u/a.csv", "id,x\n1,a\n")
    write("u/b.csv", "y,id\n2.5,2\n")
    df = read_csv(spark, str(tmp_path / "u" / "*.csv"), union_columns=True)
    assert sorted(df.columns) == ["id", "x", "y"]
    assert rows_of(df, "id", "x", "y") == [(1, "a", None), (2, None, 2.5)]


def test_rows_keep_their_file_order(spark, write, tmp_path):
    for name in "cab":
        write(f"o/{name}.csv", "v\n" + "".join(f"{name}{i}\n" for i in range(3)))
    rows, plain = extract_rows(spark, Source("o", "csv", {"path": str(tmp_path / "o" / "*.csv")}))
    assert plain.columns == ["v"]
    ordered = [r["v"] for r in rows.orderBy(ROW).collect()]
    assert ordered == [f"{n}{i}" for n in "abc" for i in range(3)]


def test_json_array_lines_and_nested(spark, write):
    rows = [{"id": 1, "a": {"b": 2, "c": {"d": "x"}}, "l": [1, 2]}, {"id": 2, "a": {"b": 3}}]
    array = read_json(spark, write("a.json", json.dumps(rows)))
    assert rows_of(array, "id") == [(1,), (2,)]
    lines = write("l.json", "\n".join(json.dumps(r) for r in rows))
    assert read_json(spark, lines, read_options={"lines": True}).count() == 2
    nested = write("n.json", json.dumps({"result": {"items": rows}, "meta": {"count": 2}}, indent=1))
    flat = read_json(spark, nested, records_path="result.items")
    assert sorted(flat.columns) == ["a.b", "a.c.d", "id", "l"]
    assert rows_of(flat, "id", "`a.b`", "`a.c.d`", "l") == [(1, 2, "x", [1, 2]), (2, 3, None, None)]
    with pytest.raises(KeyError):
        read_json(spark, nested, records_path="result.absent")
    source = Source("n", "json", {"path": nested, "records_path": "result.items"})
    ordered, _ = extract_rows(spark, source)
    assert [r["id"] for r in ordered.orderBy(ROW).collect()] == [1, 2]


def test_one_document_without_records_is_an_error(spark, write, tmp_path):
    write("d/a.json", '{"data": [{"id": 1}]}')
    write("d/b.json", '{"other": 1}')
    with pytest.raises(Exception, match="No records"):
        read_json(spark, str(tmp_path / "d"), records_path="data").collect()


def test_small_documents_are_looked_at_by_many_tasks(spark, write, tmp_path):
    for i in range(12):
        record = {"id": i, "v": i if i % 2 else i + 0.5, **({"late": {"x": "y"}} if i == 11 else {})}
        write(f"many/{i}.json", json.dumps({"data": [record]}))
    path, context = str(tmp_path / "many"), spark.sparkContext
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    context.setJobGroup("documents", "documents")
    try:
        df = read_json(spark, path, records_path="data")
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("documents") for s in tracker.getJobInfo(j).stageIds]
        assert max(tracker.getStageInfo(s).numTasks for s in stages) == 12
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert dict(df.dtypes) == {"id": "bigint", "v": "double", "late.x": "string"}
    whole = write("utf16.json", json.dumps([{"id": 1, "v": "ä"}], indent=1, ensure_ascii=False).encode("utf-16"))
    assert rows_of(read_json(spark, whole, encoding="utf-16"), "id", "v") == [(1, "ä")]
    assert rows_of(df, "id", "v", "`late.x`")[10:] == [(10, 10.5, None), (11, 11.0, "y")]


def test_documents_too_large_for_a_text_are_left_to_the_reader(spark, write, monkeypatch):
    path = write("large.json", json.dumps([{"id": 1}, {"id": 2, "a": "x"}]))
    whole = read_json(spark, path)
    monkeypatch.setattr(files, "WHOLE_BYTES", 10)
    assert files.documents_schema(spark, [path], "utf-8", {}) is None
    assert rows_of(read_json(spark, path), "id", "a") == rows_of(whole, "id", "a") == [(1, None), (2, "x")]


def test_incremental_file_is_strict(spark, write):
    path = write("i.csv", "id,ts\n1,2024-01-01\n2,2024-06-01\n3,2024-03-01\n4,\n")
    source = Source("i", "csv", {"path": path, "incremental_key": "ts"})
    assert rows_of(extract(spark, source, since="2024-03-01"), "id") == [(2,)]
    absent = Source("i", "csv", {"path": path, "incremental_key": "zzz"})
    assert extract(spark, absent, since="2024-03-01").count() == 4


def test_incremental_filter_reaches_the_parquet_scan(spark, frame, folder):
    path = folder()
    frame("id int, ts string", (1, "2024-01-01"), (2, "2024-06-01")).selectExpr(
        "id", "cast(ts as timestamp_ntz) as ts").write.parquet(path)
    source = Source("p", "parquet", {"path": path, "incremental_key": "ts"})
    df = extract(spark, source, since="2024-03-01")
    assert rows_of(df, "id") == [(2,)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-03-01T00:00)" in plan


def test_unknown_and_registered_source_types(spark):
    with pytest.raises(ValueError, match="carrier_pigeon"):
        extract(spark, Source("x", "carrier_pigeon"))
    register_source("numbers", lambda s, options, since: s.range(options["n"]))
    try:
        assert extract(spark, Source("x", "numbers", {"n": 3})).count() == 3
        rows, plain = extract_rows(spark, Source("x", "numbers", {"n": 3}))
        assert (rows.columns, plain.columns) == (["id", ROW], ["id"])
    finally:
        del READERS["numbers"]


# -- databases: the options handed to Spark's reader ----------------------------------------


def test_jdbc_options():
    connection = {"host": "h", "port": 5432, "database": "d", "user": "u", "password": "p"}
    options = reader_options("postgresql", {"connection": connection, "table": "t"})
    assert options["url"] == "jdbc:postgresql://h:5432/d"
    assert (options["user"], options["password"], options["dbtable"]) == ("u", "p", "t")
    assert jdbc_url("mysql", {"database": "d"}) == "jdbc:mysql://localhost:3306/d"
    assert jdbc_url("mysql", "mysql://h/d") == "jdbc:mysql://h/d"
    query = reader_options("mysql", {"connection": "jdbc:mysql://h/d", "query": "SELECT 1"})
    assert query["query"] == "SELECT 1" and "dbtable" not in query
    parallel = reader_options("mysql", {
        "connection": "jdbc:mysql://h/d", "query": "SELECT * FROM t", "partition_column": "id",
        "lower_bound": 0, "upper_bound": 100, "num_partitions": 8})
    assert parallel["dbtable"] == "(SELECT * FROM t) AS sub"
    assert parallel["partitionColumn"] == "id" and parallel["numPartitions"] == "8"
    with pytest.raises(ValueError):
        reader_options("mysql", {"table": "t"})
    with pytest.raises(ValueError):
        reader_options("mysql", {"connection": "jdbc:mysql://h/d"})


# -- landed API pages -----------------------------------------------------------------------


@pytest.fixture
def pages(frame):
    def build(*bodies, first=1):
        rows = [(i, json.dumps(b) if b is not None else None) for i, b in enumerate(bodies, first)]
        return frame("page bigint, body string", *rows)

    return build


def ids(df):
    return [r[0] for r in rows_of(df, "id")]


def test_pages_until_the_first_empty_one(pages):
    df = pages({"data": [{"id": 1}, {"id": 2}]}, {"data": [{"id": 3}, {"id": 4}]}, {"data": []},
               {"data": [{"id": 9}]})
    kept = api_pages.cut_pages(df, {"type": "page"}, "data")
    assert kept.count() == 3
    assert ids(api_pages.pages_to_records(kept, "data")) == [1, 2, 3, 4]
    assert api_pages.cut_pages(df, {"type": "none"}, "data").count() == 1
    assert api_pages.cut_pages(df, {"type": "page"}, "data", max_pages=2).count() == 2


def test_offset_stops_after_a_short_page(pages):
    df = pages([{"id": 1}, {"id": 2}], [{"id": 3}], [{"id": 4}, {"id": 5}])
    kept = api_pages.cut_pages(df, {"type": "offset", "page_size": 2})
    assert ids(api_pages.pages_to_records(kept)) == [1, 2, 3]


@pytest.mark.parametrize("end", [None, "", 0, False, {}])
def test_cursor_stops_without_a_next_one(pages, end):
    df = pages({"d": [{"id": 1}], "meta": {"next": "x"}}, {"d": [{"id": 2}], "meta": {"next": end}},
               {"d": [{"id": 3}], "meta": {"next": "y"}})
    how = {"type": "cursor", "next_cursor_path": "meta.next"}
    assert ids(api_pages.pages_to_records(api_pages.cut_pages(df, how, "d"), "d")) == [1, 2]


def test_feeds_stop_by_themselves(frame):
    rows = [("a", 1, "[1]"), ("a", 2, "[]"), ("a", 3, "[1]"), ("b", 5, "[1]"), ("b", 6, "[1]")]
    df = frame("feed string, page bigint, body string", *rows)
    kept = api_pages.cut_pages(df, {"type": "page"}, feed="feed")
    assert rows_of(kept, "feed", "page") == [("a", 1), ("a", 2), ("b", 5), ("b", 6)]


def test_records_of_any_shape(pages):
    df = pages({"data": {"id": 1, "a": {"b": 2.5}}}, {"data": [{"id": 2, "t": "x"}]}, {"data": None},
               {"other": 1}, {"data": {}}, [1])
    out = api_pages.pages_to_records(df, "data")
    assert rows_of(out, "id", "`a.b`", "t") == [(1, 2.5, None), (2, None, "x")]
    deep = pages({"result": {"items": [{"id": 1}, {"id": 2}]}}, {"result": [{"items": [{"id": 3}]}]})
    assert ids(api_pages.pages_to_records(deep, "result.items")) == [1, 2]
    declared = api_pages.pages_to_records(df, "data", layout="STRUCT<id: STRING>")
    assert ids(declared) == ["1", "2"]


def test_landed_pages_as_a_source(spark, pages, folder):
    path = folder()
    pages({"data": [{"id": 1, "at": "2024-01-01"}, {"id": 2, "at": "2024-02-01"}]}, {"data": []}
          ).write.parquet(path)
    options = {"path": path, "records_path": "data", "pagination": {"type": "page"},
               "incremental_key": "at"}
    source = Source("api", "api_pages", options)
    assert ids(extract(spark, source)) == [1, 2]
    assert ids(extract(spark, source, since="2024-01-15")) == [2]
