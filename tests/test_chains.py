"""Links followed in rounds, and the pages and stages that lie on them."""

import json
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from lakesieve import Source, Stage, run_pipeline
from lakesieve.operators.chains import downstream, follow
from lakesieve.plans import history, monitor
from lakesieve.plans.stage import Places
from lakesieve.sources import api_pages, extract, landed_pages


@pytest.mark.parametrize("length", [1, 3, 70])
def test_follow_knows_every_position(spark, length):
    rng = random.Random(length)
    names = {of: rng.sample(range(10_000), length) for of in "ab"}
    links = [(of, a, b) for of, way in names.items() for a, b in zip(way, way[1:])]
    links += [("b", 20_000 + i, names["b"][0]) for i in range(5)] + [("c", 1, 2)]
    starts = spark.createDataFrame([(of, way[0]) for of, way in names.items()], "of string, n long")
    found = follow(spark.createDataFrame(links, "of string, n long, t long"), starts, ["of"], "n", "t", length + 6)
    assert rows_of(found, "of", "position", "n") == [(of, i, n) for of in "ab" for i, n in enumerate(names[of])]


def test_follow_ends_in_a_circle(spark):
    links = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("a", 3, 2), ("a", 9, None)], "of string, n long, t long")
    starts = spark.createDataFrame([("a", 1)], "of string, n long")
    assert {r.n for r in follow(links, starts, ["of"], "n", "t", 4).collect()} == {1, 2, 3}


def test_downstream_takes_the_shortest_way_and_ends_in_circles(spark):
    edges = [("a", 1, 2), ("a", 2, 3), ("a", 1, 3), ("a", 3, 4), ("a", 4, 2), ("a", 7, 8), ("b", 1, 5)]
    df = spark.createDataFrame(edges, "of string, early long, late long")
    starts = spark.createDataFrame([("a", 1), ("a", 1), ("c", 1)], "of string, late long")
    assert rows_of(downstream(df, starts, ["of"], "late", "early")) == [("a", 1, 0), ("a", 2, 1), ("a", 3, 1), ("a", 4, 2), ("c", 1, 0)]


# -- pages linked by cursors ------------------------------------------------------------------

HOW = {"type": "cursor", "next_cursor_path": "meta.next", "cursor_column": "asked"}


def page(number, asked, next_, records=1, feed="f"):
    return (feed, number, asked, json.dumps({"data": [{"id": number}] * records, "meta": {"next": next_}}))


def walked(frame, *rows, **named):
    df = frame("feed string, page bigint, asked string, body string", *rows)
    return rows_of(api_pages.cut_pages(df, HOW, "data", feed="feed", **named), "feed", "page")


def test_cursors_and_not_numbers_order_the_pages(frame):
    rows = [page(5, None, "x"), page(1, "x", "y"), page(9, "y", "z"), page(3, "z", None), page(2, "lost", "x")]
    assert walked(frame, *rows) == [("f", 1), ("f", 3), ("f", 5), ("f", 9)]
    assert walked(frame, *rows, max_pages=2) == [("f", 1), ("f", 5)]
    assert walked(frame, *rows[1:]) == []


def test_a_walk_ends_at_an_empty_page_a_missing_one_and_a_circle(frame):
    assert walked(frame, page(1, None, "x"), page(2, "x", "y", records=0), page(3, "y", None)) == [("f", 1), ("f", 2)]
    assert walked(frame, page(1, None, "x"), page(2, "gone", "y")) == [("f", 1)]
    assert walked(frame, page(1, None, "x"), page(2, "x", "y"), page(3, "y", "x"), page(4, "z", None)) == [("f", 1), ("f", 2), ("f", 3)]


def test_every_feed_is_walked_by_itself_and_repeated_answers_count_once(frame):
    rows = [page(1, None, 7), page(2, "7", None), page(3, "7", "8"), page(4, "8", None),
            page(1, None, "8", feed=None), page(2, "8", "7", feed=None), page(5, "9", None, feed="g")]
    assert walked(frame, *rows) == [(None, 1), (None, 2), ("f", 1), ("f", 2)]


def test_a_long_walk(spark):
    n = 700
    df = spark.range(n).selectExpr(
        "crc32(cast(id as string)) as page", "if(id = 0, null, md5(cast(id as string))) as asked",
        "to_json(struct(array(id) as data, struct(md5(cast(id + 1 as string)) as next) as meta)) as body")
    df = df.union(df.limit(0))
    assert api_pages.cut_pages(df, HOW, "data").count() == n


# -- landed pages as a data source ------------------------------------------------------------


def land(path, feed, number, body, parts=1):
    import os

    folder = landed_pages.page_folder(path, feed, number)
    os.makedirs(folder)
    cut = len(body) // parts + 1
    for i in range(parts):
        with open(f"{folder}/part-{i}.json", "w") as file:
            file.write(body[i * cut : (i + 1) * cut])
    open(f"{folder}/_SUCCESS", "w").close()


def test_pages_are_read_in_parallel(spark, folder):
    landed_pages.register(spark)
    path = folder()
    for number in range(1, 8):
        land(path, "a b/c", number, json.dumps({"data": [{"id": number}]}), parts=1 + number % 2)
    land(path, "d", -3, "é")
    df = spark.read.format("landed_pages").option("partitionBytes", 40).load(path)
    assert df.rdd.getNumPartitions() > 3
    assert rows_of(df) == [("a b/c", n, json.dumps({"data": [{"id": n}]})) for n in range(1, 8)] + [("d", -3, "é")]
    options = {"path": f"file://{path}", "layout_of": "folders", "records_path": "data", "feed": "feed"}
    assert rows_of(extract(spark, Source("p", "api_pages", options)).where("id is not null"), "id") == [(n,) for n in range(1, 8)]


def test_nothing_landed(spark, folder):
    landed_pages.register(spark)
    assert spark.read.format("landed_pages").load(folder()).count() == 0
    with pytest.raises(Exception, match="needs a path"):
        spark.read.format("landed_pages").load().count()


def test_a_stream_goes_on_where_it_was(spark, folder):
    landed_pages.register(spark)
    path, out, checkpoint = folder(), folder(), folder()
    batches = []

    def run():
        def keep(batch, number):
            batches.append(rows_of(batch, "feed", "page"))
            batch.write.mode("append").parquet(out)

        stream = spark.readStream.format("landed_pages").load(path)
        query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(once=True).start()
        query.awaitTermination()

    land(path, "a", 1, "one")
    land(path, "a", 2, "two")
    run()
    land(path, "a", 3, "three")
    land(path, "b", 1, "other")
    run()
    run()
    assert [b for b in batches if b] == [[("a", 1), ("a", 2)], [("a", 3), ("b", 1)]]
    assert rows_of(spark.read.parquet(out), "body") == [("one",), ("other",), ("three",), ("two",)]


# -- stages that failures reach ---------------------------------------------------------------


def test_failure_reach_agrees_with_the_runner(spark, frame, folder):
    base = folder()
    places = Places(f"{base}/w", f"{base}/q", f"{base}/h")
    good, bad = frame("id int", (1,)), spark.range(2).select(F.raise_error(F.lit("boom")).cast("int").alias("id"))
    stages = [Stage("a", good), Stage("b", bad, depends_on=["a"]), Stage("c", good, depends_on=["b"]), Stage("d", good, depends_on=["c", "a"]),
              Stage("e", good, depends_on=["a"]), Stage("f", good, depends_on=["d", "b"])]
    result = run_pipeline(spark, "p", stages, places, run_id="r")
    log = history.History(spark, places.history)
    reached = monitor.failure_reach(log.table("stage_runs"), log.table("stage_dependencies"))
    assert rows_of(reached, "stage_name", "distance") == [("c", 1), ("d", 2), ("f", 1)]
    assert [s.name for s in result.stages if s.status == "skipped"] == ["c", "d", "f"]
