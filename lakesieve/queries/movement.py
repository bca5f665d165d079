"""Sources, loads and streaming ingest: tables written in a format and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import RuleSet
from ..plans.stage import Stage, run_pipeline
from ..session import fresh_path, small_frame
from ..sinks.tables import Table
from ..sources import Source, api_pages, extract
from ..sources.files import read_csv, read_json, watermark_row
from ..streaming.ingest import ingest_files
from .base import query, table
from .quality import fresh_places
from .transforms import step


@query("""
    select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal,
      case when c_custkey % 7 = 0 then null else c_mktsegment end as c_mktsegment
    from customer
""")
def src_csv(spark, sf):
    path = fresh_path(spark, "csv")
    customers = table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.expr("case when c_custkey % 7 = 0 then 'N/A' else c_mktsegment end")
    )
    customers.write.csv(path, header=True, sep="|")
    return read_csv(spark, path, delimiter="|")


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def src_json_records(spark, sf):
    path = fresh_path(spark, "json")
    orders = table(spark, sf, "orders").drop("o_orderdate")
    orders.write.json(path)
    return read_json(spark, path, read_options={"lines": True})


@query("""
    select c_custkey, c_acctbal as "account.balance", c_mktsegment as "account.segment",
      cast(c_nationkey as bigint) as "account.home.nation"
    from customer
""")
def src_json_nested(spark, sf):
    """Documents of at most 200 customers, one per file, records under ``result.items``."""
    path = fresh_path(spark, "nested")
    customers = table(spark, sf, "customer").selectExpr(
        "floor(c_custkey / 200) as chunk",
        "struct(c_custkey, struct(c_acctbal as balance, c_mktsegment as segment, "
        "struct(c_nationkey as nation) as home) as account) as item",
    )
    # A number that is asked for is kept: by their few bytes, all documents would be one task's files.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    items = customers.repartition(tasks, "chunk").groupBy("chunk").agg(F.collect_list("item").alias("items"))
    document = F.to_json(F.struct(F.struct("items").alias("result")))
    items.select("chunk", document.alias("value")).write.partitionBy("chunk").text(path)
    return read_json(spark, f"{path}/*", records_path="result.items")


@query("""
    select c_custkey, c_name, null::double as c_acctbal from customer where c_custkey % 2 = 0
    union all select c_custkey, null, c_acctbal from customer where c_custkey % 2 = 1
""")
def src_glob_union(spark, sf):
    path = fresh_path(spark, "glob")
    customers = table(spark, sf, "customer")
    even, odd = F.col("c_custkey") % 2 == 0, F.col("c_custkey") % 2 == 1
    customers.where(even).select("c_custkey", "c_name").write.csv(f"{path}/a", header=True)
    customers.where(odd).select("c_custkey", "c_acctbal").write.csv(f"{path}/b", header=True)
    return read_csv(spark, f"{path}/*/*.csv", union_columns=True)


@query("""
    select o_orderkey, o_totalprice from orders where o_orderdate > timestamp '1997-06-30 00:00:00'
""")
def src_incremental(spark, sf):
    options = {"path": f"{sf}/orders.parquet", "incremental_key": "o_orderdate"}
    newer = extract(spark, Source("orders", "parquet", options), since="1997-06-30")
    return newer.select("o_orderkey", "o_totalprice")


@query("select epoch_us(max(o_orderdate)) as watermark_us from orders")
def watermark_max(spark, sf):
    newest = watermark_row(table(spark, sf, "orders"), "o_orderdate")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), "watermark")
    return newest.select(micros.alias("watermark_us"))


# -- landed API pages -----------------------------------------------------------------------


def event_pages(events: DataFrame, page: str, feed: str = "'all'", keep: str = "true") -> DataFrame:
    """Events packed into response bodies; rows failing ``keep`` leave their page short."""
    record = F.expr(f"case when {keep} then struct(event_id, user_id, value, "
                    "struct(event_type as kind) as info) end")
    grouped = events.groupBy(F.expr(feed).alias("feed"), F.expr(page).alias("page")).agg(
        F.array_sort(F.collect_list(record)).alias("data")
    )
    cursor = F.struct((F.col("page") + 1).cast("string").alias("next"))
    return grouped.select(
        "feed", "page", F.to_json(F.struct("data", cursor.alias("meta"))).alias("body")
    )


@query("""
    select event_id, event_type as "info.kind", user_id, value from events
""")
def api_pages_to_records(spark, sf):
    pages = event_pages(table(spark, sf, "events"), "floor(event_id / 100) + 1")
    fetched = api_pages.cut_pages(
        pages, {"type": "page"}, "data", max_pages=None
    )
    return api_pages.pages_to_records(fetched, "data")


@query("""
    with pages as (
      select event_type as feed, event_id // 500 + 1 as page,
        count(*) filter (where (event_id // 500 * 7 + length(event_type)) % 23 <> 0) as n
      from events group by all),
    stops as (select feed, min(page) filter (where n = 0) as stop
      from pages group by feed)
    select feed, page from pages join stops using (feed)
    where stop is null or page <= stop
""")
def api_page_cutoff(spark, sf):
    keep = "(floor(event_id / 500) * 7 + length(event_type)) % 23 <> 0"
    pages = event_pages(
        table(spark, sf, "events"), "floor(event_id / 500) + 1", "event_type", keep
    )
    return api_pages.cut_pages(pages, {"type": "page"}, "data", feed="feed").select("feed", "page")


#: Pages of 200 events a feed, asked for with cursors that tell nothing of their order.
CURSOR_PAGES = """
    select *, case when page = 1 then null else md5(feed || ':' || page) end as asked, md5(feed || ':' || (page + 1)) as next,
      event_count > 0 and (page * 31 + length(feed)) % 29 <> 0 as goes_on
    from (select event_type as feed, event_id // 200 + 1 as page, count(*) as event_count from events group by all)
"""


@query(f"""
    with recursive pages as ({CURSOR_PAGES}),
    walk as (
      select feed, page, next, goes_on from pages where asked is null
      union all select p.feed, p.page, p.next, p.goes_on from walk w join pages p on p.feed = w.feed and p.asked = w.next where w.goes_on)
    select feed, page from walk
""")
def api_page_cursors(spark, sf):
    """The pages on the way of the cursors, numbered by a hash; on some pages no cursor follows."""
    events = table(spark, sf, "events")
    grouped = events.groupBy(F.col("event_type").alias("feed"), F.expr("cast(floor(event_id / 200) + 1 as bigint) as page")).agg(
        F.array_sort(F.collect_list("event_id")).alias("data"))
    cursor = lambda n: F.md5(F.concat_ws(":", "feed", n).cast("binary"))
    goes_on = (F.col("page") * 31 + F.length("feed")) % 29 != 0
    pages = grouped.select(
        "feed", "page", F.when(F.col("page") > 1, cursor(F.col("page"))).alias("asked"), F.crc32(cursor(F.col("page"))).alias("landed"),
        F.to_json(F.struct("data", F.struct(F.when(goes_on, cursor(F.col("page") + 1)).alias("next")).alias("meta"))).alias("body"),
    )
    how = {"type": "cursor", "next_cursor_path": "meta.next", "cursor_column": "asked"}
    return api_pages.cut_pages(pages, how, "data", page="landed", feed="feed").select("feed", "page")


@query("""
    select event_id, event_type as "info.kind", user_id, value from events
""")
def src_landed_pages(spark, sf):
    """Events as one text file a page, read by the data source of landed pages."""
    path = fresh_path(spark, "landed")
    pages = event_pages(table(spark, sf, "events"), "floor(event_id / 500) + 1", "event_type")
    pages.select("feed", "page", F.col("body").alias("value")).repartition("feed").write.partitionBy("feed", "page").text(path)
    options = {"path": path, "layout_of": "folders", "records_path": "data", "pagination": {"type": "page"}, "feed": "feed"}
    return extract(spark, Source("events", "api_pages", options))


# -- loads ----------------------------------------------------------------------------------

KEYED = "case when o_orderkey % 17 = 0 then null else o_orderkey end as k"
OLD = f"select {KEYED}, o_custkey, o_totalprice from orders where o_orderdate < timestamp '1997-01-01'"
NEW = f"""
    select {KEYED}, o_custkey, round(o_totalprice * 2, 2) as o_totalprice from orders
    where o_orderdate >= timestamp '1996-01-01'
"""


def _orders(spark, sf, sql: str) -> DataFrame:
    return spark.sql(sql.replace("from orders", "from {orders}"), orders=table(spark, sf, "orders"))


def _loaded(spark, sf, *loads: tuple[str, str, str | None]) -> Table:
    target = Table(spark, fresh_path(spark, "table"))
    for sql, strategy, key in loads:
        target.load(_orders(spark, sf, sql), strategy, key)
    return target


@query(NEW)
def load_full(spark, sf):
    return _loaded(spark, sf, (OLD, "full", None), (NEW, "full", None)).read()


@query(f"""
    with old as ({OLD}), new as ({NEW})
    select * from old where k is null or k not in (select k from new where k is not null)
    union all select * from new
""")
def load_upsert(spark, sf):
    return _loaded(spark, sf, (OLD, "full", None), (NEW, "incremental", "k")).read()


@query(f"{OLD} union all {NEW}")
def load_append(spark, sf):
    return _loaded(spark, sf, (OLD, "incremental", "k"), (NEW, "incremental", None)).read()


@query(f"""
    select 'full' as strategy, count(*) as rows_loaded from ({OLD})
    union all select 'incremental', count(*) from ({NEW})
""")
def load_counts(spark, sf):
    target = Table(spark, fresh_path(spark, "table"))
    counts = [
        target.load(_orders(spark, sf, OLD), "full"),
        target.load(_orders(spark, sf, NEW), "incremental", "k"),
    ]
    rows = [{"strategy": c.strategy, "rows_loaded": c.rows_loaded} for c in counts]
    return small_frame(spark, rows, "strategy string, rows_loaded bigint")


BEFORE, AFTER = "o_orderdate < timestamp '1996-01-01'", "o_orderdate >= timestamp '1996-01-01'"
#: Overlaps with ``AFTER`` in a year of orders.
LONGER = "o_orderdate < timestamp '1997-01-01'"


def _labelled(part: str, label: str) -> str:
    """All orders of a part of the dates; every ninth has no key."""
    key = "case when o_orderkey % 9 = 0 then null else o_orderkey end as k"
    return f"select {key}, '{label}' as loaded_by from orders where {part}"


@query(f"{_labelled(BEFORE, 'one')} union all {_labelled(AFTER, 'two')}")
def load_two_stages_all(spark, sf):
    """As ``load_two_stages``, with every order in one of the two loads."""
    places = fresh_places(spark)
    stages = [
        Stage(label, _orders(spark, sf, _labelled(part, label)), target_table="t", load_strategy="incremental")
        for label, part in (("one", BEFORE), ("two", AFTER))
    ]
    run_pipeline(spark, "pair", stages, places, run_id="r1")
    return Table(spark, f"{places.warehouse}/t").read()


@query(f"""
    with a as ({_labelled(LONGER, 'first')}), b as ({_labelled(AFTER, 'second')})
    select 'append' as strategy, * from (select * from a union all select * from b)
    union all
    select 'upsert', * from (select * from a union all
      select * from b where k is null or k not in (select k from a where k is not null))
""")
def load_replayed_all(spark, sf):
    """As ``load_replayed``, over every order; a year of them is in both loads."""
    first, second = (_orders(spark, sf, _labelled(*load)) for load in ((LONGER, "first"), (AFTER, "second")))
    results = []
    for strategy, key in (("append", None), ("upsert", "k")):
        target = Table(spark, fresh_path(spark, "table"))
        for rows, version in ((first, "r1"), (second, "r2"), (first, "r1")):
            target.load(rows, "incremental", key, version)
        results.append(target.read().select(F.lit(strategy).alias("strategy"), "k", "loaded_by"))
    return results[0].union(results[1])


@query(f"""
    with a as ({_labelled(LONGER, 'one')}), b as ({_labelled(AFTER, 'two')})
    select * from a where k is null or k not in (select k from b where k is not null)
    union all select * from b
""")
def load_two_stages(spark, sf):
    """Two stages of one run into one table, the second an upsert; a year of orders is in both."""
    places = fresh_places(spark)
    stages = [
        Stage(label, _orders(spark, sf, _labelled(part, label)), target_table="t", load_strategy="incremental", incremental_key=key)
        for label, part, key in (("one", LONGER, None), ("two", AFTER, "k"))
    ]
    run_pipeline(spark, "pair", stages, places, run_id="r1")
    return Table(spark, f"{places.warehouse}/t").read()


@query(f"{_labelled(BEFORE, 'first')} union all {_labelled(AFTER, 'second')}")
def load_replayed(spark, sf):
    """A load whose writer died before its entry was whole, then the same load again."""
    target = Table(spark, fresh_path(spark, "table"))
    first, second = (_orders(spark, sf, _labelled(*load)) for load in ((BEFORE, "first"), (AFTER, "second")))
    target.load(first, "incremental", None, "r1")
    second.write.parquet(f"{target.path}/segments/dead/batch")
    spark.range(0).write.parquet(f"{target.path}/_manifest/{1:012d}/_temporary")
    target.load(second, "incremental", None, "r2")
    return target.read()


@query(f"""
    with a as ({_labelled('true', 'first')}), b as ({_labelled('o_custkey % 100 = 0', 'second')})
    select * from a where k is null or k not in (select k from b where k is not null)
    union all select * from b
""")
def load_upsert_files(spark, sf):
    """All orders in many files by ranges of the key, then the orders of some customers again,
    one after another: only files that hold their keys are rewritten."""
    target = Table(spark, fresh_path(spark, "table"))
    target.load(_orders(spark, sf, _labelled("true", "first")).repartitionByRange(16, "k"))
    target.load(_orders(spark, sf, _labelled("o_custkey % 100 = 0 and o_orderkey % 2 = 0", "second")), "incremental", "k")
    target.load(_orders(spark, sf, _labelled("o_custkey % 100 = 0 and o_orderkey % 2 = 1", "second")), "incremental", "k")
    target.compact()
    target.vacuum(keep=1)
    return target.read()


# -- streaming ------------------------------------------------------------------------------

EVENT_RULES = RuleSet.of("events", [
    {"name": "event_key", "type": "primary_key", "columns": ["event_id"],
     "params": {"primary_key": True}},
    {"name": "value", "type": "range", "columns": ["value"], "params": {"max": 200}},
])


@query("""
    with delivered as (
      select event_id, event_type, value, 0 as delivery from events where event_id % 2 = 0
      union all select event_id, event_type, value, 1 from events where event_id % 2 = 1
      union all select event_id, event_type, value + 1, 1 from events where event_id % 10 = 0),
    last as (select *, row_number() over (partition by event_id order by delivery desc) as rn from delivered)
    select files, event_type, count(*) as n, round(sum(value), 2) as total
    from last, (values (1), (1000)) f(files)
    where rn = 1 and value <= 200 group by files, event_type
""")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries of event files, the second with corrections of the first; the totals of
    the loaded table, whether a micro-batch holds one file or all of them."""
    events = table(spark, sf, "events")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    corrected = events.where("event_id % 10 = 0").withColumn("value", F.col("value") + 1)
    deliveries = [events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1").unionByName(corrected)]
    base = fresh_path(spark, "stream")
    totals = []
    for part in deliveries:
        part.coalesce(2).write.mode("append").parquet(f"{base}/in")
    for files in (1, 1000):
        places = fresh_places(spark)
        stage = Stage("events", events, EVENT_RULES, [step("derive", column="day", expression="to_date(ts)")],
                      load_strategy="incremental", incremental_key="event_id")
        ingest_files(
            spark, f"{base}/in", schema, stage, places, f"{base}/checkpoint-{files}", max_files=files
        ).awaitTermination()
        loaded = Table(spark, f"{places.warehouse}/events").read()
        totals.append(loaded.groupBy(F.lit(files).alias("files"), "event_type").agg(
            F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
        ))
    return totals[0].union(totals[1])


@query("""
    select event_type, count(*) as n, round(sum(value), 2) as total from events group by event_type
""")
def stream_redelivered(spark: SparkSession, sf: str) -> DataFrame:
    """Events appended without a key from two deliveries in two runs, the second of which repeats
    a third of the first, and the first repeats a part of itself; each row is loaded once."""
    events = table(spark, sf, "events")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    first, second = events.where("event_id % 4 <> 0"), events.where("event_id % 4 = 0")
    deliveries = [first.unionByName(first.where("event_id % 5 = 1")), second.unionByName(first.where("event_id % 3 = 1"))]
    base, places = fresh_path(spark, "stream"), fresh_places(spark)
    stage = Stage("events", events, None, load_strategy="incremental")
    for part in deliveries:
        part.coalesce(2).write.mode("append").parquet(f"{base}/in")
        ingest_files(
            spark, f"{base}/in", schema, stage, places, f"{base}/checkpoint", max_files=1, once_within="7 days"
        ).awaitTermination()
    loaded = Table(spark, f"{places.warehouse}/events").read()
    return loaded.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
