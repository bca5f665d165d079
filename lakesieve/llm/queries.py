"""One query per operator, over its whole table, with equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from . import (
    bpe, centroids, decontaminate, language, quality, search, sharding, simhash, substrings, surrogates, token_files, toxicity,
    variants,
)
from .common import in_fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The public tokenizers' files.
VOCABULARY, WORD_VOCABULARY = "byte_bpe_50k.json", "word_bpe_49k.json"


def query(function):
    QUERIES[function.__name__] = function
    return function


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds at least 80 % of a benchmark item, with the item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op1_decontaminate"] = r"""
    with docs as (
        select distinct doc_id, text,
               list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w != '') as w
        from documents where text is not null),
    items as (
        select distinct item_id, text,
               list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w != '') as w
        from benchmark where text is not null),
    held as (
        select distinct doc_id, text, unnest(case when len(w) >= 5
            then list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i+4], 'string_agg', ' '))
            when len(w) > 0 then [list_aggregate(w, 'string_agg', ' ')] else [] end) as shingle
        from docs
        union
        select doc_id, text, unnest(list_transform(range(1, len(w) - n + 2),
            lambda i: list_aggregate(w[i:i+n-1], 'string_agg', ' '))) as shingle
        from docs join (select distinct len(w) as n from items where len(w) between 1 and 4) on len(w) >= n),
    asked as (
        select distinct item_id, text, unnest(case when len(w) >= 5
            then list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i+4], 'string_agg', ' '))
            when len(w) > 0 then [list_aggregate(w, 'string_agg', ' ')] else [] end) as shingle
        from items),
    sizes as (select item_id, text, count(*) as size from asked group by all),
    pairs as (
        select h.doc_id, h.text, a.item_id, s.size, count(*) as shared
        from asked a join held h using (shingle)
        join sizes s on s.item_id is not distinct from a.item_id and s.text = a.text
        group by all)
    select doc_id, item_id, cast(max(shared) as int) as shared, cast(max(size) as int) as size,
           max(shared / size) as containment
    from pairs where shared >= 0.8 * size - 1e-9 group by doc_id, item_id
"""


@query
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with passages that another holds first, cut; and which documents keep them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.cut_repeats(docs)


#: The key of the sample tables' surrogates; a real corpus needs a secret one.
KEY = "sample key"


@query
def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every document with surrogates for personal data, and their number."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymise(docs, KEY)


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, quality.labelled_fold(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select(
        "doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number and digest of every document's token ids, and the digest of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, vocabulary_path()).drop("text")


@query
def op6_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 50, by BM25."""
    return search.top_k(table(spark, sf_dir, "documents"), "doc_id % 50 = 0")


SQL["op6_search"] = r"""
    with words as (
        select doc_id, unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w != '')) as word
        from documents),
    facts as (select count(*) as n, sum(length) / count(*) as mean from (
        select doc_id, count(*) filter (word is not null) as length from documents left join words using (doc_id) group by doc_id)),
    lengths as (select doc_id, count(*) as length from words group by doc_id),
    counts as (select doc_id, word, count(*) as tf from words group by doc_id, word),
    frequencies as (select word, count(*) as df from counts group by word),
    scores as (
        select q.doc_id as query_id, c.doc_id,
               round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * c.tf * 2.2 / (c.tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) as score
        from counts q join counts c on q.word = c.word join frequencies f on f.word = c.word
        join lengths l on l.doc_id = c.doc_id, facts
        where q.doc_id % 50 = 0 group by q.doc_id, c.doc_id)
    select query_id, cast(rank as int) as rank, doc_id, score from (
        select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from scores)
    where rank <= 10
"""


@query
def op7_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document; shards differ by one row at most."""
    text = F.coalesce("text", F.lit(""))
    keys = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return sharding.interleave(keys).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and the component that near duplicates form."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language.fit(language.learnable(docs))
    return language.identify(docs.select("doc_id", "text"), profiles).select(
        "doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score"
    )


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, quality.labelled_fold(table(spark, sf_dir, "labels")))
    return quality.score(docs, model).select(
        "doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after five rounds of exact centroid clustering."""
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def _centroid_rounds(rounds: int) -> str:
    """One assignment and one move of the centroids after another, as common tables."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
    near{r} as materialized (
        select row, min(d * 64 + c) as best from (
            select row, c, cast(sum((x - y) * (x - y)) as bigint) as d from parts join at{r} using (i) group by row, c)
        group by row)""")
        if r < rounds:
            steps.append(f"""
    sums{r} as (select best % 64 as c, i, cast(sum(x) as bigint) as s, count(*) as n from near{r} join parts using (row) group by all),
    at{r + 1} as materialized (
        select c, i, coalesce((s - ((s % n) + n) % n) // n, y) as y from at{r} left join sums{r} using (c, i))""")
    return ",".join(steps)


SQL["op11_centroids"] = f"""
    with kept as materialized (
        select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
        from embeddings
        where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
    parts as materialized (select row, unnest(range(64)) as i, unnest(v) as x from kept),
    first as materialized (
        select row, row_number() over (order by sha256('2:' || vec_id), v) - 1 as c from kept
        qualify c < 40),
    at0 as materialized (select c, i, x as y from first join parts using (row)),
    {_centroid_rounds(centroids.ROUNDS)},
    found as (select vec_id, best % 64 as cluster, best // 64 as distance from near5 join kept using (row)),
    names as (select c as cluster, sha256(string_agg(y::varchar, ',' order by i)) as centroid_sha256 from at5 group by c)
    select vec_id, cast(cluster as int) as cluster, cast(distance as bigint) as distance,
           cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
           cast(sum(distance) over () as bigint) as inertia, centroid_sha256
    from found join names using (cluster)
"""


@query
def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of seven letters that occurs twice, with the frequent word it may be a spelling of."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


SQL["op12_variants"] = r"""
    with recursive crc as materialized (
        select list_transform(range(256), lambda i: list_reduce(
            [i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
    runs as (
        select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
        from documents),
    counted as materialized (select coalesce(doc_id::varchar, '') || ':' || run as id, run, count(*) as n from runs where length(run) >= 7 group by all),
    hashed as (
        select run, n, xor(list_reduce(
            list_prepend(4294967295, list_transform(range(1, strlen(id) + 1), lambda i: ('0x' || substr(hex(encode(id)), 2 * i - 1, 2))::bigint)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
        from counted, crc),
    spelt as (
        select case when h % 31 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n
        from hashed),
    words as materialized (
        select word, cast(sum(n) as bigint) as n from spelt where length(word) >= 7 group by word having sum(n) >= 2),
    gaps as materialized (
        select word, n, unnest(range(1, length(word) + 1)) as i, left(word, i - 1) || substr(word, i + 1) as rest from words),
    pairs as materialized (
        select distinct a.word, b.word as other, b.n as other_n from gaps a join gaps b on a.rest = b.rest and a.i = b.i where a.word <> b.word
        union select w.word, g.word, g.n from words w join gaps g on g.rest = w.word
        union select g.word, w.word, w.n from words w join gaps g on g.rest = w.word),
    best as (
        select word, count(*) as n_near, max(other_n) as most, arg_min(other, (-other_n, other)) as other from pairs group by word),
    forms as materialized (
        select w.word, case when most >= 10 * n then other end as form, n, coalesce(n_near, 0) as n_near,
               case when most >= 10 * n then most end as form_n
        from words w left join best using (word)),
    follow as (
        select word, word as reached from forms
        union all select f.word, g.form from follow f join forms g on g.word = f.reached where g.form is not null),
    roots as (select f.word, f.reached as root from follow f join forms g on g.word = f.reached where g.form is null)
    select word, form, root, n, n_near, form_n from forms join roots using (word)
"""


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place, number and checksum of every document's token ids, read back from binary files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.round_trip(docs, fresh_path(spark, "token-files"), vocabulary_path(WORD_VOCABULARY))
