"""The pipeline's stages and the learned queries on the sample tables."""

import os
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_operators import plain_fingerprint, plain_shingles

import corpus_pipeline
from lakesieve.llm import simhash
from lakesieve.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(MIDDLE), reason="sample tables not present")

PRIVATE = [
    r"[\w.+-]+@[\w-]+\.[\w.]+\w", r"\b\d{1,3}(?:\.\d{1,3}){3}\b", r"\b\d{16}\b", r"\+1 \(\d{3}\) \d{3}-\d{4}",
    r"\b[0-9a-f]{40}\b|\b[0-9A-F]{40}\b",
]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage is given and returns, by name."""
    docs, seen = spark.read.parquet(f"{MIDDLE}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, MIDDLE).write.parquet(path)
        after = spark.read.parquet(path)
        seen.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in seen}


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_return_documents(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name


def test_good_documents_stay(spark, stages):
    before, after = map(texts, stages["quality"])
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    held = [d for d in before if marks.get(d) is not None and zlib.crc32(str(d).encode()) % 3 == 1]
    assert sum((d in after) == (marks[d] == 1) for d in held) >= 0.97 * len(held)
    assert all(before[d] == t for d, t in after.items())


def test_one_of_each_group_stays(stages):
    before, after = map(texts, stages["near_duplicates"])
    prints = {d: plain_fingerprint(t) for d, t in before.items()}
    root = {d: d for d in before}
    order = sorted(before)
    for i, a in enumerate(order):
        for b in order[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= 3 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    assert sorted(after) == sorted(set(root.values())) and len(after) < len(before)


def test_no_stage_broadcasts_postings(spark, monkeypatch):
    """What is made of one copy's fingerprints is many times as large as Spark takes it to be."""
    plans, linked = [], simhash.components

    def planned(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return linked(links)

    monkeypatch.setattr(simhash, "components", planned)
    corpus_pipeline.keep_one_copy(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL)
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_no_benchmark_item_stays(spark, stages):
    before, after = map(texts, stages["decontamination"])
    items = [plain_shingles(r.text) for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()]
    for doc, text in before.items():
        held = plain_shingles(text)
        assert (doc in after) == all(len(i & held) < 0.8 * len(i) for i in items)


def test_private_data_is_replaced_and_nothing_else(stages):
    before, after = map(texts, stages["private_data"])
    assert before.keys() == after.keys()
    named = {}
    for doc, text in before.items():
        found = [m for p in PRIVATE for m in re.findall(p, text)]
        new = [m for p in PRIVATE for m in re.findall(p, after[doc])]
        assert len(found) == len(new)
        assert not any(m in after[doc] for m in found)
        if not found:
            assert after[doc] == text
        for old, replacement in zip(found, new):
            assert named.setdefault(old, replacement) == replacement
    assert named and len(set(named.values())) == len(named)
    sizes = {r.doc_id: r.n_chars for r in stages["private_data"][1].collect()}
    assert all(sizes[d] == len(t) for d, t in after.items() if t != before[d])


def test_ids_are_the_librarys_and_decode_to_the_text(stages):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(corpus_pipeline.vocabulary_path())
    before = texts(stages["tokens"][0])
    rows = stages["tokens"][1].collect()
    assert {r.doc_id: r.text for r in rows} == before
    for r in rows:
        assert list(r.ids) == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)


@pytest.fixture(scope="module")
def odd_corpus(spark):
    """The small sample and odd rows, with columns whose names the operators use themselves."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first().text
    long = "plain words and more of them " * 8000 + "x" * 50_000
    rows = [
        (9001, None), (9002, ""), (9003, " \n"), (9004, long), (9005, "one text of some words, twice"), (9005, "one text of some words, twice"),
        (None, "one text of some words, twice"), (9006, "write to ann.lee@mail.example, 10.1.2.3"), (9007, f"before it {item} after it"),
        (None, "nobody has this one"), (None, "nobody has this one"),
    ]
    kinds = dict(docs.dtypes)
    odd = spark.createDataFrame(rows, f"doc_id {kinds['doc_id']}, text string")
    odd = odd.select(*[odd[c] if c in odd.columns else F.lit(None).cast(kinds[c]).alias(c) for c in docs.columns])
    both = docs.union(odd)
    for name in ("score", "n_replaced", "row", "of", "item_id", "ids", "fp", "component_id", "t", "all"):
        both = both.withColumn(name, F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    return both


def test_stages_on_odd_rows(spark, odd_corpus):
    names = [c for c in odd_corpus.columns if c not in ("text", "n_chars")]
    given = Counter(odd_corpus.select(*names, "text", "n_chars").collect())
    stages, after = dict(corpus_pipeline.STAGES), {}
    for name in list(stages)[:-1]:
        found = stages[name](spark, odd_corpus, SMALL)
        assert found.columns == odd_corpus.columns, name
        after[name] = Counter(found.select(*names, "text", "n_chars").collect())
        if name != "private_data":
            assert not after[name] - given, name
    kept = {name: Counter(r.doc_id for r in rows.elements()) for name, rows in after.items()}
    empty = [d in kept["quality"] for d in (9001, 9002, 9003)]
    assert len(set(empty)) == 1 and kept["quality"][9005] in (0, 2)
    near = kept["near_duplicates"]
    assert [near[d] for d in (9001, 9002, 9003, 9004, 9005, 9006, 9007, None)] == [1, 0, 0, 1, 1, 1, 1, 1]
    clean = kept["decontamination"]
    assert [clean[d] for d in (9001, 9002, 9003, 9004, 9005, 9006, 9007, None)] == [1, 1, 1, 1, 2, 1, 0, 3]
    private = after["private_data"]
    assert sum(private.values()) == sum(given.values())
    changed = [r for r in private - given if r.doc_id is not None and r.doc_id > 9000]
    assert [r.doc_id for r in changed] == [9006] and changed[0].n_replaced == "n_replaced 9006"
    assert changed[0].n_chars == len(changed[0].text) and "ann.lee" not in changed[0].text and "10.1.2.3" not in changed[0].text
    tokens = stages["tokens"](spark, odd_corpus, SMALL).collect()
    assert Counter((r.doc_id, r.text) for r in tokens) == Counter((r.doc_id, r.text or "") for r in given.elements())
    assert all((r.n_tokens == 0) == (not r.text) for r in tokens)


def test_stages_on_an_empty_table(spark, odd_corpus):
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd_corpus.limit(0), SMALL)
        assert found.count() == 0 and (name == "tokens" or found.columns == odd_corpus.columns), name


def test_run_is_its_stages(spark, stages):
    whole = corpus_pipeline.run(spark, MIDDLE)
    assert sorted(whole.columns) == sorted(stages["tokens"][1].columns)
    assert texts(whole) == texts(stages["tokens"][1])


@pytest.mark.parametrize("query, label, share", [("op10_quality", "quality", 0.97), ("op4_toxicity", "toxic", 0.93)])
def test_held_out_labels(spark, query, label, share):
    rows = QUERIES[query](spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == r[label] for r in held) >= share * len(held)


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language"](spark, MIDDLE).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_contracts_of_columns(spark):
    wanted = {
        "op4_toxicity": ["doc_id bigint", "held_out boolean", "score double", "predicted int"],
        "op5_bpe": ["doc_id bigint", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"],
        "op7_interleave": ["doc_id bigint", "size bigint", "text_crc32 bigint", "law string", "shard int", "slot bigint", "grown_shard int"],
        "op8_simhash": ["doc_id bigint", "fingerprint string", "component_id bigint"],
        "op9_language": ["doc_id bigint", "held_out boolean", "lang_pred string", "score double"],
        "op10_quality": ["doc_id bigint", "held_out boolean", "score double", "predicted int"],
    }
    for name, columns in wanted.items():
        df = QUERIES[name](spark, SMALL)
        assert [" ".join(c) for c in df.dtypes] == columns and df.count() == 200
