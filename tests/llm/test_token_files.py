"""Token files: ids as the library gives them, exact round trips, order, damage, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesieve.llm import rans, token_files
from lakesieve.llm.queries import WORD_VOCABULARY, vocabulary_path


@pytest.fixture(scope="module")
def path():
    pytest.importorskip("public_tokenizers")
    return vocabulary_path(WORD_VOCABULARY)


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# --- the numeral system


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 5000, 16_384, 16_385, 65_536, 65_537, 200_001])
def test_blocks_come_back(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.2, n), 49_000)
    counts = {int(i): int(c) for i, c in zip(*np.unique(np.append(ids, [2, 7, 49_406]), return_counts=True))}
    table = rans.Table.of(counts)
    assert int(table.frequency.sum()) == 1 << table.bits and (table.frequency > 0).all()
    body = b"".join(rans.Encoder(table).blocks(ids))
    assert (rans.Decoder(table).blocks(body) == ids).all()
    if n > 60_000:
        share = np.array(list(counts.values())) / sum(counts.values())
        entropy = -(share * np.log2(share)).sum()
        assert 8 * len(body) / n < entropy * 1.06 + 0.3


@pytest.mark.parametrize("counts", [{5: 1}, {5: 10**15, 9: 1}, {i: 1 for i in range(3000)}, {i: 10**6 - i for i in range(70_000)}])
def test_extreme_tables(counts):
    table = rans.Table.of(counts)
    ids = np.array(list(counts) * 3)[:100_000]
    body = b"".join(rans.Encoder(table).blocks(ids))
    assert (rans.Decoder(table).blocks(body) == ids).all()


def test_a_block_is_read_by_itself_and_damage_is_found():
    ids = np.arange(150_000) % 900
    table = rans.Table.of({i: 1 for i in range(900)})
    blocks = rans.Encoder(table).blocks(ids)
    decoder = rans.Decoder(table)
    assert len(blocks) == 3 and (decoder.blocks(blocks[1]) == ids[65_536:131_072]).all()
    body = b"".join(blocks)
    for at in (3, 40, len(body) // 2, len(body) - 1):
        broken = bytearray(body)
        broken[at] ^= 4
        with pytest.raises(rans.Damaged):
            decoder.blocks(bytes(broken))
    with pytest.raises(rans.Damaged):
        decoder.blocks(body[:-5])
    with pytest.raises(rans.Damaged):
        rans.Decoder(rans.Table.of({i: 1 + i for i in range(900)})).blocks(body)
    with pytest.raises(ValueError):
        rans.Encoder(table).blocks(np.array([900]))


# --- ids


def test_ids_are_those_of_the_library(path, library):
    with open(path, encoding="utf-8") as file:
        words = token_files.Vocabulary(file.read())
    assert words.apart
    rng = random.Random(3)
    signs = "abcABCÀÿªµ;:  \n\t.,'!?0123éÉ́ßİΣς王あ🙂  \u0085\x1c\x00|<>_-’"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    letters = [*map(chr, range(0xC0, 0x100)), *"abcdeABCDEªµº"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) + rng.choice(["", ".", "!?", ",;", "'s", "."]) for _ in range(2000)]
    texts += ["", " ", "it's WE'LL they'd", "a<|endoftext|>b <|startoftext|> <|end oftext|>", "a<|ENDOFTEXT|> b<|endoftext|", "so... (he said), \"no\"?! it's. x'. n't", "x" * 5000, "e\ńe ́", "ab " * 3000 + "y" * 300]
    for text in texts:
        assert np.frombuffer(words.encode(text, 2), words.kind).tolist() == library.encode(text, add_special_tokens=False).ids + [2], text
    assert words.encode(None, 2) == words.encode("", 2) == np.array([2], words.kind).tobytes()
    assert words.encode(None, None) == b""


def test_vocabularies_that_keep_spaces_get_whole_texts(library):
    from tokenizers import Tokenizer

    assert token_files.drops_white_space(library)
    kept = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    assert not token_files.drops_white_space(kept)
    with open(vocabulary_path("byte_bpe_50k.json"), encoding="utf-8") as file:
        words = token_files.Vocabulary(file.read())
    text = "two  words \n and more"
    assert np.frombuffer(words.encode(text, None), words.kind).tolist() == kept.encode(text, add_special_tokens=False).ids


# --- files


def expected(rows, library):
    """Rows in order of id, null first; those of one id in any order, so only checked as a whole."""
    lists = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    return sorted(lists, key=lambda r: (r[0] is not None, r[0]))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def texts(n, seed=1):
    rng = random.Random(seed)
    words = "the of and river stone light under quiet market song paper winter green door road".split()
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("frame,frames", [(1 << 20, 16), (300, 2), (1, 1)])
def test_round_trip(spark, folder, path, library, monkeypatch, frame, frames):
    monkeypatch.setattr(token_files, "FRAME", frame)
    monkeypatch.setattr(token_files, "FRAMES", frames)
    rows = texts(60 if frame == 1 else 400)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").orderBy(F.hash("doc_id")).selectExpr(
        "*", "'p' as part", "1 as frame", "'i' as ids", "2 as start", "3 as position", "4 as _order")
    target = folder()
    found = token_files.round_trip(df, target, path).orderBy("doc_id").collect()
    begin = 0
    for row, (doc_id, ids) in zip(found, expected(rows, library), strict=True):
        assert tuple(row) == (doc_id, begin, len(ids), crc(ids))
        begin += len(ids)
    again = {r.doc_id: r.ids for r in token_files.read(spark, target).collect()}
    assert again == dict(expected(rows, library))


def test_odd_rows(spark, folder, path, library):
    long = "word " * 40_000 + "z" * 3000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, "same text"), (5, "same text"), (5, "other text"), (None, "same text"), (None, None), (-6, "é 🙂 \x00")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = token_files.round_trip(df, folder(), path).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, -6, 1, 2, 3, 4, 5, 5, 5]
    begin = 0
    for row in found:
        assert row.start == begin
        begin += row.n_tokens
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == sorted((str(i), len(ids), crc(ids)) for i, ids in expected([(str(i), t) for i, t in rows], library))


def test_empty_table_and_string_ids(spark, folder, path, library):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_files.round_trip(none, folder(), path).count() == 0
    rows = [(f"k{i % 5}-{i}", t) for i, t in texts(20)]
    found = token_files.round_trip(spark.createDataFrame(rows, "doc_id string, text string"), folder(), path)
    assert [(r.doc_id, r.ids_crc32) for r in found.orderBy("start").collect()] == [(i, crc(ids)) for i, ids in expected(rows, library)]


def test_damaged_files_are_noticed(spark, folder, path):
    import glob

    target = folder()
    token_files.write(token_files.encode(spark.createDataFrame(texts(50), "doc_id bigint, text string"), path), target, 2)
    (name,) = glob.glob(f"{target}/frames/part-*")
    with open(name, "rb") as file:
        body = bytearray(file.read())
    assert body[:4] == token_files.MAGIC
    body[len(body) // 2] ^= 1
    with open(name, "wb") as file:
        file.write(body)
    for crc_file in glob.glob(f"{target}/frames/.part-*.crc"):
        with open(crc_file, "wb") as file:
            file.truncate(0)
    with pytest.raises(Exception):
        token_files.read(spark, target).collect()


def test_one_id_of_many_rows_is_dealt_to_many_files(spark, folder, path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME", 200)
    monkeypatch.setattr(token_files, "FRAMES", 1)
    target = folder()
    df = spark.range(2000).selectExpr("cast(null as bigint) as doc_id", "'the same few words in every row' as text")
    token_files.write(token_files.encode(df, path), target, 2)
    files = spark.read.format("binaryFile").load(f"{target}/frames").agg(F.count("*"), F.max("length"), F.sum("length")).first()
    assert files[0] > 20 and files[1] < files[2] / 10
    assert token_files.read(spark, target).count() == 2000


def test_query_on_the_sample_tables(spark, library):
    from lakesieve.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    begin, wanted = 0, []
    for doc_id, ids in expected(rows, library):
        wanted.append((doc_id, begin, len(ids), crc(ids)))
        begin += len(ids)
    found = QUERIES["op13_token_files"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect())) == wanted
