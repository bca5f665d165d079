"""Spelling variants against a plain version, and odd texts."""

import random
import re
import string
import zlib
from collections import Counter

import pytest

from lakesieve.llm import variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    forms, out = {}, []
    for word, n in counts.items():
        others = [o for o in counts if near(word, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        forms[word] = best if best is not None and counts[best] >= 10 * n else None
        out.append((word, n, len(others)))
    rows = []
    for word, n, n_near in out:
        root = word
        while forms[root] is not None:
            root = forms[root]
        rows.append((word, forms[word], root, n, n_near, counts.get(forms[word])))
    return sorted(rows, key=str)


def found(df, **named):
    return sorted([tuple(r) for r in variants.spelling_variants(df, **named).select("word", "form", "root", "n", "n_near", "form_n").collect()], key=str)


def misspelt(rng, word):
    at, letter = rng.randrange(len(word)), rng.choice("aeéÿzt")
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeéßlnrstÀÿ") for _ in range(rng.randint(5, 11))) for _ in range(60)]
    rows = []
    for i in range(700):
        words = [rng.choice(base[: rng.choice([3, 10, 60])]) for _ in range(12)]
        words = [misspelt(rng, w) if rng.random() < 0.06 else w for w in words]
        rows.append((i, rng.choice([" ", ", ", "1", "_"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    # a chain of forms: each ten times as frequent as the one before
    for at, (word, n) in enumerate([("quaggax", 3), ("quaggaxy", 40), ("quaggaxyz", 500)]):
        rows += [(10_000 + 1000 * at + i, word) for i in range(n)]
    return rows


def test_as_a_plain_version(spark, texts):
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = found(df)
    assert got == plain(texts)
    by_word = {r[0]: r for r in got}
    assert by_word["quaggax"][1:3] == ("quaggaxy", "quaggaxyz")
    assert sum(r[1] is not None for r in got) > 20


def test_pieces_change_nothing(spark, texts, monkeypatch):
    expected = plain(texts)
    for words, characters, compared in ((3, 1 << 20, 50), (2048, 40, 1 << 22)):
        monkeypatch.setattr(variants, "WORDS", words)
        monkeypatch.setattr(variants, "CHARACTERS", characters)
        monkeypatch.setattr(variants, "COMPARED", compared)
        monkeypatch.setattr(variants, "TOGETHER", 2)
        assert found(spark.createDataFrame(texts, "doc_id bigint, text string")) == expected


def test_odd_texts(spark):
    long = "x" * 5000
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "sevenal sevenal"), (4, long), (5, long), (6, long + "y"), (6, long + "y"),
            (7, "Señorita señorita SEÑORITA"), (8, "naïve÷word naïve÷word ×multiply× ×multiply×"), (8, "🙂🙂🙂🙂🙂🙂🙂 王小明王小明王"),
            (9, "same word repeated repeated"), (9, "same word repeated repeated"), (10, "ab" * 1500 + " " + "ab" * 1500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as n", "'w' as word", "2 as h", "'i' as id", "3 as run")
    assert found(df) == plain(rows)


def test_empty_and_null_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert found(empty) == []
    assert found(spark.createDataFrame([(1, None)], "doc_id bigint, text string")) == []


def test_string_ids(spark):
    rows = [(f"a{i % 7}", "spelling speling variants varyants " * (1 + i % 3)) for i in range(60)]
    assert found(spark.createDataFrame(rows, "doc_id string, text string")) == plain(rows)


def test_near_pairs_of_all_short_words():
    import itertools

    listed = {n: ["".join(p) for p in itertools.product("abÿ", repeat=n)] for n in (1, 2, 3, 4)}
    for n in (1, 2, 3):
        for other in (n, n + 1):
            rows, columns = variants.near_pairs(listed[n], listed[other], n == other)
            got = {(listed[n][a], listed[other][b]) for a, b in zip(rows, columns)}
            pairs = itertools.combinations(listed[n], 2) if n == other else itertools.product(listed[n], listed[other])
            assert got == {p for p in pairs if near(*p)}


def test_blocks_one_edit_apart_are_neighbours():
    letters = "abcde"  # all classes

    def block(word):
        return (len(word), *(sum(ord(c) % variants.CLASSES == r for c in word) for r in range(variants.CLASSES - 1)))

    steps = set(variants.STEPS) | {tuple(-x for x in s) for s in variants.STEPS}
    rng = random.Random(1)
    for _ in range(2000):
        word = "".join(rng.choice(letters) for _ in range(6))
        other = misspelt(rng, word)
        if near(word, other):
            assert tuple(b - a for a, b in zip(block(word), block(other))) in steps
