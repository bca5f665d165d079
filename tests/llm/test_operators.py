"""Each operator against brute force, and on nulls, empty and long texts, ties and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakesieve.llm import (
    bpe, components, decontaminate, language, quality, sharding, simhash, substrings, surrogates, toxicity,
)
from lakesieve.llm.queries import vocabulary_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and river stone light under quiet market song paper winter green door road glass hand field early north".split()


def prose(rng, words):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "er"]) for _ in range(words))


@pytest.fixture
def docs(frame):
    def build(*texts, first=0):
        return frame(DOCS, *[(first + i, t, "en", "s", 1) for i, t in enumerate(texts)])

    return build


@pytest.fixture
def odd(frame):
    """Null, empty, blank, very long and repeated texts, a null id, and clashing columns."""
    long = "word " * 30_000 + "a" * 50_000
    clash = "score double, predicted int, fp bigint, hash bigint, shard int, ids string, of string, row string, passages string"
    values = (0.5, 1, 1, 1, 1, "i", "o", "r", "p")
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, "same text"), (5, "same text"), (None, "same text"), (6, "été 🙂 \u0000 x@y.example 10.1.2.3")]
    return frame(f"{DOCS}, {clash}", *[(i, t, "en", None, None, *values) for i, t in texts])


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda v: (v is not None, v))


# --- components and SimHash


def test_components_of_chains_stars_and_cycles(frame):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    found = components.components(frame("a bigint, b bigint", *links))
    assert {(r.node, r.root) for r in found.collect()} == (
        {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 160)} | {(i, 200) for i in (200, 201, 202)}
    )


def test_no_links_no_components(frame):
    assert components.components(frame("a bigint, b bigint")).count() == 0


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_four_equal_bytes_make_few_candidates(frame):
    """Fingerprints of one template: four bytes of all are equal, and a few are near."""
    rng = random.Random(5)
    prints = sorted({0x1234ABCD00000000 | rng.getrandbits(32) for _ in range(2000)})
    prints += [p ^ 1 << rng.randrange(32) for p in prints[:20]]
    prints = sorted(set(prints))
    wanted = {(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 3}
    df = frame("fp bigint", *[(p,) for p in prints])
    assert {(r.a, r.b) for r in simhash.fingerprint_links(df).collect()} == wanted
    posted = df.select(F.explode(F.array(*map(simhash._posting, simhash.FIVES))).alias("key"))
    pairs = posted.groupBy("key").count().selectExpr("sum(count * (count - 1) div 2) as n").first()["n"]
    # all pairs are 2.0 million, and met as often by keys of four bytes
    assert len(wanted) >= 20 and pairs < 2_040_000 / 50


def test_postings_are_not_broadcast(frame):
    """Spark takes the postings to be no larger than the fingerprints, of which each has 56."""
    prints = frame("fp bigint", (1,), (3,), (-1,))
    links = simhash.fingerprint_links(prints)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {(r.a, r.b) for r in links.collect()} == {(1, 3)}


def test_simhash_against_all_pairs(docs):
    rng = random.Random(1)
    base = [prose(rng, rng.randint(1, 400)) for _ in range(30)]
    texts = list(base)
    for text in base:
        words = text.split()
        for _ in range(4):
            copy = list(words)
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy))
    texts += ["", " ", "A b C d", "a B c D"]
    rng.shuffle(texts)
    prints = [plain_fingerprint(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    found = {r.doc_id: r for r in simhash.near_duplicates(docs(*texts)).collect()}
    assert [found[i].fp % (1 << 64) for i in range(len(texts))] == prints
    assert [found[i].component_id for i in range(len(texts))] == root
    kept = simhash.drop_near_duplicates(docs(*texts))
    assert ids(kept) == sorted(set(root)) and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_planted_fingerprints_up_to_three_bits_apart(frame):
    rng = random.Random(2)
    prints, wanted = set(), set()
    for _ in range(60):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        prints |= {a, b}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    for a, b in itertools.combinations(signed, 2):
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3:
            wanted.add((a, b))
    found = simhash.fingerprint_links(frame("fp bigint", *[(p,) for p in signed]))
    assert {(r.a, r.b) for r in found.collect()} == wanted


def test_simhash_on_odd_rows(odd):
    found = simhash.near_duplicates(odd).collect()
    by = [(r.doc_id, r.component_id) for r in found]
    assert len(by) == 8 and {c for i, c in by if i in (1, 2, 3)} == {1} and (None, 5) in by
    assert ids(simhash.drop_near_duplicates(odd)) == [1, 4, 5, 6]
    nameless = odd.withColumn("doc_id", F.lit(None).cast("bigint"))
    kept = simhash.drop_near_duplicates(nameless)
    assert kept.count() == 4 and kept.columns == odd.columns
    assert simhash.drop_near_duplicates(odd.limit(0)).count() == 0


def test_texts_are_fingerprinted_once(frame):
    """Of rows without an id those of a nameless group stay, and no second pass over the texts finds them."""
    rng = random.Random(4)
    base = [prose(rng, 300) for _ in range(3)]
    near = [f"{base[0]} {base[0]}", f"{base[0]} {base[0].upper()}"]
    rows = [(1, base[1]), (None, base[1]), (None, None), (None, ""), (None, " "), (None, base[2]), (None, base[2]), *[(None, t) for t in near]]
    kept = simhash.drop_near_duplicates(frame("doc_id bigint, text string", *rows))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, base[1]), (None, None), (None, base[2]), (None, min(near))], key=str
    )
    # fingerprints in the plan of the result start Python workers beside those that wrote them
    assert "EvalPython" not in kept._jdf.queryExecution().executedPlan().toString()


# --- decontamination


def plain_shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_containment_against_all_pairs(docs, frame):
    rng = random.Random(3)
    items = [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    texts = []
    for _ in range(150):
        words = prose(rng, rng.randint(0, 300)).split()
        item = rng.choice(items).split()
        for _ in range(rng.randint(0, 4)):
            item[rng.randrange(len(item))] = "changed"
        at = rng.randint(0, len(words))
        texts.append(" ".join(words[:at] + item + words[at:]) if rng.random() < 0.7 else " ".join(item))
    wanted = {}
    for d, t in enumerate(texts):
        tokens = t.lower().split()
        held = plain_shingles(t) | {tuple(tokens[i : i + n]) for n in range(1, 5) for i in range(len(tokens) - n + 1)}
        for i, item in enumerate(items):
            asked = plain_shingles(item)
            if asked and len(asked & held) / len(asked) >= 0.8:
                wanted[d, i] = (len(asked & held), len(asked))
    bench = frame("item_id bigint, text string", *enumerate(items))
    found = decontaminate.contaminated(docs(*texts), bench)
    assert {(r.doc_id, r.item_id): (r.shared, r.size) for r in found.collect()} == wanted and wanted
    clean = decontaminate.drop_contaminated(docs(*texts), bench)
    assert ids(clean) == sorted(set(range(len(texts))) - {d for d, _ in wanted})


def test_short_items_inside_longer_texts(docs, frame):
    texts = docs("What is the capital of France, you may ask", "capital of France", "the capital of all France", "Paris!", "in Paris today", "")
    items = frame("item_id bigint, text string", (1, "Capital of France"), (2, "paris"), (3, "the capital of all France is far away"), (4, "?"))
    found = decontaminate.contaminated(texts, items).collect()
    assert {(r.doc_id, r.item_id, r.shared, r.size) for r in found} == {(0, 1, 1, 1), (1, 1, 1, 1), (3, 2, 1, 1), (4, 2, 1, 1)}
    assert ids(decontaminate.drop_contaminated(texts, items)) == [2, 5]


def test_a_shuffle_join_finds_the_same(spark, docs, frame):
    item = "one two three four five six seven"
    frames = docs(f"x {item} y", "nothing"), frame("item_id bigint, text string", (1, item))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontaminate.contaminated(*frames)
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert ids(found) == [0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_containment_on_odd_rows(odd, frame):
    items = frame("item_id bigint, text string", (1, "same text"), (2, None), (3, ""), (None, "same text"))
    found = decontaminate.contaminated(odd, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(5, 1), (5, None), (None, 1), (None, None)}
    assert ids(decontaminate.drop_contaminated(odd, items)) == [1, 2, 3, 4, 6]
    assert decontaminate.contaminated(odd.limit(0), items).count() == 0
    assert decontaminate.drop_contaminated(odd, items.limit(0)).count() == 8


# --- repeated passages


def test_cuts_depend_on_nearby_bytes_alone():
    rng = random.Random(4)
    text = prose(rng, 3000).encode()
    ends = set(substrings.cuts(text).tolist())
    shifted = {e - 7 for e in substrings.cuts(b"inserts" + text).tolist()}
    assert len(ends) > 200 and len(ends ^ shifted) <= 4
    for body in (b"", b"a", "é".encode() * 5000, b"ab " * 5000):
        found = substrings.cuts(body)
        assert not len(body) or found[-1] == len(body)
        assert (np.diff(np.concatenate([[0], found])) > 0).all()
        assert "".join(body[a:b].decode() for a, b in zip([0, *found], found)).encode() == body


def test_passages_are_cut_everywhere_but_first(docs):
    rng = random.Random(5)
    passage = prose(rng, 60)
    texts = [prose(rng, 120) for _ in range(12)]
    held = [f"{t} {passage} {t[::-1]}" for t in texts[:6]]
    found = substrings.cut_repeats(docs(*held, *texts[6:])).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 3, 4, 5]
    for row in found:
        assert row.first_ids == [0] and len(row.text) < len(held[row.doc_id]) - 100
        assert row.text.startswith(texts[row.doc_id][:100])
    whole = {r.doc_id: r.text for r in substrings.drop_repeats(docs(*held, *texts[6:])).collect()}
    assert len(whole) == 12 and whole[0] == held[0] and whole[7] == texts[7] and whole[3] != held[3]


def test_texts_of_one_id_are_told_apart_by_64_bits(spark, frame):
    """Two texts of one id that agree in a 32-bit hash: the one that repeats nothing stays whole."""
    rng = random.Random(8)
    passage, other = prose(rng, 40), prose(rng, 40)
    family = lambda of, text: spark.range(200_000).select(F.lit(of).alias("of"), F.concat_ws(" ", F.lit(text), "id").alias("text"))
    both = family("repeats", passage).union(family("new", other)).groupBy(F.hash("text").alias("h"))
    twins = both.agg(F.min_by("text", "of").alias("new"), F.max_by("text", "of").alias("repeats"), F.count_distinct("of").alias("n"))
    pair = twins.where("n = 2").orderBy("h").first()
    held = frame("doc_id bigint, text string", (1, passage), (5, pair.repeats), (5, pair.new))
    kept = {r.text for r in substrings.drop_repeats(held).where("doc_id = 5").collect()}
    assert pair.new in kept and pair.repeats not in kept


def test_passages_on_odd_rows(odd, frame):
    found = substrings.cut_repeats(odd)
    assert set(odd.columns) <= set(found.columns)
    assert {r.doc_id for r in found.collect()} == {4}  # repeats itself
    assert substrings.drop_repeats(odd).count() == 8
    text = prose(random.Random(6), 80)
    copies = frame(DOCS, (3, text, "", "", 0), (3, text, "", "", 0), (None, text, "", "", 0))
    assert {r.doc_id for r in substrings.cut_repeats(copies).collect()} == {3}
    assert substrings.cut_repeats(odd.limit(0)).count() == 0


def plain_passages(texts, span):
    """Bytes of every text that lie in runs of chunks, of ``span`` bytes, held at an earlier place."""
    cut, ends = {}, [substrings.cuts(t.encode()).tolist() for t in texts]
    first = {}
    for doc, (text, stops) in enumerate(zip(texts, ends)):
        body, starts, covered = text.encode(), [0, *stops[:-1]], set()
        for i, start in enumerate(starts):
            for stop in stops[i:]:
                if stop - start < span:
                    continue
                at = first.setdefault(body[start:stop], (doc, start))
                if at != (doc, start) and (at[0] != doc or at[1] + stop - start <= start):
                    covered |= set(range(start, stop))
        if covered:
            cut[doc] = covered
    return cut


def test_passages_with_edited_copies_against_all_runs(docs):
    rng = random.Random(8)
    texts, later, later_at = [], [], []
    for _ in range(30):
        words = [w + str(rng.randrange(100)) for w in prose(rng, 55).split()]
        passage, at = " ".join(words), rng.randrange(10, 45)
        edited = " ".join([*words[:at], "inserted", *words[at:]])
        half = " ".join(words[: len(words) // 2])
        own = [" ".join(w + str(rng.randrange(10**6)) for w in prose(rng, 40).split()) for _ in range(8)]
        group = [f"{own[0]} {edited} {own[1]}", f"{own[2]} {half} {own[3]}", f"{own[4]} {passage} {own[5]}", f"{own[6]} {passage} {own[7]}"]
        later.append(len(texts) + 3)
        later_at.append((later[-1], len(own[6]) + 1, len(passage)))
        texts += group
    found = {r.doc_id: {b for p in r.passages for b in range(p.start, p.stop)} for r in substrings.cut_repeats(docs(*texts)).collect()}
    assert found == plain_passages(texts, substrings.SPAN)
    assert sum(d in found for d in later) == len(later)
    share = [len([b for b in found[d] if start <= b < start + size]) / size for d, start, size in later_at]
    assert sum(share) / len(share) > 0.7


# --- surrogates


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_surrogates_keep_kind_format_and_coreference(docs):
    out = texts_of(surrogates.pseudonymise(docs(
        "Mr. John Smith wrote to ann.lee7@mail.example.com from 10.0.0.1, call +1 (017) 555-7713.",
        "MRS. ANNA SMITH, ANN.LEE7@MAIL.EXAMPLE.COM; +10175557713; 4111 1111 1111 1111",
        "4111111111111111 and Frau Anna Smith; 123-45-6789; 04dbebab91ab85687d33eeaaf9ac699e1188f962",
        "Господин Иван Петров", "version 1.2.3.4.5, 3.14159, 2024-01-02, 12:30",
    ), "key"))
    one = re.fullmatch(r"Mr\. (\w+) (\w+) wrote to ([a-z.0-9]+@[a-z]+\.[a-z]+\.com) from ([\d.]+), call \+1 \((\d{3})\) (\d{3})-(\d{4})\.", out[0])
    two = re.fullmatch(r"MRS\. (\w+) (\w+), ([A-Z.0-9]+@[A-Z]+\.[A-Z]+\.COM); \+1(\d{10}); ((?:\d{4} ){3}\d{4})", out[1])
    three = re.fullmatch(r"(\d{16}) and Frau (\w+) (\w+); \d{3}-\d{2}-\d{4}; [0-9a-f]{40}", out[2])
    assert one and two and three and "John" not in out[0] and "555-7713" not in out[0]
    assert one[2].upper() == two[2] == three[3].upper() and two[1] == three[2].upper()
    assert one[3].upper() == two[3] and one[5] + one[6] + one[7] == two[4]
    assert two[5].replace(" ", "") == three[1]
    digits = [int(c) for c in reversed(three[1])]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    assert re.fullmatch(r"Господин [А-Я][а-я]+ [А-Я][а-я]+", out[3]) and "Иван" not in out[3]
    assert out[4] == "version 1.2.3.4.5, 3.14159, 2024-01-02, 12:30"


def test_surrogates_never_collide(docs, monkeypatch):
    # two letters before a fixed domain leave few surrogates, so that many are drawn twice
    mails = [f"{a}{b}@x.example" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    out = texts_of(surrogates.pseudonymise(docs(*mails), "key"))
    assert len(set(out.values())) == len(mails) and not set(out.values()) & set(mails)
    again = texts_of(surrogates.pseudonymise(docs(*mails), "key"))
    other = texts_of(surrogates.pseudonymise(docs(*mails), "another"))
    assert again == out and other != out


def test_surrogates_on_odd_rows(odd):
    rows = surrogates.pseudonymise(odd, "key")
    assert rows.columns == [*odd.columns, "n_replaced"]
    found = rows.collect()
    assert len(found) == 8
    by = {r.doc_id: r for r in found}
    assert by[1].text is None and by[2].text == "" and by[4].n_replaced == 0 and by[6].n_replaced == 2
    assert by[6].text.startswith("été 🙂 \u0000 ") and "x@y" not in by[6].text and by[6].row == "r"
    assert surrogates.pseudonymise(odd.limit(0), "key").count() == 0
    assert surrogates.pseudonymise(odd.where("doc_id < 6"), "key").where("n_replaced > 0").count() == 0


def test_later_mentions_and_formats_share_surrogates(docs):
    rows = surrogates.pseudonymise(docs(
        "Mr John Smith came. John Smith said that Smith's car, SMITH's, and John; a smith, Smithson and Mr Smith’s hat.",
        "+1 (743) 555-3824 or 743-555-3824, (743) 555-3824, 743.555.3824", "Smith and John, 743-555-3824",
        "Anna-Maria met Anna. Frau Anna Lee and Frau Anna-Maria Lee, 'Mrs Lee'",
    ), "key").collect()
    out, count = {r.doc_id: r.text for r in rows}, {r.doc_id: r.n_replaced for r in rows}
    given, family = re.match(r"Mr (\w+) (\w+) came", out[0]).groups()
    assert {given, family}.isdisjoint({"John", "Smith"}) and count[0] == 7
    up = family.upper()
    assert out[0] == (
        f"Mr {given} {family} came. {given} {family} said that {family}'s car, {up}'s, and {given}; "
        f"a smith, Smithson and Mr {family}’s hat."
    )
    area, mid, end = re.match(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or", out[1]).groups()
    assert (area, mid, end) != ("743", "555", "3824")
    assert out[1] == f"+1 ({area}) {mid}-{end} or {area}-{mid}-{end}, ({area}) {mid}-{end}, {area}.{mid}.{end}"
    assert out[2] == f"Smith and John, {area}-{mid}-{end}"  # no title stands in this text
    both, anna, lee = re.fullmatch(r"(\w+) met (\w+)\. Frau \2 (\w+) and Frau \1 \3, 'Mrs \3'", out[3]).groups()
    assert len({both, anna, lee, "Anna", "Lee"}) == 5


def test_surrogates_against_planted_entities(docs):
    """Texts are put together from words and entities, so what must change, and to what, is known."""
    rng = random.Random(21)
    people = [(rng.choice(["Adam", "Anna", "Jean-Luc", "Mary", "Omar"]), rng.choice(["O'Brien", "Stone", "Lee", "Marlow", "Weiß"])) for _ in range(30)]
    numbers = [f"{rng.randint(201, 989)}{rng.randint(201, 989)}{rng.randint(1000, 9999)}" for _ in range(25)]
    formats = ["+1 ({0}) {1}-{2}", "{0}-{1}-{2}", "({0}) {1}-{2}", "{0}.{1}.{2}", "{0}{1}{2}", "{0} {1} {2}", "{0}-{1} {2}"]
    texts, plans = [], []
    for _ in range(120):
        parts, (given, family), number = [], rng.choice(people), rng.choice(numbers)
        split = number[:3], number[3:6], number[6:]
        parts += ["Dr ", ("given", given), " ", ("family", family), " has ", ("phone", formats[rng.randint(0, 3)].format(*split))]
        for _ in range(rng.randint(0, 12)):
            parts.append(", " + rng.choice(["The", "a", "Stonewall", "1234567", "said", "x3", "Leeds"]) + " ")
            kind = rng.choice(["given", "family", "phone", "twin", "none"])
            if kind == "phone":
                parts.append(("phone", rng.choice(formats).format(*split)))
            elif kind == "twin":
                parts += [("family", family), "-", ("given", given)] if "-" not in given and "'" not in family else ["X"]
            elif kind == "none":
                parts.append("200 300 4001 5 and 6005004003")  # as long as a phone number, but none of the text's
            else:
                name = given if kind == "given" else family
                parts += [(kind, rng.choice([name, name.upper()]) if "ß" not in name else name), rng.choice(["", "'s", "’s", "-"])]
        texts.append("".join(p if isinstance(p, str) else p[1] for p in parts) + ".")
        plans.append(parts)
    rows = surrogates.pseudonymise(docs(*texts), "key").collect()
    drawn = {}
    for r in rows:
        parts = plans[r.doc_id]
        groups = re.fullmatch("".join(re.escape(p) if isinstance(p, str) else r"([\w+() .]+?|[\d+() .-]+?)" for p in parts) + r"\.", r.text)
        entities = [p for p in parts if not isinstance(p, str)]
        assert groups and r.n_replaced <= len(entities), f"{texts[r.doc_id]}\n{r.text}"
        for (kind, old), new in zip(entities, groups.groups()):
            if kind == "phone":
                assert re.sub(r"\d", "0", old) == re.sub(r"\d", "0", new), (old, new)
                old, new = (re.sub(r"\D", "", v)[-10:] for v in (old, new))
            drawn.setdefault((kind, old.lower()), set()).add(new.lower())
    assert all(len(v) == 1 for v in drawn.values()), drawn
    assert len({next(iter(v)) for v in drawn.values()}) == len(drawn)
    assert not {next(iter(v)) for v in drawn.values()} & {old for _, old in drawn}


def test_a_long_text_of_many_names(docs):
    rng = random.Random(4)
    names = ["".join(rng.choice("abcdefghijklmnop") for _ in range(8)).capitalize() for _ in range(3000)]
    text = " ".join(f"then Mr {n} spoke and {n}'s friends with {rng.choice(names)} left" for n in names)
    row = surrogates.pseudonymise(docs(text), "key").first()
    assert row.n_replaced == 9000
    left = set(re.findall(r"\w+", row.text))
    assert left.isdisjoint(names) and len(left) == len(set(names)) + 8


def test_names_in_scripts_without_capitals(docs):
    out = texts_of(surrogates.pseudonymise(docs("Dr 王小明 came, 王小明 left", "Mr אברהם said. אברהם", "Dr 王小明是一个很好的医生"), "key"))
    one = re.fullmatch(r"Dr (\w{3}) came, \1 left", out[0])
    assert one and one[1] != "王小明" and re.fullmatch(r"[\u4e00-\u9fff]{3}", one[1])
    assert re.fullmatch(r"Mr ([\u05d0-\u05ea]{5}) said\. \1", out[1]) and "אברהם" not in out[1]
    assert out[2] == "Dr 王小明是一个很好的医生"  # where the name ends cannot be told


def test_mail_is_found_beside_names(docs):
    text = "Mr O'Brien wrote: O'Brien-x@mail.example, Smith-Mr Jones, 743 555 3824 1234 5678 9012; call 743-555-3824"
    row = surrogates.pseudonymise(docs(text), "key").first()
    assert not re.search("Brien|Jones|3824|x@|9012", row.text) and "Smith-Mr " in row.text


# --- toxicity


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
    return row[-1]


def test_automaton_against_all_distances():
    rng = random.Random(7)
    terms = ["idiot", "worthless", "scum", "disgusting", "moron", "rat"]
    lexicon = toxicity.Lexicon(terms)
    words = list(terms)
    for term in terms * 150:
        word = list(term)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "x", "s", "ot"])
        words.append("".join(word))
    for word in words:
        near = [(levenshtein(word, t), i) for i, t in enumerate(terms) if levenshtein(word, t) <= toxicity.edits(len(t))]
        assert lexicon.closest(word) == ((min(near)[1], min(near)[0]) if near else None), word


def test_quotation_and_address_change_the_evidence():
    scorer = toxicity.Scorer(toxicity.ToxicityModel(["idiot"], [1.0], [1]))
    plain = scorer.evidence("what an idiot walked in here")
    assert scorer.evidence('the word "idiot" is an insult') < plain
    assert scorer.evidence("they wrote “some idiot” in it") < plain < scorer.evidence("you are an idiot")
    assert 0 < scorer.evidence("an idiott walked in") < plain
    assert scorer.evidence("a patriot walked in") == scorer.evidence("") == scorer.evidence(None) == 0


def test_digits_and_signs_inside_words():
    scorer = toxicity.Scorer(toxicity.ToxicityModel(["moron", "idiot", "garbage"], [1.0, 1.0, 1.0], [1, 1, 1], frozenset(["mor4n"])))
    spelt = scorer.evidence("such a morxn there")
    for word in ("mor0n", "m*ron", "m**on", "id1ot", "idi0t", "g@rbage", "garb4ge"):
        assert scorer.evidence(f"such a {word} there") == spelt * (word != "m**on"), word
    assert scorer.evidence("such a mor4n there") == 0  # known to be harmless
    assert scorer.evidence("sent to x@y.example in 4u2c, b2b and w0rd") == 0
    # where the whole is near no term, its words are looked up as if they stood apart
    for joined, apart in (("such idiot@home there", "such idiot home there"), ("idiot*moron there", "idiot moron there"), ("an idiot2you", "an idiot you")):
        assert scorer.evidence(joined) == scorer.evidence(apart) > 0
    assert scorer.evidence("you m0ron") > scorer.evidence("the m0ron") == spelt


@pytest.fixture
def abused(docs, frame):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(240):
        words, bad = prose(rng, 60).split(), i % 3 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["clown", "moron", "trash"]))
        texts.append(" ".join(words))
        labels.append((i, int(bad), int(not bad)))
    return docs(*texts), frame("doc_id bigint, toxic int, quality int", *labels)


def test_lexicon_is_learned_and_scores_held_out(abused):
    corpus, labels = abused
    model = toxicity.fit(corpus, quality.labelled_fold(labels))
    assert sorted(model.terms) == ["clown", "moron", "trash"]
    rows = toxicity.score(corpus, model).join(labels, "doc_id").collect()
    assert all((r.score >= 0.7) == (r.toxic == 1) for r in rows)
    near = toxicity.score(corpus.limit(1).withColumn("text", F.lit("such a morron and a clwn, trassh")), model)
    assert near.first().score > 0.5


def test_toxicity_on_odd_rows(odd, abused):
    corpus, labels = abused
    model = toxicity.fit(corpus, labels)
    scored = toxicity.score(odd, model)
    assert scored.columns == odd.columns and all(0 <= r.score < 0.5 for r in scored.collect())
    nothing = toxicity.fit(odd, labels.limit(0))
    assert nothing.terms == [] and toxicity.score(odd, nothing).count() == 8


# --- quality


def test_quality_of_held_out_documents(docs, frame):
    rng = random.Random(9)
    texts, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        body = prose(rng, rng.randint(3, 80))
        texts.append(body if good else re.sub(r"(\w+)", r"\1###", body) if i % 2 else " ".join(w for w in body.split() for _ in range(9)))
        labels.append((i, int(good)))
    corpus, marks = docs(*texts), frame("doc_id bigint, quality int", *labels)
    model = quality.fit(corpus, quality.labelled_fold(marks))
    rows = quality.score(corpus, model).join(marks, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in held) >= 0.97 * len(held)


def test_a_text_scores_alike_in_any_batch():
    rng = random.Random(10)
    model = quality.QualityModel(np.random.default_rng(1).normal(0, 5, quality.BUCKETS).astype(np.float32), 0.3)
    import pandas as pd

    texts = [prose(rng, n) for n in (0, 1, 5, 700)] + ["", "é 🙂", None]
    together = model.scores(pd.Series(texts))
    assert np.allclose(together, [model.scores(pd.Series([t]))[0] for t in texts])


def test_pieces_of_a_long_text_count_like_the_whole(monkeypatch):
    import pandas as pd

    text = prose(random.Random(11), 4000)
    model = quality.QualityModel(np.random.default_rng(2).normal(0, 5, quality.BUCKETS).astype(np.float32), 0.0)
    whole = model.scores(pd.Series([text]))[0]
    monkeypatch.setattr(quality, "BLOCK", 1000)
    assert abs(model.scores(pd.Series([text]))[0] - whole) < 1e-3


def test_quality_with_ids_of_text(frame):
    rows = [(f"k{i}", "plain good words here" if i % 2 else "bad### bad### words###") for i in range(40)]
    df, labels = frame("doc_id string, text string", *rows), frame("doc_id string, quality int", *[(f"k{i}", i % 2) for i in range(40)])
    scored = quality.score(df, quality.fit(df, labels)).collect()
    assert all((r.score >= 0.5) == (int(r.doc_id[1:]) % 2 == 1) for r in scored)


def test_quality_on_odd_rows(odd, frame):
    labels = frame("doc_id bigint, quality int", (4, 1), (5, 0), (5, 1), (6, 7), (None, 1), (99, 0))
    model = quality.fit(odd, labels)
    scored = quality.score(odd, model)
    assert scored.columns == odd.columns and all(0 <= r.score <= 1 for r in scored.collect())
    bare = quality.score(odd, quality.fit(odd.limit(0), labels.limit(0)))
    assert {r.score for r in bare.collect()} == {0.5}


# --- language


@pytest.mark.parametrize("block", [1, 2, 5, 64])
def test_blocks_change_no_n_gram(monkeypatch, block):
    rng = random.Random(13)
    texts = ["", "a", "a b", "".join(rng.choices("天地玄黄宇宙", k=300)), prose(rng, 80), "x" * 99, "Été, 12 été! ΣΑΣ"]
    whole = [language._counted(t) for t in texts]
    monkeypatch.setattr(language, "BLOCK", block)
    for text, (grams, counts) in zip(texts, whole):
        found, often = language._counted(text)
        assert (found == grams).all() and (often == counts).all()


def test_ranks_against_a_plain_count():
    text = "Die Straße, die DIE Straße!"
    grams, counts = language._counted(text)
    plain = re.sub(r"[^\w]+", " ", f" {text.lower()} ")
    wanted = [plain[i : i + n] for n in (1, 2, 3) for i in range(len(plain) - n + 1)]
    wanted = [g for g in wanted if not (len(g) == 1 and g == " ") and not (len(g) == 3 and g[1] == " ")]
    assert counts.sum() == len(wanted) and len(grams) == len(set(wanted))


def test_languages_of_held_out_documents(frame):
    rng = random.Random(12)
    parts = {"aa": ["ba", "ko", "ti", "ra"], "bb": ["schu", "ver", "ung", "keit"], "cc": ["да", "не", "ку", "ро"]}
    rows = [
        (i, " ".join("".join(rng.choices(parts[name], k=2)) for _ in range(rng.randint(5, 80))), name, "s", 0)
        for i, name in enumerate(itertools.islice(itertools.cycle(parts), 240))
    ]
    corpus = frame(DOCS, *rows, (900, None, "aa", "s", 0), (901, "text", None, "s", 0))
    profiles = language.fit(language.learnable(corpus))
    assert profiles.languages == ["aa", "bb", "cc"]
    found = language.identify(corpus, profiles).where("lang is not null and text is not null").collect()
    assert all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in found)


def test_language_on_odd_rows(odd):
    profiles = language.fit(odd)
    found = language.identify(odd, profiles)
    assert sorted(found.columns) == sorted({*odd.columns, "lang_pred"})
    by = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[4][0] == "en"
    assert {r.lang_pred for r in language.identify(odd, language.fit(odd.limit(0))).collect()} == {"und"}


# --- byte-pair encoding


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def tokenizer():
    with open(vocabulary_path(), encoding="utf-8") as file:
        return bpe.Tokenizer(file.read())


def test_ids_are_those_of_the_library(tokenizer, library):
    rng = random.Random(13)
    parts = ["a", " ", "  ", "\n", "é", "1", "!", "'s", "'ll", "the", " th", "日本", "🙂", " ", "==", "<|endoftext|>", "-", "aaaa", "\r\n", "　", "½", "𝒳", "ing", "\x1c", "\x85", "Ünder"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["x" * 5000, " " * 3000 + "y", prose(rng, 2000), "".join(map(chr, range(0x20, 0x3000)))]
    for text in texts:
        known = library.encode(text, add_special_tokens=False).ids
        assert tokenizer.encode(text).tolist() == known, text
        assert tokenizer.decode(known) == library.decode(known, skip_special_tokens=False) == text


def test_long_texts_are_cut_where_nothing_changes(tokenizer, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 50)
    text = prose(random.Random(14), 500) + "  \n x  y" * 30
    assert tokenizer.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_memory_limits_change_nothing(library, monkeypatch):
    for name in ("REMEMBERED", "PREFIXES", "PAIRS", "TRANSITIONS"):
        monkeypatch.setattr(bpe, name, 20)
    with open(vocabulary_path(), encoding="utf-8") as file:
        small = bpe.Tokenizer(file.read())
    text = prose(random.Random(15), 400)
    assert small.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_odd_bytes_decode_like_the_library(tokenizer, library):
    ids_ = [random.Random(16).randrange(50257) for _ in range(3000)]
    assert tokenizer.decode(ids_) == library.decode(ids_, skip_special_tokens=False)


def test_digests_and_columns(odd, library):
    path = vocabulary_path()
    rows = bpe.digests(odd, path).collect()
    for r in rows:
        known = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(known)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, known)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = bpe.decode(bpe.encode(odd, path), path).collect()
    assert all(r.decoded == (r.text or "") for r in back) and len(back) == 8
    both = bpe.round_trip(odd, path).collect()
    assert [(r.decoded, r.n_tokens) for r in both] == [(r.text or "", len(r.ids)) for r in both]
    assert bpe.decode(bpe.encode(odd.limit(0), path), path).count() == 0


# --- sharding


def test_shards_hold_the_mixture(frame):
    rng = random.Random(17)
    rows = [(i, "t", "en", rng.choices(["hot", "b", "c", None], [60, 25, 10, 5])[0], i) for i in range(997)]
    found = sharding.interleave(frame(DOCS, *rows), shards=8).collect()
    sizes = [sum(r.shard == s for r in found) for s in range(8)]
    assert sum(sizes) == 997 and max(sizes) - min(sizes) <= 1
    for s in range(8):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))
    for source in {r.source for r in found}:
        counts = [sum(r.shard == s and r.source == source for r in found) for s in range(8)]
        assert max(counts) - min(counts) <= 2


def test_shards_against_a_plain_sort(frame):
    rng = random.Random(18)
    rows = [(i, None, None, rng.choice("abc"), 0) for i in range(200)]
    spots = []
    for source in "abc":
        mine = sorted((r[0] for r in rows if r[3] == source), key=lambda i: hashlib.md5(f"0:{i}".encode()).hexdigest())
        spots += [((2 * rank + 1) / (2 * len(mine)), source, i) for rank, i in enumerate(mine)]
    order = {i: at for at, (_, _, i) in enumerate(sorted(spots))}
    found = sharding.interleave(frame(DOCS, *rows), shards=7).collect()
    for r in found:
        at = order[r.doc_id]
        assert (r.shard, r.slot) == (at * 7 // 200, at - -(-(at * 7 // 200) * 200 // 7))


def test_many_buckets_number_alike(frame, monkeypatch):
    rows = frame(DOCS, *[(i, None, None, "ab"[i % 3 > 0], 0) for i in range(300)])
    few = {r.doc_id: (r.shard, r.slot) for r in sharding.interleave(rows).collect()}
    monkeypatch.setattr(sharding, "ROWS_TOGETHER", 7)
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.interleave(rows).collect()} == few


def test_one_null_id_and_sources_of_one_row_are_cut_like_others(frame, monkeypatch):
    """600 rows share a hash, 500 sources of one row a place: cut along the tie, they are numbered alike."""
    rows = [(None if i % 3 else i, f"t{i}", None, "ab"[i % 2] if i < 400 else f"s{i}", i) for i in range(900)]
    df = frame(DOCS, *rows)
    few = {r.text: (r.shard, r.slot) for r in sharding.interleave(df).collect()}
    assert len(few) == 900
    monkeypatch.setattr(sharding, "ROWS_TOGETHER", 8)
    assert {r.text: (r.shard, r.slot) for r in sharding.interleave(df).collect()} == few


def test_sharding_odd_rows(odd):
    found = sharding.interleave(odd)
    assert sorted(found.columns) == sorted({*odd.columns, "slot"})
    rows = found.collect()
    assert len(rows) == 8 and sorted(r.shard for r in rows) == list(range(8)) and {r.slot for r in rows} == {0}
    assert sharding.interleave(odd.limit(0)).count() == 0
