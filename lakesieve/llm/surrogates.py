"""Personal data replaced by keyed surrogates, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Titles before a name, by the gender they tell.
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Госпожа"],
    "u": ["Dr", "Prof", "Professor"],
}

_WORD = r"[\p{L}\p{N}]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_GAP = r"[^\p{L}\p{N}\n,;:/]{0,6}"
#: Up to three capitalised words; in scripts without capitals one word, short where words are not spaced.
_NAME = (
    r"(?:\p{Lu}[\p{L}'’\-]+(?: \p{Lu}[\p{L}'’\-]+){0,2}"
    rf"|[\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}\p{{IsHangul}}]{{2,4}}(?!{_WORD})|[\p{{IsArabic}}\p{{IsHebrew}}]{{2,24}}(?!{_WORD}))"
)
_TITLE = "(?:%s)" % "|".join(sorted(sum(TITLES.values(), []), key=len, reverse=True))

#: What is looked for, first match first. No part can begin inside a word, and every
#: repetition is bounded, so a long run of letters costs no more than its length.
PATTERNS = [
    rf"(?<![\p{{L}}\p{{N}}._%+\-])[\p{{L}}\p{{N}}._%+\-]{{1,64}}@[\p{{L}}\p{{N}}\-]{{1,63}}(?:\.[\p{{L}}\p{{N}}\-]{{1,63}}){{0,6}}\.\p{{L}}{{2,24}}",
    rf"(?<!{_WORD})(?<!\d\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)(?!\p{{L}})",
    rf"(?<!{_WORD})\+1{_GAP}\d{{3}}{_GAP}\d{{3}}{_GAP}\d{{4}}(?!{_WORD})",
    rf"(?<!{_WORD})\+(?!1)\d{{2,3}}(?:{_GAP}\d{{1,4}}){{2,6}}(?!{_WORD})",
    rf"(?<!{_WORD})(?:\(\d{{3}}\) ?|\d{{3}}[-.])\d{{3}}[-.]\d{{4}}(?!{_WORD})",
    rf"(?<!{_WORD})\d{{3}}-\d{{2}}-\d{{4}}(?!{_WORD})",
    rf"(?<!{_WORD})(?:\d{{13,19}}|\d{{4}}(?: \d{{4}}){{3}}|\d{{4}}(?:-\d{{4}}){{3}}|\d{{4}}[ \-]\d{{6}}[ \-]\d{{5}})(?!{_WORD})",
    rf"(?<!{_WORD})(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}})(?!{_WORD})",
    rf"(?<!{_WORD})(?i:{_TITLE})\.? {_NAME}",
]
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS)
#: What may be one of these again: ten digits, and words that a name may be, with what hangs on
#: them by dashes or apostrophes. Neither begins what the patterns above would find later.
_NO_MAIL = r"(?![\p{L}\p{N}._%+\-'’]{0,64}@)"
NUMBER = rf"(?<!{_WORD})\d{{3}}[\-. ]?\d{{3}}[\-. ]?\d{{4}}(?!{_WORD})(?![ \-.]?\d){_NO_MAIL}"
ALONE = (
    rf"(?<!{_WORD})[\p{{Lu}}\p{{Lo}}](?=[\p{{L}}'’])\p{{L}}*+(?:['’\-]{{1,3}}(?!(?i:{_TITLE})\.? )\p{{L}}++){{0,7}}(?!\p{{N}}){_NO_MAIL}"
)
#: Whether a text holds a name after a title, and what is read out of texts without and with one.
TITLED = PATTERNS[-1]
WITHOUT, WITH = f"{PATTERN}|(?:{NUMBER})", f"{PATTERN}|(?:{NUMBER})|(?:{ALONE})"
#: What may follow a name in its match and is none of it: a possessive, quotes and dashes.
SUFFIX = r"(?:['’][sS])?['’\-]*$"
#: A quick look: texts without any of these hold none of the above.
HINT = rf"[0-9@]|[0-9A-Fa-f]{{32}}|(?i:{_TITLE})\.? "

#: The letters a letter may become, by script and case.
ALPHABETS = [
    ("[a-zà-öø-ÿ]", "abcdefghijklmnopqrstuvwxyz"),
    ("[A-ZÀ-ÖØ-Þ]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("[0-9]", "0123456789"),
    ("[а-яё]", "абвгдежзийклмнопрстуфхцчшщыэюя"),
    ("[А-ЯЁ]", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЫЭЮЯ"),
    ("[α-ωά-ώ]", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("[Α-ΩΆ-Ώ]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    ("[א-ת]", "אבגדהוזחטילמנסעפצקרשת"),
    ("[ء-ي]", "ابتثجحدذرزسشصضطظعغفقكلمنهوي"),
    ("[ぁ-ゖ]", "あいうえおかきくけこさしすせそたちつてとなにぬねの"),
    ("[ァ-ヺ]", "アイウエオカキクケコサシスセソタチツテトナニヌネノ"),
    ("[一-龥]", "安白常成大方高古海和江金李林明木南平青山水田文小新星雪野玉正"),
    ("[가-힣]", "가나다라마바사아자차카타파하고노도로모보소오조초코토포호"),
]
HEX = [("[0-9]", "0123456789"), ("[a-f]", "abcdef"), ("[A-F]", "ABCDEF")]
#: Parts names are made of, and endings that tell a gender, by script.
SYLLABLES = {
    "latin": ["ba", "be", "da", "do", "el", "fa", "ga", "ha", "jo", "ka", "le", "li", "ma", "mi", "na", "no", "ra", "ri", "sa", "se", "ta", "ti", "va", "vi"],
    "cyrillic": ["ба", "ве", "га", "да", "до", "жа", "за", "ка", "ле", "ли", "ма", "ми", "на", "но", "ра", "ро", "са", "се", "та", "ти"],
    "greek": ["βα", "γα", "δα", "δη", "θε", "κα", "λε", "λι", "μα", "μη", "να", "νι", "πα", "ρα", "σα", "σο", "τα", "φι"],
}
ENDINGS = {
    "latin": {"m": ["n", "rd", "s", "x"], "f": ["na", "ra", "lia", "ssa"], "u": ["ry", "ne", "lle", "xy"], "family": ["son", "ler", "mann", "ton"]},
    "cyrillic": {"m": ["н", "р", "й", "слав"], "f": ["на", "ра", "лия", "сса"], "u": ["ши", "ня", "ля", "ся"], "family": ["енко", "ук", "ян", "их"]},
    "greek": {"m": ["ς", "νος", "ρης", "λος"], "f": ["να", "ρα", "λια", "νη"], "u": ["νι", "ρω", "λι", "τω"], "family": ["ίδης", "άκης", "έλης", "άτος"]},
}

#: Tries at the length of the original, before surrogates grow by a letter or digit.
PATIENCE = 12


def _kind(value: Column) -> Column:
    digits = F.length(F.regexp_replace(value, r"\D", ""))
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), "ip")
        .when(value.rlike(r"^([0-9a-f]{32,128}|[0-9A-F]{32,128})$"), "secret")
        .when(value.rlike(r"^\p{L}.* "), "name")
        .when(value.rlike(r"^\p{L}"), "alone")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when((digits >= 13) & ~value.startswith("+"), "card")
        .when(value.rlike(r"^\d") & ~value.rlike(r"^\d{3}[-.]\d{3}[-.]\d{4}$"), "number")
        .otherwise("phone")
    )


def _gender(title: Column) -> Column:
    lowered = F.regexp_replace(F.lower(title), r"\.", "")
    return reduce(
        lambda found, g: found.when(lowered.isin([t.lower() for t in TITLES[g]]), g),
        ["f", "u"],
        F.when(lowered.isin([t.lower() for t in TITLES["m"]]), "m"),
    )


def _stem(word: Column) -> Column:
    return F.regexp_replace(word, SUFFIX, "")


def _parts(value: Column, kind: Column) -> Column:
    """What of a match is one entity each: the names after a title, or the whole.

    An entity is named without its format: digits alone, letters in lower case, a phone
    number of ten digits with the country code it leaves out. The last name is the
    family's, so it is the same for all who bear it.
    """
    words = F.split(value, " ")
    names = F.slice(words, 2, F.size(words) - 1)
    gender = _gender(words[0])
    named = F.transform(
        names,
        lambda w, i: F.struct(
            i.alias("part"),
            F.when(i == F.size(names) - 1, "family").otherwise("given").alias("kind"),
            F.lower(_stem(w)).alias("canon"),
            F.when(i == F.size(names) - 1, F.lit(None)).otherwise(gender).alias("gender"),
        ),
    )
    canon = (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("ip", "secret"), value)
        .when(value.startswith("+"), F.concat(F.lit("+"), F.regexp_replace(value, r"\D", "")))
        .when(kind == "phone", F.concat(F.lit("+1"), F.regexp_replace(value, r"\D", "")))
        .otherwise(F.regexp_replace(value, r"\D", ""))
    )
    whole = F.array(F.struct(F.lit(0).alias("part"), kind.alias("kind"), canon.alias("canon"), F.lit(None).cast("string").alias("gender")))
    return F.when(kind == "name", named).otherwise(whole)


def _pieces(word: Column) -> Column:
    """A word cut before and after every dash and apostrophe, these included."""
    return F.split(word, r"(?<=['’\-])|(?=['’\-])")


def _guesses(value: Column, kind: Column) -> Column:
    """``(part, canon)`` of the entities that a number or word alone may be: the whole is part 0, then its pieces."""
    digits = F.concat(F.lit("+1"), F.regexp_replace(value, r"\D", ""))
    canon = F.when(kind == "number", digits).otherwise(F.lower(_stem(value)))
    whole = F.array(F.struct(F.lit(0).alias("part"), canon.alias("canon")))
    pieces = F.transform(_pieces(value), lambda p, i: F.struct((i + 1).alias("part"), p.alias("canon")))
    pieces = F.filter(pieces, lambda p: p["canon"].rlike(r"^[\p{Lu}\p{Lo}]\p{L}"))
    pieces = F.transform(pieces, lambda p: F.struct(p["part"].alias("part"), F.lower(p["canon"]).alias("canon")))
    return F.when((kind == "alone") & value.rlike("['’\\-]"), F.concat(whole, pieces)).otherwise(whole)


def _cased(word: Column, drawn: Column) -> Column:
    stem = _stem(word)
    cased = F.when(F.upper(stem) == stem, F.upper(drawn)).otherwise(F.initcap(drawn))
    return F.concat(cased, F.substr(word, F.length(stem) + 1))


def _number(seed: Column, at: Column | int) -> Column:
    """The ``at``-th number from 0 to 65535 of a stream that only the key's holder can make."""
    block = F.sha2(F.concat_ws("|", seed, F.floor(F.lit(at) / 16).cast("string")), 256)
    place = F.pmod(F.lit(at), F.lit(16)).cast("int") * 4 + 1
    return F.conv(F.substr(block, place, F.lit(4)), 16, 10).cast("int")


def _pick(options: Column, number: Column) -> Column:
    return F.element_at(options, F.pmod(number, F.size(options)) + 1)


def _letters(canon: Column, seed: Column, kept: Column, alphabets: list[tuple[str, str]] = ALPHABETS) -> Column:
    """Every letter and digit after the first ``kept`` becomes one of its script and case."""

    def changed(c: Column, i: Column) -> Column:
        number = _number(seed, i)
        out = F.when(i < kept, c)
        for pattern, alphabet in alphabets:
            out = out.when(c.rlike(pattern), F.substr(F.lit(alphabet), F.pmod(number, F.lit(len(alphabet))) + 1, F.lit(1)))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(canon, ""), changed), "")


def _luhn(digits: Column) -> Column:
    """The sum that a card number's check digit makes a multiple of ten."""
    reversed_ = F.transform(F.split(F.reverse(digits), ""), lambda c, i: c.cast("int") * (1 + F.pmod(i, F.lit(2))))
    return F.aggregate(reversed_, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v))


def surrogate(kind: Column, canon: Column, gender: Column, key: str, attempt: Column) -> Column:
    """A replacement of the same kind, script and length, drawn with the key.

    Mail addresses keep their top-level domain, phone numbers the first digit of a
    country code; addresses of machines stay valid, card numbers keep their check digit
    right where it was; names are made of syllables of their script and end as names of
    their gender, or as family names. Further attempts draw again; after ``PATIENCE``
    of them the replacement is a letter or digit longer for each.
    """
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string")), 256)
    more = F.greatest(attempt - PATIENCE, F.lit(0))
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (1 + F.pmod(_number(seed, i), F.lit(254))).cast("string")), ".")
    top = F.regexp_extract(canon, r"(\.[^.]+)$", 1)
    body = F.concat(F.repeat(F.lit("a"), more), F.substr(canon, F.lit(1), F.length(canon) - F.length(top)))
    email = F.concat(_letters(body, seed, F.lit(0)), top)
    longer = F.concat(canon, F.repeat(F.lit("0"), more))
    drawn = _letters(longer, seed, F.when(canon.startswith("+"), 2).otherwise(0))
    front = F.substr(drawn, F.lit(1), F.length(drawn) - 1)
    check = F.pmod(10 - F.pmod(_luhn(F.concat(front, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    card = F.when(F.pmod(_luhn(canon), F.lit(10)) == 0, F.concat(front, check)).otherwise(drawn)

    script = F.when(canon.rlike(r"\p{IsCyrillic}"), "cyrillic").when(canon.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    ending = F.when(kind == "family", "family").otherwise(F.coalesce(gender, F.lit("u")))

    def made(name: str) -> Column:
        syllables = F.array(*map(F.lit, SYLLABLES[name]))
        stem = F.transform(F.sequence(F.lit(0), 1 + F.least(attempt, F.lit(1)) + more), lambda i: _pick(syllables, _number(seed, i)))
        ends = reduce(
            lambda found, e: found.when(ending == e, _pick(F.array(*map(F.lit, ENDINGS[name][e])), _number(seed, 15))),
            ["f", "u", "family"],
            F.when(ending == "m", _pick(F.array(*map(F.lit, ENDINGS[name]["m"])), _number(seed, 15))),
        )
        return F.concat(F.array_join(stem, ""), ends)

    name = F.when(script == "cyrillic", made("cyrillic")).when(script == "greek", made("greek")).otherwise(made("latin"))
    # letters of scripts without syllables of their own are drawn one by one
    unspelt = canon.rlike(r"[\p{IsHan}\p{IsHebrew}\p{IsArabic}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]")
    name = F.when(unspelt, _letters(longer, seed, F.lit(0))).otherwise(name)
    return (
        F.when(kind == "ip", ip)
        .when(kind == "email", email)
        .when(kind == "card", card)
        .when(kind == "secret", _letters(longer, seed, F.lit(0), HEX))
        .when(kind.isin("given", "family"), name)
        .otherwise(drawn)
    )


def settle(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, surrogate)``: no two entities of a kind share one, none is a real entity.

    Given and family names count as one kind here. Whoever draws a surrogate that is taken, or that occurs in the corpus, draws again; of
    several that draw the same the least keeps it. Nothing leaves the executors but the
    number of those still without.
    """
    space = F.when(F.col("kind").isin("given", "family"), "person").otherwise(F.col("kind"))
    pending, settled = materialise(entities.withColumn("space", space).withColumn("attempt", F.lit(0)), "entities"), None
    real = pending.select("space", F.col("canon").alias("surrogate"))
    nobody = pending.limit(0).select("kind", "canon", F.lit("").alias("surrogate"))
    while not pending.isEmpty():
        drawn = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("canon"), F.col("gender"), key, F.col("attempt")))
        taken = real if settled is None else real.union(settled.select("space", "surrogate"))
        free = drawn.join(taken, ["space", "surrogate"], "left_anti")
        won = free.groupBy("space", "surrogate").agg(F.min(F.struct("canon", "kind")).alias("w"))
        won = materialise(won.select("space", "w.kind", "w.canon", "surrogate"), "surrogates")
        settled = won if settled is None else settled.union(won)
        pending = pending.join(won.drop("space", "surrogate"), ["kind", "canon"], "left_anti").withColumn("attempt", F.col("attempt") + 1)
        pending = materialise(pending, "pending")
    return nobody if settled is None else settled.drop("space")


def _formatted(value: Column, kind: Column, found: Column) -> Column:
    """A match rewritten with its entities' surrogates, in the match's own format."""
    drawn = found[0]["surrogate"]
    # a phone number that leaves out the country code has none in its surrogate
    single = F.when(kind.isin("phone", "number") & ~value.startswith("+"), F.regexp_replace(drawn, r"^\+1", "")).otherwise(drawn)
    gaps = F.split(value, r"\d", -1)
    digits = F.split(F.regexp_replace(single, r"\D", ""), "")
    last = F.size(gaps) - 1
    filled = F.array_join(
        F.transform(gaps, lambda g, i: F.concat(g, F.when(i < last, F.get(digits, i)).otherwise(""))), ""
    )
    rest = F.array_join(F.slice(digits, last + 1, F.greatest(F.size(digits) - last, F.lit(0))), "")
    numbers = F.concat(filled, rest)
    words = F.split(value, " ")
    names = F.transform(found, lambda p, i: _cased(words[i + 1], p["surrogate"]))
    named = F.array_join(F.concat(F.array(words[0]), names), " ")
    mail = F.when(F.upper(value) == value, F.upper(single)).otherwise(single)
    # a word alone is an entity as a whole, or pieces of it are
    replaced = F.transform(
        _pieces(value),
        lambda p, i: F.coalesce(F.get(F.transform(F.filter(found, lambda f: f["part"] == i + 1), lambda f: _cased(p, f["surrogate"])), F.lit(0)), p),
    )
    alone = F.when(found[0]["part"] == 0, _cased(value, single)).otherwise(F.array_join(replaced, ""))
    return (
        F.when(kind == "name", named)
        .when(kind == "alone", alone)
        .when(kind == "email", mail)
        .when(kind.isin("ip", "secret"), single)
        .otherwise(numbers)
    )


def pseudonymise(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` with every detected entity of ``text`` replaced, and ``n_replaced``.

    Mail addresses, phone, card and social security numbers, addresses of machines,
    secrets in hexadecimal and names after a title are found, and all other places of the
    same text where one of these names stands alone, as a whole word with a capital (or of a
    script that has none), or ten digits, however spaced, are one of these phone numbers. The
    same entity gets the same surrogate everywhere, in whatever format it is written;
    different entities get different ones, and none is an entity that occurs in ``df``. A
    given name takes the gender of the titles it occurs with, and none if those disagree; a
    name that a text has as given and family name stands for the given name alone. In scripts
    without capitals the one word after the title is the name, in those without spaces if it
    has two to four letters. Names that no title stands before in the text, and names in
    lower case, are not found.

    Null, empty and clean texts stay as they are, and an empty table stays empty. Rows and all
    other columns are kept; a column ``n_replaced`` is replaced. Work on entities is done once
    for equal texts; only texts that hold one are moved, and they are read out once. What may
    be a name is looked up in the text's names by a join, so a text costs what it is long,
    however many names it has.
    """
    columns = [c for c in df.columns if c != "n_replaced"]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("t"))
    has = F.coalesce(F.col("t").rlike(HINT) & F.col("t").rlike(PATTERN), F.lit(False))
    hits = rows.where(has).select("row", "t", F.sha2("t", 256).alias("of"), F.col("t").rlike(TITLED).alias("titled"))
    read = [F.regexp_extract_all("t", F.lit(p), F.lit(0)) for p in (WITH, WITHOUT)]
    hits = materialise(hits.withColumn("values", F.when(F.col("titled"), read[0]).otherwise(read[1])), "found")

    found = hits.groupBy("of").agg(F.first("values").alias("values"))
    matches = found.select("of", F.posexplode("values").alias("at", "value")).withColumn("whole", _kind(F.col("value")))
    alone = F.col("whole").isin("alone", "number")
    sure = matches.where(~alone).select("*", F.inline(_parts(F.col("value"), F.col("whole"))))
    least, most = F.min("gender"), F.max("gender")
    known = F.when(least == most, least).when(least.isNotNull(), "u").alias("gender")
    mapping = settle(sure.groupBy("kind", "canon").agg(known), key)

    called = sure.where(F.col("kind").isin("given", "family", "phone")).groupBy("of", "canon").agg(F.max("kind").alias("kind"))
    maybe = matches.where(alone).select("*", F.inline(_guesses(F.col("value"), F.col("whole")))).join(called, ["of", "canon"], "left")
    order = ["of", "at", "value", "whole", "part", "kind", "canon"]
    mapped = sure.select(order).union(maybe.select(order)).join(mapping, ["kind", "canon"], "left")
    whole = mapped.groupBy("of", "at", "value", "whole").agg(
        F.sort_array(F.collect_list(F.when(F.col("surrogate").isNotNull(), F.struct("part", "surrogate")))).alias("found")
    )
    new = F.when(F.size("found") > 0, _formatted(F.col("value"), F.col("whole"), F.col("found"))).otherwise(F.col("value"))
    written = whole.select("of", "at", new.alias("new"), (F.size("found") > 0).cast("int").alias("n")).groupBy("of").agg(
        F.sort_array(F.collect_list(F.struct("at", "new"))).alias("new"), F.sum("n").cast("int").alias("n_replaced")
    )
    gaps = F.when(F.col("titled"), F.split("t", WITH, -1)).otherwise(F.split("t", WITHOUT, -1))
    rebuilt = F.array_join(F.zip_with(gaps, F.col("new"), lambda g, n: F.concat(g, F.coalesce(n["new"], F.lit("")))), "")
    changed = hits.drop("values").join(written, "of").select("row", rebuilt.alias("t"), "n_replaced")
    same = rows.where(~has).select("row", "t", F.lit(0).alias("n_replaced"))
    out = [F.col("t").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns]
    return same.union(changed).select(*out, "n_replaced")
