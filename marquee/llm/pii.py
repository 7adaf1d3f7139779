"""Surrogate generation: personal data replaced by keyed look-alikes of the same type.

One pattern finds the entities of a text. Every distinct entity of the corpus
gets one surrogate, so all its mentions stay the same person or number
(coreference). A surrogate comes from a keyed permutation that changes each
character within its own class (digit, Latin vowel or consonant, Cyrillic or
Greek letter, upper or lower case), so length, script and format stay, and
distinct entities of a shape stay distinct. What carries meaning stays too:

* e-mail: separators and the top-level domain;
* phone: the country code and the separators;
* card: the first digit, grouping, and whether its check digit is right;
* IPv4: four numbers from 0 to 255; IPv6: hexadecimal groups and separators;
* keys and hexadecimal secrets: prefix, alphabet and length;
* person: the honorific and with it the gender, the script, the capitals, and
  the last letter of each name (often a gender ending). Names are replaced
  word by word, so ``Mrs Ana Roe`` and ``Mrs Roe`` keep a name in common, and
  so does ``Roe`` without a title in a text that names ``Mrs Roe``.

Surrogates are then checked against each other and against all real entities.
Those that equal another or a real entity (their own included), and no others,
are drawn again with the next tweak. Where that doesn't help within ``TWEAKS``
rounds, the shape is full (five two-letter names after a title fill theirs),
and names, addresses, secrets and phones become longer by a character a round,
so the shape soon holds an unused string for each. Nothing is returned before
every entity has a surrogate of its own; a kind of fixed length whose values
are used up is an error.

A name is found by its title, so a person who is never named with one stays.
The key comes from the caller, or from the session's ``KEY_SETTING``; a
session without one gets a random key of its own.

Everything is DataFrame work. Documents without entities are passed through;
only those with entities are written aside and joined to their replacements.

Defined cases: a null or empty text has no entities and stays as it is;
repeated texts get the same replacement (ties can't arise); very long texts and
values go whole; null ids and extra columns pass through; an input column
``n_entities`` is replaced; empty table: no rows.
"""

from __future__ import annotations

import secrets
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.join import split_heavy_join
from marquee.session import materialized

KEY_SETTING = "spark.marquee.surrogates.key"
TWEAKS = 8  # draws within a value's own shape
FIXED = ("ipv4", "ipv6", "ssn", "card", "key", "iban")  # kinds whose length is part of their format
FIXED_TWEAKS = 64
ROUNDS = 6

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,24}(?![\p{L}\p{N}-])"
SECRET_NAME = r"(?i:password|passwd|secret|token|api_key) ?[=:] ?[\"']?"
SECRET = SECRET_NAME + r"[^\s\"',;]{4,}[^\s\"',;.:!?)]"
IPV4 = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
IPV6 = (
    r"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|[0-9A-Fa-f]{3,4}:(?:[0-9A-Fa-f]{1,4}:){0,5}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])"
)
PHONE = (
    r"(?<![\d+])\+\d{8,15}(?!\d)|"
    r"(?<![\d+])\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\d+])\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\d)"
    r"|(?<!\d)\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]|\.\d)"
)
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{15,16})(?![\d-])"
KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
HONORIFICS = "Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Г-н|Г-жа|Господин|Госпожа"
TITLE = rf"(?:{HONORIFICS})\.? "
PERSON = rf"(?<![\p{{L}}\d]){TITLE}\p{{Lu}}[\p{{L}}'-]++(?: \p{{Lu}}[\p{{L}}'-]++)*+"
NAME = r"(?<![\p{L}\d'-])\p{Lu}[\p{L}'-]++"  # a word that may be an untitled mention of a person

# The guards let most letters of ordinary text fail on one look.
ENTITY = (
    rf"{EMAIL}|(?=[pstaPSTA]){SECRET}|(?=[0-9A-Fa-f]){IPV6}|(?=[\d+(])(?:{IPV4}|{PHONE}|{SSN}|{CARD})"
    rf"|(?=[A-Z])(?:{KEY}|{IBAN})|(?=[MFHSГ]){PERSON}"
)

_LOWER = ("aeiou", "bcdfghjklmnpqrstvwxyz", "áàâäéèêëíìîïóòôöúùûü", "çñ", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ")


def _other_letters() -> list[str]:
    """Every other cased letter, in one class for each script and case."""
    known = set("".join(_LOWER) + "".join(_LOWER).upper())
    classes: dict[tuple[str, bool], str] = {}
    for letter in map(chr, range(0xAA, 0x1EA00)):
        if letter not in known and (letter.islower() or letter.isupper()):
            group = (unicodedata.name(letter, "?").split()[0], letter.islower())
            classes[group] = classes.get(group, "") + letter
    return list(classes.values())


# Alphabets by number; each is a list of classes that a character stays within.
ALPHABETS = (
    ("0123456789", *_LOWER, *(c.upper() for c in _LOWER), *_other_letters()),
    ("0123456789abcdef",),
    ("0123456789ABCDEF",),
    ("0123456789", "abcdef", "ABCDEF"),
)


def kind_of(value: Column) -> Column:
    """The type of a found entity, from its own characters."""
    kinds = {
        "secret": f"^{SECRET}$",
        "email": "@",
        "key": "^AKIA",
        "person": f"^{TITLE}",
        "ipv4": r"^\d+\.\d+\.\d+\.\d+$",
        "ipv6": r"^[0-9A-Fa-f]+:",
        "ssn": r"^\d{3}-\d{2}-\d{4}$",
        "card": r"^(\d{15,16}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4})$",
        "iban": "^[A-Z]{2}",
    }
    out = F.lit("phone")
    for kind, pattern in reversed(kinds.items()):
        out = F.when(value.rlike(pattern), F.lit(kind)).otherwise(out)
    return out


def _per_alphabet(values: list[list]) -> Column:
    lists = [F.split(F.lit(",".join(map(str, v))), ",").cast("array<int>") for v in values]  # folded into a constant
    return F.get(F.array(*lists), F.col("__alphabet"))


def _mover(in_half: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
    def move(s: Column, i: Column) -> Column:
        p = F.get("__place", i)
        drawn = F.sha2(F.concat(F.col("__digest"), i.cast("string")).cast("binary"), 256)
        step = F.conv(F.substring(drawn, 1, 12), 16, 10).cast("bigint")
        return F.when(in_half(i) & (p > 0), F.pmod(s + step, F.get("__size", p - 1)).cast("int")).otherwise(s)

    return move


def permuted(df: DataFrame, body: str, alphabet: Column, key: Column, out: str) -> DataFrame:
    """Adds ``out``: a keyed permutation of the strings in column ``body`` that have one shape.

    A Feistel network over the two halves of the string: each round shifts the
    characters of one half, within their classes, by amounts drawn from the
    key, the round and the other half. So no two strings of the same shape
    get the same result; characters of no class stay.
    """
    letters = ["".join(a) for a in ALPHABETS]
    starts = [[sum(map(len, a[:k])) for k, c in enumerate(a) for _ in c] for a in ALPHABETS]
    sizes = [[len(c) for c in a for _ in c] for a in ALPHABETS]
    half = F.expr("size(__chars) div 2").cast("int")
    now = (
        df.withColumn("__alphabet", alphabet)
        .withColumn("__letters", F.get(F.array(*[F.lit(x) for x in letters]), F.col("__alphabet")))
        .withColumn("__first", _per_alphabet(starts))
        .withColumn("__size", _per_alphabet(sizes))
        .withColumn("__key", key)
        .withColumn("__chars", F.when(F.length(body) > 0, F.split(body, "")).otherwise(F.expr("cast(array() as array<string>)")))
        # place of each character in the alphabet, from 1; 0 if it is in no class
        .withColumn("__place", F.transform("__chars", lambda c: F.instr(F.col("__letters"), c)))
        .withColumn("__state", F.transform("__place", lambda p: F.when(p > 0, p - 1 - F.get("__first", p - 1)).otherwise(0)))
    )
    for turn in range(ROUNDS):
        upper = turn % 2 == 0
        other = F.slice("__state", F.lit(1), half) if upper else F.slice("__state", half + 1, F.size("__state"))
        said = F.concat_ws("|", "__key", F.lit(str(turn)), F.array_join(other.cast("array<string>"), ","))

        moved = _mover((lambda i: i >= half) if upper else (lambda i: i < half))
        now = now.withColumn("__digest", F.sha2(said.cast("binary"), 256)).withColumn("__state", F.transform("__state", moved))

    def letter(s: Column, i: Column) -> Column:
        p = F.get("__place", i)
        put = F.substr(F.col("__letters"), F.get("__first", p - 1) + s + 1, F.lit(1))
        return F.when(p > 0, put).otherwise(F.get("__chars", i))

    made = now.withColumn(out, F.array_join(F.transform("__state", letter), ""))
    return made.drop("__alphabet", "__letters", "__first", "__size", "__key", "__chars", "__place", "__state", "__digest")


def _check_digit(payload: Column) -> Column:
    """Luhn check digit of a string of digits."""
    digits = F.transform(F.reverse(F.split(payload, "")), lambda d: d.cast("int"))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda acc, d: acc + d), F.lit(10))


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by the string ``digits``, in order."""
    def put(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substr(value, F.lit(1), i + 1), r"\D", ""))
        return F.when(c.rlike(r"^\d$"), F.substr(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), put), "")


def with_surrogates(units: DataFrame, key: str) -> DataFrame:
    """``units`` (kind, value, tweak) with ``surrogate``, which is longer by the draws beyond ``TWEAKS``."""
    kind = F.col("kind")
    longer = F.when(kind.isin(*FIXED), 0).otherwise(F.greatest(F.col("tweak") - (TWEAKS - 1), F.lit(0)))
    units = units.withColumn("shape", _longer_value(kind, longer))
    value = F.col("shape")
    head = (
        F.when(kind == "secret", F.regexp_extract(value, f"^{SECRET_NAME}", 0))
        .when(kind == "phone", F.regexp_extract(value, r"^\+\d{1,3}", 0))
        .when(kind.isin("key", "iban"), F.substring(value, 1, 4))
        .otherwise(F.lit(""))
    )
    tail = F.when(kind == "email", F.regexp_extract(value, r"\.\p{L}+$", 0)).when(
        kind == "name", F.substring(value, -1, 1)
    ).otherwise(F.lit(""))
    rest = F.substr(value, F.length("head") + 1, F.length(value) - F.length("head") - F.length("tail"))
    digits = F.regexp_replace("rest", r"\D", "")
    octets = F.transform(F.split("rest", r"\."), lambda o: F.lower(F.lpad(F.hex(o.cast("int")), 2, "0")))
    body = (
        F.when(kind == "ipv4", F.array_join(octets, ""))
        .when(kind == "card", F.substr(digits, F.lit(2), F.length(digits) - 2))
        .when(kind.isin("phone", "ssn"), digits)
        .otherwise(F.col("rest"))
    )
    may_be_hex = kind.isin("secret", "ipv6")
    hexadecimal = (kind == "ipv4") | F.col("body").rlike("^[0-9a-f:]+$") & may_be_hex
    alphabet = F.when(hexadecimal, 1).when(F.col("body").rlike("^[0-9A-F:]+$") & may_be_hex, 2).when(kind == "ipv6", 3).otherwise(0)
    tweaked = F.concat_ws("|", F.lit(key), F.when(kind == "name", "name").otherwise(kind), F.col("tweak").cast("string"))
    parts = units.withColumn("head", head).withColumn("tail", tail).withColumn("rest", rest).withColumn("body", body)
    made = permuted(parts, "body", alphabet, tweaked, "made")
    numbers = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substr("made", i * 2 + 1, F.lit(2)), 16, 10))
    first, last = F.substring(digits, 1, 1), F.substring(digits, -1, 1).cast("int")
    offset = last - _check_digit(F.substr(digits, F.lit(1), F.length(digits) - 1))
    payload = F.concat(first, F.col("made"))
    card = F.concat(payload, F.pmod(_check_digit(payload) + offset, F.lit(10)).cast("string"))
    again = (
        F.when(kind == "ipv4", F.array_join(numbers, "."))
        .when(kind == "card", _refilled(F.col("rest"), card))
        .when(kind.isin("phone", "ssn"), _refilled(F.col("rest"), F.col("made")))
        .otherwise(F.col("made"))
    )
    return made.withColumn("surrogate", F.concat("head", again, "tail")).select("kind", "value", "tweak", "surrogate")


def _longer_value(kind: Column, by: Column) -> Column:
    """The value with ``by`` characters more where its shape can grow: before a name's last letter, else at a place that stays inside."""
    value = F.col("value")
    more = F.repeat(F.when(kind == "phone", F.lit("0")).otherwise(F.lit("n")), by.cast("int"))
    before_last = F.concat(F.substr(value, F.lit(1), F.length(value) - 1), more, F.substring(value, -1, 1))
    return F.when(by == 0, value).when(kind == "name", before_last).when(kind == "email", F.concat(more, value)).otherwise(F.concat(value, more))


def checked_surrogates(units: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct ``units`` (kind, value): none is a real value, and no two are equal.

    Each round draws for the values that have no surrogate yet. A draw that is
    a real value, was given before, or falls on several values (all but the
    smallest one) is repeated with the next tweak.
    """
    spark = units.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # drawing costs time, not bytes, so the rows are dealt out by number
    units = materialized(units.select("kind", "value"), "units")
    taken = units.select("kind", F.col("value").alias("surrogate"))
    settled: list[DataFrame] = []
    pending, tweak = units, 0
    while True:
        drawn = materialized(with_surrogates(pending.repartition(tasks).withColumn("tweak", F.lit(tweak)), key), "surrogates")
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        least = free.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        settled.append(materialized(least.select("kind", "value", "surrogate"), "settled-surrogates"))
        pending = materialized(drawn.join(settled[-1].select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value"), "clashes")
        if pending.isEmpty():
            break
        taken = taken.unionByName(settled[-1].select("kind", "surrogate"))
        tweak += 1
        if tweak >= FIXED_TWEAKS and not pending.where(F.col("kind").isin(*FIXED)).isEmpty():
            raise ValueError("a kind of fixed length has no unused surrogate left")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def entity_surrogates(entities: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(value, surrogate) of distinct entity strings, persons put together from their names; and of the names."""
    typed = entities.select("value", kind_of(F.col("value")).alias("kind"))
    names = F.split(F.regexp_replace("value", f"^{TITLE}", ""), " ")
    of_persons = typed.where("kind = 'person'").select(
        F.col("value").alias("person"),
        F.regexp_extract("value", f"^{TITLE}", 0).alias("title"),
        F.posexplode(names).alias("nth", "value"),
    )
    units = typed.where("kind != 'person'").select("kind", "value").unionByName(
        of_persons.select(F.lit("name").alias("kind"), "value").distinct()
    )
    made = checked_surrogates(units, key)
    named = made.where("kind = 'name'").select("value", "surrogate")
    spoken = (
        of_persons.join(named, "value")
        .groupBy("person", "title")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "surrogate"))).alias("names"))
        .select(F.col("person").alias("value"), F.concat("title", F.array_join("names.surrogate", " ")).alias("surrogate"))
    )
    return materialized(made.where("kind != 'name'").select("value", "surrogate").unionByName(spoken), "entity-surrogates"), named


def _names_by_text(said: DataFrame, named: DataFrame) -> DataFrame:
    """(__text_id, __names): the names of a text's persons and their surrogates, as a map."""
    persons = said.where(F.col("value").rlike(f"^{TITLE}") & (kind_of(F.col("value")) == "person"))
    words = F.split(F.regexp_replace("value", f"^{TITLE}", ""), " ")
    return (
        split_heavy_join(persons.select("__text_id", F.explode(words).alias("value")).distinct(), named, "value", "__text_id")
        .groupBy("__text_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("__names"))
    )


def _renamed(word: Column) -> Column:
    """The surrogate of an untitled name, also with an English genitive ending; null for any other word."""
    ending = F.regexp_extract(word, "'s?$", 0)
    stem = F.substr(word, F.lit(1), F.length(word) - F.length(ending))
    return F.coalesce(F.element_at("__names", word), F.concat(F.element_at("__names", stem), ending))


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities`` (mentions replaced)."""
    own = [c for c in docs.columns if c.lower() != "n_entities"]
    kept = docs.select(*own)
    some = F.coalesce(F.col(text).rlike(ENTITY), F.lit(False))
    clean = kept.where(~some).withColumn("n_entities", F.lit(0).cast("bigint"))

    found = kept.where(some).withColumn("__found", F.regexp_extract_all(text, F.lit(ENTITY), 0))
    found = found.withColumn("__text_id", F.sha2(F.col(text).cast("binary"), 256)).withColumn("__row", F.monotonically_increasing_id())
    found = materialized(found, "texts-with-entities")
    said = found.select("__text_id", F.explode("__found").alias("value")).distinct()
    surrogates, named = entity_surrogates(said.select("value").distinct(), key)
    by_text = (
        split_heavy_join(said, surrogates, "value", "__text_id")
        .groupBy("__text_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("__surrogates"))
        .join(_names_by_text(said, named), "__text_id", "left")
    )
    joined = split_heavy_join(found, materialized(by_text, "surrogates-by-text"), "__text_id", "__row")
    put = F.transform("__found", lambda e: F.element_at("__surrogates", e))
    parts = F.split(text, ENTITY, -1)
    words = lambda part: F.regexp_extract_all(part, F.lit(NAME), 0)

    def without_names(part: Column) -> Column:
        new = F.transform(words(part), lambda w: F.coalesce(_renamed(w), w))
        kept_parts = F.split(part, NAME, -1)
        return F.array_join(F.zip_with(kept_parts, F.concat(new, F.array(F.lit(""))), lambda b, w: F.concat(b, w)), "")

    has_names = F.col("__names").isNotNull()
    between = F.when(has_names, F.transform(parts, without_names)).otherwise(parts)
    untitled = F.flatten(F.transform(parts, lambda part: F.filter(words(part), lambda w: _renamed(w).isNotNull())))
    n_untitled = F.when(has_names, F.size(untitled)).otherwise(0)
    woven = F.zip_with(between, F.concat(put, F.array(F.lit(""))), lambda b, e: F.concat(b, e))
    out = joined.withColumn("__new", F.array_join(woven, "")).withColumn("n_entities", (F.size("__found") + n_untitled).cast("bigint"))
    replaced = out.select(*[F.col("__new").alias(c) if c == text else F.col(c) for c in own], "n_entities")
    return clean.unionByName(replaced)


def session_key(spark: SparkSession) -> str:
    """The session's key; a random one, kept for the session, where none is set."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def pii_report(docs: DataFrame, key: str | None = None) -> DataFrame:
    key = key or session_key(docs.sparkSession)
    return replace_entities(docs.select("doc_id", "text"), key).select("doc_id", "text", "n_entities")
