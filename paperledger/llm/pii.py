"""PII: detected entities get keyed surrogates of their type, script, gender and format.

A mention is found by pattern and taken apart: an e-mail address into user and host, a name into given name and surname,
an assignment of a secret into its name and its value. What must be replaced is an entity, (kind, value), in a common
form: lower case for addresses, digits only for numbers. A surrogate is drawn from SHA-512 of key, kind, value and
attempt, so an entity has one surrogate in all documents. Surrogates are checked: of several entities with one surrogate
the first keeps it, and none may equal an entity of its kind; the others draw again until nothing collides. Surrogates grow
with the attempts, so that it ends: after more attempts than the entities of a kind have digits hardly any draw collides.

Found are: e-mail addresses; phone numbers with + and country code, as (123) 456-7890 and as 123-456-7890; card numbers in four groups
of four, or 13 to 16 digits in a row with a valid check digit; IPv4 addresses; 123-45-6789; names behind a form of address;
AWS access keys and values assigned to a password, token, secret or key that hold a letter or digit. Not found are: names
without a form of address, phone numbers in other forms (+33 1 23 45 67 89, 555.123.4567, 1-555-123-4567), cards in other
groups, IPv6 addresses, postal addresses, dates of birth.

Surrogates keep the form: digits for digits, letters for letters of their case, hexadecimal for hexadecimal, country codes,
first digit and Luhn digit of cards, octets of addresses, `example` as domain, separators as written. Given names end by
gender, surnames too where the script's language does so. Gender comes from the form of address, else from the given name.

A null text stays null; texts without mentions stay as they are and are not shuffled. Rows that repeat are rewritten each.
Columns `n_entities` and `entity_types` replace others of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperledger.llm.words import text_or_empty
from paperledger.session import shared_dir

KEY = "surrogates-1"

# Forms of address by gender, and given names that tell a gender where the form of address does not.
FEMALE_FORMS = ("Mrs", "Ms", "Miss", "Mme", "Madame", "Frau", "Señora", "Sra", "г-жа", "госпожа", "κυρία")
MALE_FORMS = ("Mr", "Monsieur", "Herr", "Señor", "Sr", "г-н", "господин", "κύριος")
OTHER_FORMS = ("Dr", "Prof")
FEMALE_NAMES = ("Anna", "Anne", "Carmen", "Claire", "Emily", "Emma", "Eva", "Jane", "Julia", "Laura", "Lucía", "Maria", "María", "Marie", "Mary", "Sarah", "Sophie", "Susan")
MALE_NAMES = ("Carlos", "David", "Hans", "James", "Jean", "John", "José", "Juan", "Karl", "Luis", "Michael", "Paul", "Peter", "Pierre", "Robert", "Thomas", "William")

FORMS = "|".join(sorted(FEMALE_FORMS + MALE_FORMS + OTHER_FORMS, key=len, reverse=True))
NAME = r"\p{Lu}\p{Ll}+(?:[-'’]\p{Lu}\p{Ll}+)?"
SECRET_NAME = r"(?i:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
PATTERNS = {
    "secret": rf"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{{16}}(?![A-Za-z0-9])|{SECRET_NAME}(?=[_\-+/=.]*[A-Za-z0-9])[\w\-+/=.]{{5,}}[\w\-+/=]",
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]*+@[A-Za-z0-9][A-Za-z0-9.\-]*\.[A-Za-z]{2,}",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w.-])\d{3}-\d{3}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])(?:\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{13,16})(?![\w-])",
    "ipv4": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "name": rf"(?<![\p{{L}}])(?:{FORMS})\.? {NAME}(?: {NAME})?",
}
MENTION = "|".join(PATTERNS.values())
PART = "array<struct<kind:string,value:string,form:string>>"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Syllables that names are made of.
SYLLABLES = {
    "latin": ("bel", "cor", "dan", "fen", "gar", "hol", "ker", "lam", "mor", "nel", "per", "ros", "sil", "tor", "van", "wes"),
    "cyrillic": ("бел", "вол", "гор", "дан", "жар", "кор", "лав", "мор", "нов", "пет", "рад", "сол", "том", "фед", "шер", "яр"),
    "greek": ("αλεξ", "βασ", "γεωρ", "δημ", "ζαχ", "θεοδ", "καλ", "λαμ", "μαρ", "νικ", "παν", "ροδ", "στεφ", "τασ", "φιλ", "χρισ"),
}
ENDINGS = {
    ("latin", "given"): ("a", "in", "y"), ("latin", "surname"): ("ley", "ley", "ley"),
    ("cyrillic", "given"): ("а", "ей", "я"), ("cyrillic", "surname"): ("ова", "ов", "енко"),
    ("greek", "given"): ("ία", "ος", "η"), ("greek", "surname"): ("ίδου", "ίδης", "άκη"),
}


def mentions(text: Column) -> Column:
    """All mentions in a text. The full pattern runs only where a digit, a sign or a form of address can start one."""
    sign = text.rlike("[0-9@=:]")
    named = F.lit(False)
    for form in FEMALE_FORMS + MALE_FORMS + OTHER_FORMS:
        named = named | text.contains(f"{form} ") | text.contains(f"{form}. ")
    found = F.regexp_extract_all(text_or_empty(text), F.lit(MENTION), 0)
    return F.coalesce(F.when(sign | named, found), F.array().cast("array<string>"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def is_number(m: Column) -> Column:
    """A bare number of a card's length without a card's check digit: no entity."""
    return F.coalesce(F.when(m.rlike("^[0-9]{13,16}$"), _with_check(F.substring(m, F.lit(1), F.length(m) - 1)) != m), F.lit(False))


def kind_of(m: Column) -> Column:
    """The first pattern that the whole mention matches."""
    out = F.lit("name")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        out = F.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def parts(m: Column) -> Column:
    """A mention as pieces: kind (null: stays), value in its common form, and the form as written."""

    def piece(kind: Column | str | None, value: Column, form: Column) -> Column:
        kind = F.lit(kind).cast("string") if kind is None or isinstance(kind, str) else kind
        return F.struct(kind.alias("kind"), value.alias("value"), form.alias("form"))

    def keep(x: Column) -> Column:
        return piece(None, F.lit(""), x)

    user, host = F.lower(F.substring_index(m, "@", 1)), F.lower(F.substring_index(m, "@", -1))
    secret = F.regexp_extract(m, rf"^({SECRET_NAME}|)(.*)$", 2)
    country = F.regexp_extract(m, r"^(\+\d{1,3}[ .-]|\+\d{1,3}(?=\()|\+|)", 1)
    number = F.regexp_replace(m, r"^(\+\d{1,3}[ .-]|\+\d{1,3}(?=\()|\+|)", "")
    form = F.regexp_extract(m, rf"^((?:{FORMS})\.? )", 1)
    names = F.split(F.regexp_replace(m, rf"^(?:{FORMS})\.? ", ""), " ")
    title = F.regexp_extract(form, r"^([^. ]+)", 1)
    first = F.when(F.size(names) > 1, F.get(names, 0))
    gender = (
        F.when(title.isin(*FEMALE_FORMS) | (title.isin(*OTHER_FORMS) & F.coalesce(first.isin(*FEMALE_NAMES), F.lit(False))), "f")
        .when(title.isin(*MALE_FORMS) | (title.isin(*OTHER_FORMS) & F.coalesce(first.isin(*MALE_NAMES), F.lit(False))), "m").otherwise("n")
    )
    last = F.get(names, F.size(names) - 1)
    script = F.when(last.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(last.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")
    # Latin surnames have one form for all, so that Mr and Mrs of one name keep one.
    surname = F.concat_ws(":", F.lit("surname"), F.when(script == "latin", "n").otherwise(gender), script)
    given = F.concat_ws(":", F.lit("given"), gender, script)
    kind = kind_of(m)
    return (
        F.when(is_number(m), F.array(keep(m)))
        .when(kind == "email", F.array(piece("email_user", user, user), keep(F.lit("@")), piece("email_host", host, host)))
        .when(kind == "secret", F.array(keep(F.substring(m, F.lit(1), F.length(m) - F.length(secret))), piece("secret", secret, secret)))
        .when(kind == "phone", F.array(keep(country), piece("phone", _digits(number), number)))
        .when(kind.isin("card", "ssn"), F.array(piece(kind, _digits(m), m)))
        .when(kind == "ipv4", F.array(piece("ipv4", m, m)))
        .when(F.size(names) > 1, F.array(keep(form), piece(given, first, first), keep(F.lit(" ")), piece(surname, last, last)))
        .otherwise(F.array(keep(form), piece(surname, last, last)))
        .cast(PART)
    )


def _number(stream: Column, i: Column) -> Column:
    """The i-th byte of a stream of 64 in hexadecimal."""
    return F.conv(F.substring(stream, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _shaped(value: Column, stream: Column) -> Column:
    """Digits and ASCII letters replaced by others of their class."""

    def pick(alphabet: str, i: Column) -> Column:
        return F.substring(F.lit(alphabet), _number(stream, i) % len(alphabet) + 1, F.lit(1))

    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c.between("0", "9"), pick("0123456789", i))
                                    .when(c.between("a", "z"), pick(LOWER, i)).when(c.between("A", "Z"), pick(UPPER, i)).otherwise(c)), "")


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a number that still lacks its last digit."""
    n = F.length(digits)

    def share(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when((n - i) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), share), F.lit(0), lambda a, x: a + x)


def _with_check(digits: Column) -> Column:
    return F.concat(digits, ((10 - _luhn_sum(digits) % 10) % 10).cast("string"))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    seed = F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string"))
    stream = F.sha2(seed, 512)
    hexadecimal = F.substring(F.repeat(stream, F.ceil(F.length(value) / 128).cast("int")), F.lit(1), F.length(value))
    labels = F.split(value, r"\.")
    # The host's last label stays if it is a common one; `example` before it is reserved and belongs to nobody.
    top = F.when(F.element_at(labels, -1).isin("com", "net", "org"), F.element_at(labels, -1)).otherwise("org")
    own = F.array_join(F.array_remove(F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0))), "example"), ".")
    own = F.when(own == "", "host").otherwise(own)
    # After some attempts in vain more room is needed: a value grows by a place with each attempt, so that a space which entities
    # fill, however small its form makes it, is left behind. Numbers keep their length longer: they have a hundred million forms.
    more = F.substring(stream, F.lit(1), F.when(attempt > 3, attempt).otherwise(0))
    room = F.translate(F.substring(stream, F.lit(65), F.when(attempt > 16, attempt - 16).otherwise(0)), "abcdef", "012345")
    body = F.concat(F.substring(value, 1, 1), F.substring(_shaped(value, stream), F.lit(2), F.length(value) - 2))
    was_valid = _with_check(F.substring(value, F.lit(1), F.length(value) - 1)) == value
    card = F.when(was_valid, _with_check(body)).otherwise(F.concat(body, (_number(stream, F.lit(63)) % 10).cast("string")))
    ip = F.concat_ws(".", (_number(stream, F.lit(0)) % 223 + 1).cast("string"), *(_number(stream, F.lit(i)).cast("string") for i in (1, 2, 3)))
    names = F.lit(None).cast("string")
    for (script, what), endings in ENDINGS.items():
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        picked = F.transform(F.sequence(F.lit(1), 2 + attempt), lambda i: F.get(syllables, _number(stream, i) % 16))  # noqa: B023
        stem = F.array_join(picked, "")
        for gender, ending in zip("fmn", endings):
            names = F.when(kind == f"{what}:{gender}:{script}", F.initcap(F.concat(stem, F.lit(ending)))).otherwise(names)
    access = value.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$")
    return (
        F.when(kind == "email_user", F.concat(_shaped(value, stream), more))
        .when(kind == "email_host", F.concat(_shaped(own, stream), more, F.lit(".example."), top))
        .when(kind == "phone", F.concat(_shaped(value, stream), room))
        .when(kind == "card", F.concat(card, room))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(_shaped(value, stream), 2, 8), room))
        .when(kind == "ipv4", F.concat_ws(".", ip, F.nullif(room, F.lit(""))))
        .when((kind == "secret") & value.rlike("^(?=.*[0-9])[0-9a-f]{8,}$"), F.concat(hexadecimal, more))
        .when((kind == "secret") & value.rlike("^(?=.*[0-9])[0-9A-F]{8,}$"), F.upper(F.concat(hexadecimal, more)))
        .when((kind == "secret") & access, F.concat(F.substring(value, 1, 4), _shaped(F.substring(value, 5, 16), stream)))
        .when(kind == "secret", F.concat(_shaped(value, stream), more))
        .otherwise(names)
    )


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """kind, value, surrogate for distinct entities (kind, value); no two of a kind are alike, none is an entity itself."""
    shared_dir(entities.sparkSession)
    draw = surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key)
    drawn = entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw).checkpoint()
    originals = drawn.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("taken"))
    while True:
        place = F.row_number().over(W.partitionBy("kind", "surrogate").orderBy("attempt", "value"))
        judged = drawn.withColumn("place", place).join(originals, ["kind", "surrogate"], "left")
        judged = judged.withColumn("again", (F.col("place") > 1) | F.coalesce("taken", F.lit(False))).drop("place", "taken").checkpoint()
        if judged.filter("again").isEmpty():
            return judged.select("kind", "value", "surrogate")
        drawn = judged.withColumn("attempt", F.col("attempt") + F.col("again").cast("int"))
        drawn = drawn.withColumn("surrogate", F.when(F.col("again"), draw).otherwise(F.col("surrogate"))).drop("again").checkpoint()


def _poured(digits: Column, form: Column) -> Column:
    """The form as written with its digits replaced in order."""
    def put(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substring(form, F.lit(1), i + 1)))
        return F.when(c.between("0", "9"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    # A surrogate that had to grow is longer than the form.
    rest = F.substring(digits, F.length(_digits(form)) + 1, F.length(digits))
    return F.concat(F.array_join(F.transform(F.split(form, ""), put), ""), rest)


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The rows of docs with every mention in text replaced, n_entities, and entity_types in order of the text."""
    columns = [c for c in docs.columns if c not in ("n_entities", "entity_types")]
    text = F.col("row")["text"]
    rows = docs.select(F.struct(*columns).alias("row"))
    hit = F.exists(mentions(text), lambda m: ~is_number(m))
    hits = rows.filter(hit).select("row", mentions(text).alias("found"))
    hits = hits.select("row", "found", F.sha2(text, 256).alias("of"), F.flatten(F.transform("found", parts)).alias("parts"))

    def name(part: Column) -> Column:
        return F.concat(part["kind"], F.lit("\x1f"), part["value"])

    # Copies of a text are taken once; their rows join again by its hash.
    pieces = hits.select("of", F.explode(F.array_distinct("parts")).alias("part")).filter("part.kind IS NOT NULL")
    pieces = pieces.select("of", "part.kind", "part.value").distinct()
    given = surrogates(pieces.select("kind", "value").distinct(), key)
    known = pieces.join(given, ["kind", "value"]).groupBy("of").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat("kind", F.lit("\x1f"), "value"), "surrogate"))).alias("known"))

    def written(part: Column) -> Column:
        new = F.element_at(F.col("known"), name(part))
        poured = F.when(part["kind"].isin("phone", "card", "ssn"), _poured(new, part["form"])).otherwise(new)
        return F.when(part["kind"].isNull(), part["form"]).otherwise(poured)

    changed = hits.join(known, "of").select(
        "row", "found",
        F.transform("found", lambda m: F.array_join(F.transform(parts(m), written), "")).alias("new"),
        F.split(text, MENTION, -1).alias("gaps"),
    )
    rebuilt = F.array_join(F.flatten(F.zip_with("gaps", "new", lambda g, n: F.array(g, F.coalesce(n, F.lit(""))))), "")

    def result(df: DataFrame, new_text: Column, n: Column, kinds: Column) -> DataFrame:
        given = [new_text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in columns]
        return df.select(*given, n.cast("long").alias("n_entities"), kinds.alias("entity_types"))

    clean = rows.filter(~hit)
    entities = F.filter("found", lambda m: ~is_number(m))
    return result(clean, text, F.lit(0), F.array().cast("array<string>")).unionByName(
        result(changed, rebuilt, F.size(entities), F.transform(entities, kind_of)))
