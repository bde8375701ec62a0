"""Operator 4, personal data replaced by surrogates.

Entities are found by one regular expression and replaced where they stand by
a keyed surrogate of their kind. Everything is DataFrame expressions: a text
is split at its entities, the entities are transformed, and the parts put
together again. Persons are told by a form of address; a full name found
so is replaced in the rest of its document too, with or without one.

The same entity gets the same surrogate everywhere (coreference): it depends
on the key and the entity's canonical form alone, whatever its punctuation, case
or form of address. A person's given name and surname are replaced each by itself, so that
"Mr. John Smith", "John Smith" and "Mr. Smith" still share what they shared. A given
name's surrogate follows the gender that its form of address, or another mention in
the document, tells; with neither it is one of no gender.

Different entities get different surrogates (distinctness): numbers go through a
keyed permutation of all numbers of their format, which can't collide, and what a number's
format depends on (a phone's country, an account's country and letters) is kept;
all else are keyed hashes, and all distinct entities of the corpus are checked for
two with one surrogate, or a surrogate that is someone's entity. While there is
one, all hashed surrogates are made anew in a longer form; if the longest has one still, the run fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import documents, own_names, without

KEY = "surrogate-key-1"

#: Forms of address that tell a name, by the gender they tell. Fixed values.
TITLES = {
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sir", "господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Lady", "госпожа", "Κυρία"),
    "n": ("Dr", "Doctor", "Prof", "Professor", "доктор", "профессор"),
}
#: Letters of made-up names by script: sixteen consonants, four vowels, and four endings of given names by gender. Fixed values.
LETTERS = {
    "latin": ("bdfgklmnprstvzhj", "aeio", {"m": ("us", "an", "or", "in"), "f": ("ina", "ela", "ana", "ia"), "n": ("is", "el", "en", "y")}),
    "cyrillic": ("бвгдзклмнпрстфхж", "аеио", {"m": ("ан", "ор", "ий", "ек"), "f": ("ина", "ела", "ана", "ия"), "n": ("ель", "ень", "эль", "ись")}),
    "greek": ("βγδζθκλμνπρστφχψ", "αειο", {"m": ("ος", "ης", "ας", "ων"), "f": ("ινα", "ελα", "ανα", "ια"), "n": ("ις", "ι", "ε", "ω")}),
}
#: First character class of a script, as the regular expressions of Java name it.
SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}
#: Country calling codes of one and two digits; all others have three. Fixed values (E.164).
CALLING = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
#: What access tokens begin with. Fixed values.
TOKENS = "AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|sk-|xox[abeprs]-|eyJ"

def _any_case(titles: tuple[str, ...]) -> str:
    """Forms of address as they are and in capitals."""
    return "|".join(dict.fromkeys(x for t in titles for x in (t, t.upper())))


_TITLE = _any_case(tuple(t for names in TITLES.values() for t in names))
#: Tells at one look whether a form of address can begin here.
_FIRST = f"(?=[{''.join(sorted({t[0] for names in TITLES.values() for t in names}))}])"
#: A capitalized word; an apostrophe belongs to it between letters, but for a possessive s.
_NAME = r"\p{Lu}(?:[\p{L}-]|['’](?=\p{L})(?![sS](?!\p{L})))++"
#: Kind of entity to its pattern, in order of precedence.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,24}",
    "token": r"(?<![A-Za-z0-9_-])(?:A[KS]IA[0-9A-Z]{16}|AIza[0-9A-Za-z_-]{35}|gh[pousr]_[A-Za-z0-9]{36,}+|github_pat_[A-Za-z0-9_]{22,}+|glpat-[A-Za-z0-9_-]{20,}+|sk-[A-Za-z0-9_-]{20,}+|xox[abeprs]-[A-Za-z0-9-]{10,}+|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)(?![A-Za-z0-9_-])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?=(?:[ A-Z]{0,6}\d){8})(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![A-Za-z0-9])",
    "ipv6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]{0,39}\d)[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "phone": r"(?<![\w+])\+(?=(?:[ .()-]{0,2}\d){8})\d{1,4}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){1,5}(?!\w)|(?<![\w+.-])(?:\(\d{3}\)[ .-]?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\w|[.-]\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "person": rf"{_FIRST}(?<![\p{{L}}])(?:(?:{_TITLE})\.? ){{1,2}}{_NAME}(?: {_NAME})?",
}
ENTITY = "|".join(PATTERNS.values())
#: A cheap test that any text with an entity passes.
HINT = rf"[0-9@]|sk-|xox|eyJ|glpat|github_pat|{_FIRST}(?:{_TITLE})\.? \p{{Lu}}"
#: Kinds whose surrogates are hashes; so are persons', by their parts.
HASHED = ("email", "token", "secret", "ipv6")
#: Surrogates can be made longer so many times.
LONGEST = 12

_STRINGS = "array<string>"
_none = lambda: F.array().cast(_STRINGS)


def find(text: Column, pattern: Column | None = None) -> Column:
    """All entities of a text in order, as an array (empty for a null text)."""
    pattern = F.lit(ENTITY) if pattern is None else pattern
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.concat(F.lit("("), pattern, F.lit(")")), F.lit(1))).otherwise(_none())


def kind_of(entity: Column) -> Column:
    out = F.lit("person")
    for kind in reversed([k for k in PATTERNS if k != "person"]):
        out = F.when(entity.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def bare_name(person: Column) -> Column:
    return F.regexp_replace(person, rf"^(?:(?:{_TITLE})\.? ){{1,2}}(?=\p{{Lu}})", "")


def _told(person: Column, gender: str) -> Column:
    """Whether a mention's form of address tells this gender."""
    return person.rlike(rf"^(?:(?:{_TITLE})\.? )?(?:{_any_case(TITLES[gender])})\.? ")


def names_told(found: Column, gender: str | None = None) -> Column:
    """Full names among the entities found, of one gender where one is asked for."""
    persons = F.filter(found, lambda e: e.rlike(rf"^(?:{_TITLE})\b.* \S+ \S") & (F.lit(True) if gender is None else _told(e, gender)))
    return F.array_distinct(F.filter(F.transform(persons, bare_name), lambda n: n.contains(" ")))


def _groups(address: Column) -> Column:
    """The eight groups of an IPv6 address, without leading zeros."""
    half = lambda x: F.filter(F.split(x, ":"), lambda g: g != "")
    left, right = half(F.substring_index(address, "::", 1)), half(F.when(address.contains("::"), F.substring_index(address, "::", -1)).otherwise(""))
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right)))
    return F.transform(F.concat(left, zeros, right), lambda g: F.regexp_replace(g, "^0+(?=.)", ""))


def canonical(entity: Column, kind: Column) -> Column:
    """The form that tells whether two mentions mean the same.

    A national phone number of three, three and four digits is the one with country code 1.
    """
    digits = F.regexp_replace(entity, "[^0-9]", "")
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.concat(F.when(entity.startswith("+"), "").otherwise("1"), digits))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "ipv6", F.array_join(_groups(F.lower(entity)), ":"))
        .when(kind == "token", entity)
        .when(kind == "person", F.lower(F.translate(bare_name(entity), "’", "'")))
        .otherwise(F.lower(entity))
    )


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *[p.cast("string") for p in parts]), 256)


def _number(digest: Column, at: int = 1) -> Column:
    """Fifteen hexadecimal digits of a digest as a long."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def _power(digits: Column) -> Column:
    return F.get(F.array(*[F.lit(10**k).cast("long") for k in range(0, 18)]), digits)


def permuted(number: Column, key: str, kind: Column) -> Column:
    """A keyed permutation of the decimal strings of each length (2 to 34 digits), another for each kind.

    A Feistel network over the two halves: each of six rounds adds a keyed
    hash of one half to the other, modulo that half's size, so it can be
    undone and no two strings share a result.
    """
    size = F.length(number)
    first = F.floor(size / 2).cast("int")
    # The state carries all that a round needs, so nothing is computed twice.
    start = F.struct(
        F.substring(number, F.lit(1), first).cast("long").alias("l"),
        F.substring(number, first + 1, size).cast("long").alias("r"),
        first.alias("n"),
        (size - first).cast("int").alias("m"),
    )

    def turn(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        push = _number(_digest(F.lit(key), kind, state["n"], state["m"], i, F.when(even, state["r"]).otherwise(state["l"])))
        return F.struct(
            F.when(even, F.pmod(state["l"] + push, _power(state["n"]))).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(F.pmod(state["r"] + push, _power(state["m"]))).alias("r"),
            state["n"].alias("n"),
            state["m"].alias("m"),
        )

    pad = lambda x, n: F.lpad(x.cast("string"), n, F.lit("0"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(5)), start, turn, lambda s: F.concat(pad(s["l"], s["n"]), pad(s["r"], s["m"])))


def _luhn(payload: Column) -> Column:
    """The check digit that follows a string of digits."""
    digits = F.reverse(F.split(payload, ""))
    total = F.aggregate(
        F.transform(digits, lambda d, i: F.when(i % 2 == 0, F.when(2 * d.cast("int") > 9, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))).otherwise(d.cast("int"))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return F.pmod(-total, F.lit(10))


def _iban_check(country: Column, account: Column) -> Column:
    """The check number that an account of a country must have."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(
        F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0),
        lambda a, c: F.pmod(a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c), F.lit(97)),
    )
    return 98 - rest


def _in_shape(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in turn."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), digits.alias("d"))

    def put(state: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(state["out"], F.when(is_digit, F.substring(state["d"], state["at"], F.lit(1))).otherwise(c)).alias("out"),
            (state["at"] + is_digit.cast("int")).alias("at"),
            state["d"].alias("d"),
        )

    return F.aggregate(F.split(shape, ""), start, put, lambda s: s["out"])


_HEX = "0123456789abcdef"
_SIXTEEN = "abcdefghijkmnprs"


def _letters(hexadecimal: Column) -> Column:
    return F.translate(hexadecimal, _HEX, _SIXTEEN)


def _same_classes(shape: Column, digest: Column) -> Column:
    """``shape`` with each digit, small and large letter replaced by one of its class, by a digest's digits."""
    digits = F.concat(digest, _digest(digest))

    def put(c: Column, i: Column) -> Column:
        digit = F.substring(digits, F.pmod(i, F.lit(128)) + 1, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), F.translate(digit, "abcdef", "012345"))
            .when(c.rlike("[a-z]"), _letters(digit))
            .when(c.rlike("[A-Z]"), F.upper(_letters(digit)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(shape, ""), put), "")


def _syllables(digest: Column, script: str, count: int) -> Column:
    """Syllables of a consonant and a vowel, six bits of the digest each."""
    consonants, vowels, _ = LETTERS[script]
    parts = []
    for k in range(count):
        parts.append(F.translate(F.substring(digest, 2 * k + 1, 1), _HEX, consonants))
        parts.append(F.translate(F.substring(digest, 2 * k + 2, 1), _HEX, vowels * 4))
    return F.concat(*parts)


def _by_script(name: Column, made: dict[str, Column]) -> Column:
    out = made["latin"]
    for script, letters in SCRIPTS.items():
        out = F.when(name.rlike("^" + letters), made[script]).otherwise(out)
    return out


def surname(name: Column, own: Column, attempt: int) -> Column:
    return F.initcap(_by_script(name, {script: _syllables(own, script, 6 + 2 * attempt) for script in LETTERS}))


def given_name(name: Column, gender: Column, own: Column, attempt: int) -> Column:
    made = {}
    for script, (consonants, _, endings) in LETTERS.items():
        last = F.translate(F.substring(own, 63, 1), _HEX, consonants)
        pick = F.translate(F.substring(own, 64, 1), _HEX, "0123" * 4).cast("int")
        ends = {g: F.get(F.array(*[F.lit(e) for e in endings[g]]), pick) for g in endings}
        ending = F.when(gender == "f", ends["f"]).when(gender == "m", ends["m"]).otherwise(ends["n"])
        made[script] = F.concat(_syllables(own, script, 3 + 2 * attempt), last, ending)
    return F.initcap(_by_script(name, made))


def _cased(entity: Column, made: Column) -> Column:
    return F.when((entity == F.upper(entity)) & (F.length(entity) > 1), F.upper(made)).otherwise(made)


def marked(found: Column, key: str, attempt: int, women: Column, men: Column) -> Column:
    """Entities as structs of all that their surrogates are made of; e, kind, gender and form (canonical) among it.

    ``women`` and ``men``: full names of which the document tells a gender.
    Each step adds fields made of those before it, so nothing is computed twice.
    """
    known: list[str] = ["e"]

    def more(array: Column, make) -> Column:
        def put(x: Column) -> Column:
            new = make(x)
            fields = [x[c].alias(c) for c in known if c not in new] + [v.alias(c) for c, v in new.items()]
            return F.struct(*fields)

        out = F.transform(array, put)
        known.extend(c for c in make({c: F.lit("") for c in known}) if c not in known)
        return out

    def gender(x) -> Column:
        return (
            F.when(x["kind"] != "person", "")
            .when(_told(x["e"], "f"), "f").when(_told(x["e"], "m"), "m")
            .when(F.array_contains(women, x["name"]), "f").when(F.array_contains(men, x["name"]), "m")
            .otherwise("n")
        )

    def body(x) -> Column:
        rest = F.substring(x["form"], F.length(x["code"]) + 1, F.length(x["form"]))
        return (
            F.when(x["kind"] == "card", F.substring(rest, F.lit(1), F.length(rest) - 1))
            .when(x["kind"] == "iban", F.regexp_replace(rest, "[^0-9]", ""))
            .when(x["kind"].isin("phone", "ssn"), rest)
        )

    own = lambda *parts: _digest(F.lit(key), F.lit(attempt), *parts)
    out = F.transform(found, lambda e: F.struct(e.alias("e")))
    out = more(out, lambda x: {"kind": kind_of(x["e"])})
    out = more(out, lambda x: {"name": bare_name(x["e"]), "form": canonical(x["e"], x["kind"])})
    out = more(out, lambda x: {
        "gender": gender(x), "first": F.substring_index(x["name"], " ", 1), "last": F.substring_index(x["name"], " ", -1),
        # What a number's surrogate keeps: a phone's country, told by the canonical digits alone, an account's country and check.
        "code": F.when(x["kind"] == "phone", F.regexp_extract(x["form"], rf"^(?:{CALLING}|\d{{3}})", 0)).when(x["kind"] == "iban", F.substring(x["form"], 1, 4)).otherwise(""),
    })
    out = more(out, lambda x: {
        "own": own(x["kind"], x["form"]), "domain": own(F.lit("domain"), F.substring_index(x["form"], "@", -1)),
        "own_first": own(F.lit("given"), x["gender"], F.lower(x["first"])), "own_last": own(F.lit("surname"), F.lower(x["last"])), "body": body(x), "salt": F.lit(key),
    })
    out = more(out, lambda x: {"body": F.when(F.length(x["body"]) > 1, permuted(x["body"], key, x["kind"])).otherwise(x["body"])})
    return more(out, lambda x: {"account": F.when(x["kind"] == "iban", _in_shape(F.substring(x["form"], F.lit(5), F.length(x["form"])), x["body"]))})


def surrogate(mark: Column, attempt: int = 0) -> Column:
    """The replacement of a marked entity: same kind, shape, case, and for names gender and script."""
    entity, kind, form, own, domain, body, code = (mark[c] for c in ("e", "kind", "form", "own", "domain", "body", "code"))
    # Cards keep whether their check digit is right; so do accounts.
    check = F.right(form, F.lit(1)).cast("int") - _luhn(F.substring(form, F.lit(1), F.length(form) - 1)) + _luhn(body)
    card = F.concat(body, F.pmod(check, F.lit(10)).cast("string"))
    country = F.substring(code, 1, 2)
    check = F.substring(code, 3, 2).cast("int") - _iban_check(country, F.substring(form, F.lit(5), F.length(form))) + _iban_check(country, mark["account"])
    iban = F.concat(F.lpad(F.pmod(check, F.lit(100)).cast("string"), 2, "0"), body)
    phone = F.concat(F.when(entity.startswith("+"), code).otherwise(""), body)
    number = F.when(kind == "card", card).when(kind == "iban", iban).when(kind == "phone", phone).otherwise(body)
    # Two half addresses, five digits each, would not be a permutation of addresses: mix 16 bits with 16.
    octets = F.transform(F.split(entity, r"\."), lambda o: o.cast("long"))
    key = F.lit("octets")
    ip = F.aggregate(
        F.sequence(F.lit(0), F.lit(5)),
        F.struct((F.get(octets, F.lit(0)) * 256 + F.get(octets, F.lit(1))).alias("l"), (F.get(octets, F.lit(2)) * 256 + F.get(octets, F.lit(3))).alias("r")),
        lambda s, i: F.struct(
            F.when(i % 2 == 0, F.pmod(s["l"] + _number(_digest(mark["salt"], key, i, s["r"])), F.lit(65536))).otherwise(s["l"]).alias("l"),
            F.when(i % 2 == 1, F.pmod(s["r"] + _number(_digest(mark["salt"], key, i, s["l"])), F.lit(65536))).otherwise(s["r"]).alias("r"),
        ),
        lambda s: F.concat_ws(".", *[x.cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)]),
    )
    email = F.concat(_letters(F.substring(own, 1, min(64, 20 + 4 * attempt))), F.lit("@"), _letters(F.substring(domain, 1, min(60, 16 + 4 * attempt))), F.lit(".example.com"))
    secret = F.substring(F.concat(own, _digest(own)), F.lit(1), F.length(entity))
    prefix = F.regexp_extract(entity, f"^(?:{TOKENS})", 0)
    token = F.concat(prefix, _same_classes(F.substring(entity, F.length(prefix) + 1, F.length(entity)), own))
    ipv6 = F.concat_ws(":", F.lit("2001"), F.lit("db8"), *[F.substring(own, 4 * k + 1, 4) for k in range(6)])

    name, first, last = mark["name"], mark["first"], mark["last"]
    title = F.substring(entity, F.lit(1), F.length(entity) - F.length(name))
    new_last = _cased(last, surname(last, mark["own_last"], attempt))
    full = F.concat(_cased(first, given_name(first, mark["gender"], mark["own_first"], attempt)), F.lit(" "), new_last)
    person = F.concat(title, F.when(name.contains(" "), full).otherwise(new_last))
    return (
        F.when(kind.isin("card", "iban", "phone", "ssn"), _in_shape(entity, number))
        .when(kind == "person", person).when(kind == "email", _cased(entity, email)).when(kind == "secret", _cased(entity, secret))
        .when(kind == "ip", ip).when(kind == "token", token).when(kind == "ipv6", _cased(entity, ipv6))
    )


def collisions(df: DataFrame, key: str, attempt: int) -> int:
    """Distinct hashed entities of ``df``'s texts that share a surrogate, or whose surrogate is another's entity.

    Persons count by their parts, a given name for each gender. A null text
    has no entities; an empty table has no collisions.
    """
    found = df.select(find(F.col("text").cast("string")).alias("f"))
    found = found.select(F.explode("f").alias("e"), names_told(F.col("f"), "f").alias("women"), names_told(F.col("f"), "m").alias("men"))
    # One row for each mention and what its document tells of it; everything else is over those.
    name = bare_name(F.col("e"))
    told = F.when(F.array_contains("women", name), "f").when(F.array_contains("men", name), "m").otherwise("")
    mentions = found.groupBy("e", told.alias("told")).agg(F.lit(1).alias("one"))
    list_of = lambda g: F.when(F.col("told") == g, F.array(name)).otherwise(_none())
    marks = mentions.select(F.explode(marked(F.array("e"), key, attempt, list_of("f"), list_of("m"))).alias("x"))
    kind, gender, first, last = (F.col(f"x.{c}") for c in ("kind", "gender", "first", "last"))
    marks = marks.where(kind.isin(*HASHED, "person")).withColumn("made", surrogate(F.col("x"), attempt))
    row = lambda k, form, new: F.struct(k.alias("kind"), F.lower(form).alias("form"), F.lower(new).alias("new"))
    whole = F.struct(kind.alias("kind"), F.col("x.form").alias("form"), canonical(F.col("made"), kind).alias("new"))
    surnames = row(F.lit("surname"), last, surname(last, F.col("x.own_last"), attempt))
    given = row(F.concat(F.lit("given "), gender), first, given_name(first, gender, F.col("x.own_first"), attempt))
    parts = F.when(kind != "person", F.array(whole)).when(F.col("x.name").contains(" "), F.array(surnames, given)).otherwise(F.array(surnames))
    both = marks.select(F.inline(parts)).distinct()
    sides = both.select("kind", F.explode(F.array(F.struct(F.col("new").alias("value"), F.col("form").alias("of"), F.lit(1).alias("made")), F.struct(F.col("form").alias("value"), F.col("form").alias("of"), F.lit(0).alias("made")))).alias("s"))
    seen = sides.groupBy("kind", "s.value").agg(F.min("s.of").alias("least"), F.max("s.of").alias("most"), F.max("s.made").alias("made"))
    return seen.where((F.col("made") == 1) & (F.col("least") != F.col("most"))).count()


def _replaced(df: DataFrame, key: str, attempt: int) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` under names of its own with the new texts and ``_kinds``, and each old column by its new name."""
    while collisions(df, key, attempt):
        attempt += 1
        if attempt > LONGEST:
            raise RuntimeError("surrogates collide in their longest form: use another key")
    base, own = own_names(df, "doc_id", "text")
    text = F.col("text")
    out = base.withColumn("_told", find(text))
    out = out.withColumns({"_names": names_told(F.col("_told")), "_women": names_told(F.col("_told"), "f"), "_men": names_told(F.col("_told"), "m")})
    # Full names hold letters, apostrophes and hyphens only, so they are patterns of themselves.
    untitled = F.concat(F.lit(ENTITY + r"|(?<![\p{L}])(?:"), F.array_join("_names", "|"), F.lit(r")(?![\p{L}])"))
    again = F.size("_names") > 0
    out = out.withColumn("_pattern", F.when(again, untitled).otherwise(F.lit(ENTITY)))
    out = out.withColumn("_found", F.when(again, find(text, F.col("_pattern"))).otherwise(F.col("_told")))
    some = F.size("_found") > 0
    out = out.withColumns({
        "_gaps": F.when(some, F.split(text, F.col("_pattern"))),
        "_marks": marked(F.col("_found"), key, attempt, F.col("_women"), F.col("_men")),
    })
    out = out.withColumns({
        "_new": F.transform("_marks", lambda x: surrogate(x, attempt)),
        "_kinds": F.transform("_marks", lambda x: x["kind"]),
    })
    joined = F.concat_ws("", F.transform("_gaps", lambda g, i: F.concat(g, F.coalesce(F.get("_new", i), F.lit("")))))
    out = out.withColumn("text", F.when(some, joined).otherwise(text))
    if "n_chars" in own:
        own["n_chars"] = F.when(F.size("_kinds") > 0, F.length("text").cast("long")).otherwise(own["n_chars"]).alias("n_chars")
    return out, own


def with_surrogates(df: DataFrame, key: str = KEY, attempt: int = 0) -> DataFrame:
    """``df`` with its texts' entities replaced, and ``entities``, the kinds found in order.

    A null text stays null and has no entities; texts without entities stay
    as they are, to the byte. n_chars, where there is such a column, follows the
    new text. Repeated rows are answered one for one; a column of ``df``
    called entities is replaced, all others pass through; an empty table gives no rows.
    ``attempt``: how much longer than usual (below zero: shorter) hashed surrogates are at first.
    """
    out, own = _replaced(without(df, "entities"), key, attempt)
    return out.select(*own.values(), F.col("_kinds").alias("entities"))


def replace_entities(df: DataFrame, key: str = KEY) -> DataFrame:
    """``df`` with its texts' entities replaced as in ``with_surrogates``; no other column changes but n_chars."""
    out, own = _replaced(df, key, 0)
    return out.select(*own.values())


def op4_pii(spark, sf_dir: str) -> DataFrame:
    found = with_surrogates(documents(spark, sf_dir))
    return found.select("doc_id", "text", F.size("entities").alias("n_entities"), F.array_join("entities", ",").alias("kinds"))
