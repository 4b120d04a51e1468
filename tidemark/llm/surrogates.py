"""Surrogates for personal data, in DataFrame functions only.

One pattern finds the entities of a text in order; a text is cut at them and put
together again with the surrogates in between.  A surrogate is drawn from a hash of
key, kind, entity and attempt and keeps the entity's kind and format: separators,
letter case, country code, top-level domain, card issuer and whether the Luhn sum or
an account number's check digits hold, script and gender of a name.  Surrogates are
made per distinct entity of the corpus, so mentions corefer; those that equal another
surrogate or a real entity are drawn again until all differ.  A name that a form of
address shows is replaced wherever its text says it again without one, even where a word
that is a name, too (Will, May), stands for something else.

What isn't found: names that no form of address precedes in their text, a name in other
letter case than beside its form of address, IPv6 addresses that begin with colons, and what is
longer than its kind can be (64 characters before an @, 128 of a hexadecimal key, 64
after a key's prefix, 41 letters in a part of a name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, row_key

# Forms of address by gender, in the languages of the corpus.
MALE = ("Mr", "Sir", "Herr", "Señor", "Sr", "Monsieur", "Signor", "г-н", "господин", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Signora", "г-жа", "госпожа", "κυρία")
OTHER = ("Dr", "Prof")

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# National numbers: with a trunk zero in pairs, in one run or as area code and number
# (nine digits at least), North American with spaces, Spanish.
_NATIONAL = (
    r"(?<![0-9][ .,/:-])(?:0[1-9](?:(?: [0-9]{2}){4}|(?:\.[0-9]{2}){4}|(?:-[0-9]{2}){4}|[0-9]{8,10})"
    r"|(?=(?:[ ()/-]{0,3}[0-9]){9})(?:\(0[1-9][0-9]{0,4}\) ?|0[1-9][0-9]{1,4}(?: ?[/-] ?| )|0[26] )[1-9][0-9]{1,8}(?:[ -][0-9]{2,5}){0,3}"
    r"|[2-9][0-9]{2} [2-9][0-9]{2}[ -][0-9]{4}|[6-9][0-9]{2} (?!000)[0-9]{3} (?!000)[0-9]{3}(?![ .]?[0-9]{3})|[6-9][0-9]{2}(?: [0-9]{2}){3}|9[0-9] [0-9]{3}(?: [0-9]{2}){2})"
)
# A local number is told by the word before it.
_LOCAL = r"(?<=\b(?:[Tt]el|[Pp]hone|[Cc]all|[Ff]ax)[.:]? )[2-9][0-9]{2}-[0-9]{4}(?!-)"
_TITLES = MALE + FEMALE + OTHER
_TITLE = "(?:" + "|".join(_TITLES) + r")\.?\s"
#: A capitalised word with inner capitals, hyphens and apostrophes, or an initial before another.
_NAME = r"(?:\p{Lu}\.(?=\s\p{Lu})|\p{Lu}(?:['’]\p{Lu})?[\p{L}\p{M}]{1,40}(?:-[\p{L}\p{M}]{1,40}|['’][\p{L}\p{M}]{2,40}){0,4})"
_INITIALS = "".join(sorted({x[0] for x in _TITLES}))
#: A title that is told by its first character at nearly all positions.
_ANY_TITLE = rf"[{_INITIALS}](?<!\p{{L}}.)(?:" + "|".join(f"(?<={i})(?:{'|'.join(x[1:] for x in _TITLES if x[0] == i)})" for i in _INITIALS) + r")\.?\s"
#: Kind and pattern, in the order in which they are tried at a position.  Each starts
#: with what fails fastest: most positions are left after a look at one character.
KINDS = {
    "email": r"[\p{L}\p{M}0-9._%+-]{1,64}+@(?:[\p{L}\p{M}0-9-]{1,63}\.){1,8}\p{L}{2,24}(?![\p{L}0-9])",
    "ip": rf"(?=[0-9])(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9])(?!\.[0-9])",
    "ip6": r"[0-9A-Fa-f](?<![\p{L}0-9:.].)(?=[0-9A-Fa-f:]{0,40}[0-9]|(?<=[0-9]))(?:[0-9A-Fa-f]{2,3}:(?:[0-9A-Fa-f]{1,4}:){0,5}(?::[0-9A-Fa-f]{1,4}){1,6}|[0-9A-Fa-f]{0,3}:(?:[0-9A-Fa-f]{1,4}:){6}[0-9A-Fa-f]{1,4})(?![\p{L}0-9:])",
    "iban": r"[A-Z]{2}[0-9]{2}(?<![A-Za-z0-9]....)(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?=[0-9])(?<![0-9+.])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])",
    "ssn": r"(?=[0-9])(?<![0-9-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|(?<![0-9][ .,/:])(?!000|666|9)[0-9]{3} (?!00)[0-9]{2} (?!0000)[0-9]{4}(?! ?[0-9]))(?![0-9-])",
    "phone": rf"(?=[0-9+(])(?<![0-9+])(?:{_NATIONAL}|{_LOCAL}|00[1-9][0-9]{{0,2}}(?:[ .-]?[0-9]{{2,4}}){{3,5}}|\+[1-9][0-9]{{0,2}}[ .-]?(?:\([0-9]{{1,4}}\)[ .-]?)?[0-9]{{1,4}}(?:[ .-]?[0-9]{{2,4}}){{1,4}}|(?:\([2-9][0-9]{{2}}\) ?|[2-9][0-9]{{2}}[.-])[0-9]{{3}}[ .-][0-9]{{4}})(?![0-9])",
    "hex": r"(?:[0-9a-f](?=[0-9a-f]{31})|[0-9A-F](?=[0-9A-F]{31}))(?<![A-Za-z0-9].)(?:[0-9a-f]{31,127}|[0-9A-F]{31,127})(?![A-Za-z0-9])",
    "secret": r"(?:AKIA(?<![A-Za-z0-9]....)[0-9A-Z]{16}|gh[pousr]_(?<![A-Za-z0-9]....)[A-Za-z0-9]{36}|sk-(?<![A-Za-z0-9]...)[A-Za-z0-9]{20,64}|xox[abprs]-(?<![A-Za-z0-9].....)[A-Za-z0-9-]{10,64})(?![A-Za-z0-9])",
    # further words of a name start where the word before them (no key in capitals) was found
    "name": rf"{_ANY_TITLE}(?:(?:{'|'.join(OTHER)})\.?\s)*{_NAME}|\G(?<=\s\p{{Lu}}[\p{{L}}\p{{M}}'’.-]{{1,220}})(?<![A-Z]{{16}})\s{_NAME}",
}
_NUMERIC = ("ip", "card", "ssn", "phone")
PATTERN = "|".join([KINDS["email"], "(?=[0-9+(])(?:" + "|".join(KINDS[k] for k in _NUMERIC) + ")", *[v for k, v in KINDS.items() if k not in (*_NUMERIC, "email")]])
#: What a text with an entity has: a digit, an @, a title or the start of a key.
MAY = r"[0-9@]|AKIA[A-Z]{16}|gh[pousr]_[A-Za-z]{36}|sk-[A-Za-z]{20}|xox[abprs]-[A-Za-z-]{10}|[a-f]{32}|[A-F]{32}"
#: Attempts at a surrogate of the same length, and at any.
ROOMY, ATTEMPTS = 8, 64
KEY = "tidemark-demo-key"


def _kind(m: Column) -> Column:
    out = F.when(m.contains("@"), "email")
    for k in list(KINDS)[1:-1]:
        out = out.when(m.rlike(rf"\A(?:{KINDS[k]})\z"), k)
    return out.when(m.rlike(r"\A[0-9]{3}-[0-9]{4}\z"), "phone").otherwise("name")  # a local number stands behind a word that isn't part of it


def _pick(seed: Column, i: Column | int, n: Column | int) -> Column:
    return F.pmod(F.xxhash64(seed, F.lit(i) if isinstance(i, int) else i), F.lit(n).cast("long") if isinstance(n, int) else n.cast("long")).cast("int")


def _char(alphabet: str, seed: Column, i: Column) -> Column:
    return F.substring(F.lit(alphabet), _pick(seed, i, len(alphabet)) + 1, F.lit(1))


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _chars(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substring(value, i, F.lit(1)))


def _shaped(value: Column, seed: Column, digits: str = _DIGITS, lower: str = _LOWER, upper: str = _UPPER) -> Column:
    """``value`` with every digit and cased letter drawn anew from ASCII; all else stays."""

    def one(c: Column, i: Column) -> Column:
        return F.when(c.rlike("[0-9]"), _char(digits, seed, i)).when(c.rlike(r"\p{Ll}"), _char(lower, seed, i)).when(c.rlike(r"\p{Lu}"), _char(upper, seed, i)).otherwise(c)

    return F.when(F.length(value) == 0, "").otherwise(F.array_join(F.transform(_chars(value), one), ""))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits."""
    n = F.length(digits)

    def add(s: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return s + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(value: Column, seed: Column) -> Column:
    body = F.concat(F.substring(value, 1, 1), _shaped(F.expr("substring(value, 2, length(value) - 2)"), seed))
    last = F.pmod(10 - _luhn(F.concat(F.regexp_replace(body, "[^0-9]", ""), F.lit("0"))), F.lit(10))
    valid = _luhn(F.regexp_replace(value, "[^0-9]", "")) % 10 == 0
    return F.concat(body, F.when(valid, last).otherwise((last + 1 + _pick(seed, -1, 9)) % 10).cast("string"))


def _mod97(value: Column) -> Column:
    """An account number's remainder, its first four characters moved to the end and letters read as 10 to 35."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    step = lambda m, c: F.when(c.rlike("[0-9]"), (m * 10 + c.try_cast("int")) % 97).otherwise((m * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(_chars(turned), F.lit(0), step)


def _iban(value: Column, seed: Column) -> Column:
    """Country and form stay; check digits hold if they did."""
    rest = _shaped(F.expr("substring(value, 5)"), seed)
    country = F.substring(value, 1, 2)
    right = 98 - _mod97(F.concat(country, F.lit("00"), rest))
    check = F.when(_mod97(value) == 1, right).otherwise(2 + (right + _pick(seed, -1, 96) - 1) % 97)
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), rest)


# Syllables by script, with endings that sound female, male and open.
SYLLABLES = {
    "Latin": ("b c d f g h k l m n p r s t v z".split(), "a e i o u".split(), ("a", "en", "o")),
    "Cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у".split(), ("а", "ен", "о")),
    "Greek": ("β γ δ ζ θ κ λ μ ν ξ π ρ σ τ φ χ".split(), "α ε ι ο υ".split(), ("α", "ος", "ι")),
}


def _name(value: Column, gender: Column, seed: Column) -> Column:
    """A capitalised invented name of as many syllables, more with every few attempts."""

    def made(script: str) -> Column:
        first, vowels, ends = SYLLABLES[script]
        syllables = [c + v for c in first for v in vowels]
        n = F.least(F.greatest(F.ceil(F.length(value) / 2).cast("int"), F.lit(2)), F.lit(6)) + F.floor(F.col("attempt") / 4).cast("int")
        body = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(F.array(*map(F.lit, syllables)), _pick(seed, i, len(syllables)) + 1)), "")
        last = F.element_at(F.array(*map(F.lit, first)), _pick(seed, -1, len(first)) + 1)
        return F.initcap(F.concat(body, last, F.when(gender == "f", ends[0]).when(gender == "m", ends[1]).otherwise(ends[2])))

    return F.when(value.rlike(r"\p{IsCyrillic}"), made("Cyrillic")).when(value.rlike(r"\p{IsGreek}"), made("Greek")).otherwise(made("Latin"))


def _draw(entities: DataFrame, key: str) -> DataFrame:
    """Add ``surrogate`` to ``kind``, ``value``, ``gender``, ``attempt``."""
    value = F.col("value")
    seeded = entities.select(
        "*", F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", value, F.col("attempt").cast("string")), 256).alias("__seed"),
        F.regexp_extract(value, r"@(.*)\.[^.]+$", 1).alias("__domain"),
        F.regexp_extract(value, r"^(?:(?:\+|00)(?:1|[0-9]{1,3}(?=[ .(-])|[0-9]{2})|\(?0)?[ .(-]*", 0).alias("__code"),
    )
    seed = F.col("__seed")
    # forms of few shapes grow: a character more with every second attempt past ROOMY
    more = F.greatest(F.floor((F.col("attempt") - ROOMY) / 2).cast("int") + 1, F.lit(0))
    longer = lambda x, c: F.concat(x, F.repeat(F.lit(c), more))
    domain = _shaped(F.col("__domain"), F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), F.col("__domain")), 256))
    octets = [F.lit(1) + _pick(seed, 0, 223), *[_pick(seed, i, 256) for i in (1, 2)], F.lit(1) + _pick(seed, 3, 254)]
    # country code and separators stay; the first digit after them is 2 to 9
    phone = F.concat(F.col("__code"), _char("23456789", seed, F.lit(-1)), _shaped(longer(F.expr("substring(value, length(__code) + 2)"), "0"), seed))
    drawn = (
        F.when(F.col("kind") == "email", F.concat(_shaped(longer(F.substring_index(value, "@", 1), "a"), seed), F.lit("@"), domain, F.regexp_extract(value, r"\.[^.@]+$", 0)))
        .when(F.col("kind") == "ip", F.concat_ws(".", *octets))
        .when(F.col("kind") == "phone", phone)
        .when(F.col("kind") == "card", _card(value, seed))
        .when(F.col("kind").isin("hex", "ip6"), F.when(value.rlike("[a-f]"), _shaped(value, seed, "0123456789abcdef", "0123456789abcdef")).otherwise(_shaped(value, seed, "0123456789ABCDEF", upper="0123456789ABCDEF")))
        .when(F.col("kind") == "iban", _iban(value, seed))
        .when(F.col("kind") == "secret", F.concat(F.regexp_extract(value, r"^(?:AKIA|gh._|sk-|xox.-)", 0), _shaped(F.regexp_replace(value, r"^(?:AKIA|gh._|sk-|xox.-)", ""), seed)))
        .when(F.col("kind") == "name", _name(value, F.col("gender"), seed))
        .otherwise(_shaped(longer(value, "0"), seed))
    )
    return seeded.select("kind", "value", "gender", "attempt", drawn.alias("surrogate"))


def mentions(rows: DataFrame) -> DataFrame:
    """``rk``, ``pos``, ``prefix`` (kept as it is), ``kind``, ``value``, ``gender`` of every entity.

    ``rows`` has ``rk`` and ``text``; rows with one ``rk`` have one text and count once.
    """
    found = rows.select("rk", F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("pos", "m"))
    title = F.regexp_extract("m", rf"^(?:(?:{_TITLE})+|\s)", 0)
    bare = F.regexp_extract(title, r"^[^\s.]+", 0)
    kinds = found.groupBy("rk", "pos").agg(F.first("m").alias("m")).select("rk", "pos", _kind(F.col("m")).alias("kind"), "m", title.alias("title"), bare.alias("bare"))
    named = F.col("kind") == "name"
    value = F.when(named, F.expr("substring(m, length(title) + 1)")).otherwise(F.col("m"))
    gender = F.when(named & F.col("bare").isin(*FEMALE), "f").when(named & F.col("bare").isin(*MALE), "m")
    return kinds.select("rk", "pos", F.when(named, F.col("title")).otherwise("").alias("prefix"), "kind", value.alias("value"), gender.alias("gender"))


def assign(found: DataFrame, key: str = KEY) -> DataFrame:
    """``kind``, ``value``, ``surrogate``: one row per distinct entity, all surrogates distinct.

    A name that is addressed in both genders, or in none, gets an open ending.  Where
    the texts use up the values of a form (mails of one letter, local numbers), mails,
    numbers and names grow by some characters, so the attempts end.
    """
    both = F.count_distinct("gender")
    entities = cut(found.groupBy("kind", "value").agg(F.when(both == 1, F.max("gender")).alias("gender")), "pii-entities")
    real = entities.select(F.col("value").alias("surrogate"))
    left, done = entities, None
    for attempt in range(ATTEMPTS):
        drawn = _draw(left.withColumn("attempt", F.lit(attempt)), key)
        free = drawn.join(real, "surrogate", "left_anti")
        if done is not None:
            free = free.join(done.select("surrogate"), "surrogate", "left_anti")
        first = F.row_number().over(Window.partitionBy("surrogate").orderBy("kind", "value"))
        fresh = free.select("kind", "value", "surrogate", first.alias("n")).where("n = 1").drop("n")
        done = cut(fresh if done is None else done.unionByName(fresh), "pii-surrogates")
        left = cut(left.join(done.select("kind", "value"), ["kind", "value"], "left_anti"), "pii-left")
        if left.isEmpty():
            return done
    raise RuntimeError(f"entities without a surrogate of their own after {ATTEMPTS} attempts")


def replace(docs: DataFrame, key: str = KEY, text_col: str = "text") -> DataFrame:
    """``docs`` with entities replaced in ``text_col``, and ``n_entities`` and ``entities``
    (without the bare mentions of names that are replaced, too).

    All columns are kept (those two, if they exist, are replaced).  Null and empty
    texts stay as they are with no entity; repeated rows get equal texts; an empty
    table gives an empty one.
    """
    kept = [c for c in docs.columns if c not in ("n_entities", "entities")]
    text = F.col(text_col)
    may = F.coalesce(text.rlike(MAY) | text.rlike(_ANY_TITLE), F.lit(False))  # else there is no entity
    key_of = row_key(text, F.length(text))
    found = cut(mentions(docs.where(may).select(key_of.alias("rk"), text.alias("text"))), "pii-mentions")
    named = found.join(assign(found, key), ["kind", "value"])
    lists = named.groupBy("rk").agg(F.sort_array(F.collect_list(F.struct("pos", "kind", F.concat("prefix", "surrogate").alias("surrogate"), "value", F.col("surrogate").alias("bare")))).alias("entities"))
    lists = cut(lists.withColumnRenamed("rk", "__rk").withColumnRenamed("entities", "__e"), "pii-lists")
    done = docs.where(may).select(*kept, key_of.alias("__k")).join(lists, F.col("__k") == F.col("__rk"), "left")
    put = F.array_join(F.zip_with(F.split(text, PATTERN, -1), F.transform("__e", lambda e: e["surrogate"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    # names again without a form of address; an initial alone is no name
    names = F.array_distinct(F.transform(F.filter("__e", lambda e: (e["kind"] == "name") & ~e["value"].endswith(".")), lambda e: F.struct(e["value"].alias("value"), e["bare"].alias("bare"))))
    alone = lambda x: F.concat(F.lit(r"(?<![\p{L}\p{M}\p{N}])\Q"), x, F.lit(r"\E(?![\p{L}\p{M}\p{N}])"))
    put = F.aggregate(names, put, lambda t, n: F.regexp_replace(t, alone(n["value"]), n["bare"]))
    put = F.when(F.col("__e").isNull(), text).otherwise(put)
    none = F.array().cast("array<struct<pos:int,kind:string,surrogate:string>>")
    found = F.coalesce(F.transform("__e", lambda e: F.struct(e["pos"].alias("pos"), e["kind"].alias("kind"), e["surrogate"].alias("surrogate"))), none)
    done = done.select(*[put.alias(c) if c == text_col else F.col(c) for c in kept], F.size(found).alias("n_entities"), found.alias("entities"))
    return done.unionByName(docs.where(~may).select(*kept, F.lit(0).alias("n_entities"), none.alias("entities")))
