"""PII surrogates (DataFrame functions only).

Entities are found by one alternation of patterns and replaced by keyed, type-consistent
surrogates: a hash stream of key, kind and canonical value picks digits for digits and letters of the same
script and case for letters, so formats stay; card numbers keep a valid check digit,
addresses their private range, e-mail domains their reserved ending; first names come
from the list of the same gender and script, surnames are built of syllables of the same script.

*Coreference*: an entity is mapped by its canonical value (digits of a number, lower case of an
address, single name words of a person), so each mention of it, in any document, gets the
same surrogate. *Distinctness*: all distinct entities are tabled; where two would share a surrogate, or one would equal a
real value, the loser is hashed again until no two collide. Names get longer with each attempt; other kinds keep their length for
``KEPT`` attempts and then get longer too (addresses leave their private range, then become IPv6), so none runs out.

Only documents with entities are joined with the table, the others pass through. Defined results: null and
empty texts stay; repeated rows change alike; documents and columns are all kept; a null doc_id is not used at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

KEPT = 8  # attempts that keep the length of a value; each one after them adds a character

# Titles by gender, and first names by gender and script.
TITLES = {"m": "Mr Herr Monsieur Señor Sr господин г-н κύριος".split(),
          "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra Srta госпожа г-жа κυρία".split(), "": "Dr Prof".split()}
FIRST = {
    ("latin", "m"): "James John Robert Michael William David Thomas Peter Paul Hans Karl Pierre Jean Luis Carlos Miguel".split(),
    ("latin", "f"): "Mary Anna Linda Susan Sarah Laura Emma Julia Maria Greta Heidi Claire Sophie Carmen Elena Lucia".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Алексей Дмитрий Николай Михаил Андрей".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Вера".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Πέτρος".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Δήμητρα".split(),
}
SYLLABLES = {"latin": "bar cor den fal gor hal kem lin mar nol per quin ros sel tam vel wen yor zan bri".split(),
             "cyrillic": "бар вол гор дан жор кам лес мор ник пол рос сан тур фёд".split(),
             "greek": "βαρ γαλ δεν καρ λαμ μαν νικ παπ ραλ σιμ ταρ φιλ".split()}
ENDING = {"latin": "", "cyrillic": "ов", "greek": "ης"}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω",
           "other": "abcdefghijklmnopqrstuvwxyz"}
HEX = "0123456789abcdef"


def _any(words) -> str:
    return "|".join(sorted((w.replace(".", r"\.") for w in words), key=len, reverse=True))


_WORD = r"\p{Lu}[\p{L}'’-]+"
_TITLE = rf"(?:{_any(t for ts in TITLES.values() for t in ts)})"
_FIRST = rf"(?:{_any(n for ns in FIRST.values() for n in ns)})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# In order of precedence. Each pattern also decides the kind of a match, so none matches another's text in full.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "secret": r"""(?<=(?i:password|passwd|pwd|token|secret|api_?key)\s{0,3}[=:]\s{0,3}["']?)[^\s"',;&<>]{6,}"""
              r"|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|(?:sk|pk|ghp|gho|xoxb|xoxp)[-_][A-Za-z0-9_-]{16,}|[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\d.+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-])",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d.+-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "person": rf"(?<![\p{{L}}]){_TITLE}\.? {_WORD}(?: {_WORD}){{0,2}}|(?<![\p{{L}}]){_FIRST}(?: {_WORD}){{1,2}}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# What every match holds: decides cheaply for most texts that they hold none.
SIGN = rf"""[@\d]|(?i:password|passwd|pwd|token|secret|api_?key)\s{{0,3}}[=:]|(?<![\p{{L}}])(?=\p{{Lu}}|г|κ)(?:{_TITLE}\.?|{_FIRST}) \p{{Lu}}"""


def kind_of(mention: Column) -> Column:
    """The kind of a matched string. Secrets need their context to match, so they are what is left over."""
    out = F.lit("secret")
    for kind in reversed([k for k in PATTERNS if k != "secret"]):
        out = F.when(mention.rlike(rf"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return F.when(mention.rlike(r"^(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16})$"), F.lit("secret")).otherwise(out)


def script_of(word: Column) -> Column:
    return (F.when(word.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(word.rlike(r"\p{IsGreek}"), F.lit("greek"))
            .when(word.rlike(r"\p{IsLatin}"), F.lit("latin")).otherwise(F.lit("other")))


def gender_of(mention: Column, word: Column) -> Column:
    """By the first name itself, else by the title; empty if neither tells."""
    out = F.lit("")
    for g in ("m", "f"):
        out = F.when(mention.rlike(rf"^(?:{_any(TITLES[g])})\.? "), F.lit(g)).otherwise(out)
    for g in ("m", "f"):
        names = [n.lower() for (_, own), ns in FIRST.items() if own == g for n in ns]
        out = F.when(F.lower(word).isin(names), F.lit(g)).otherwise(out)
    return out


def name_words(mention: Column) -> Column:
    return F.split(F.regexp_replace(mention, rf"^{_TITLE}\.? ", ""), " ")


def units(mention: Column) -> Column:
    """What a mention is mapped by: ``array<struct<kind, value>>``, one for most kinds, one a word for persons."""
    kind = kind_of(mention)
    unit = lambda k, v: F.struct(k.alias("kind"), v.alias("value"))
    value = (F.when(kind == "email", F.lower(mention)).when(kind.isin("card", "phone", "ssn"), F.regexp_replace(mention, r"\D", ""))
             .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit(""))).otherwise(mention))
    # A number written with a country code is another number than the same digits without one.
    named = F.when((kind == "phone") & mention.startswith("+"), F.concat(F.lit("phone+"), F.length(F.regexp_extract(mention, r"^\+(\d{1,3})(?=[ .(-])", 1)).cast("string"))).otherwise(kind)
    words = name_words(mention)
    of_person = F.transform(words, lambda w, i: unit(
        F.when(i == F.size(words) - 1, F.concat(F.lit("last "), script_of(w)))
        .otherwise(F.concat(F.lit("first "), script_of(w), F.lit(" "), gender_of(mention, w))), F.lower(w)))
    return F.when(kind == "person", of_person).otherwise(F.array(unit(named, value)))


def _stream(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """256 hex digits keyed by secret, kind, value and attempt."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string"))
    return F.concat(F.sha2(F.concat(seed, F.lit("\x1f0")), 512), F.sha2(F.concat(seed, F.lit("\x1f1")), 512))


def _byte(stream: Column, i: Column) -> Column:
    """A number below 65536 for place i: two bytes of the stream, which repeats after 64 places."""
    return F.conv(F.substring(stream, (F.pmod(i, F.lit(64)) * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), (n % len(alphabet) + 1).cast("int"), F.lit(1))


def _like(stream: Column, value: Column, first: Column) -> Column:
    """Characters of the same class for all places from ``first`` on: digits, letters of the script and case."""
    def one(c: Column, i: Column) -> Column:
        n = _byte(stream, i)
        letter = F.lit(None).cast("string")
        for script, alphabet in LETTERS.items():
            letter = F.when(script_of(c) == script, _pick(alphabet, n)).otherwise(letter)
        out = F.when(c.rlike(r"^\d$"), F.when((i == first) & (c != "0"), (n % 9 + 1).cast("string")).otherwise((n % 10).cast("string")))
        out = out.when(c.rlike(r"^\p{Lu}$"), F.upper(letter)).when(c.rlike(r"^\p{L}$"), letter).otherwise(c)
        return F.when(i < first, c).otherwise(out)
    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(digits: Column, doubled: int) -> Column:
    """Sum of the check-digit rule; places counted from the right, those of parity ``doubled`` doubled."""
    def one(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(c.cast("int"))
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda a, x: a + x)


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The surrogate of a canonical value at an attempt."""
    stream = _stream(key, kind, value, attempt)
    zero = F.lit(0)
    extra = F.greatest(attempt - (KEPT - 1), zero)
    wider = lambda v, c: F.concat(v, F.repeat(F.lit(c), extra))
    # Signs stay as they are while the length does; a value of signs alone needs letters to differ.
    lettered = lambda v: wider(F.when(extra > 0, F.regexp_replace(v, r"[^\p{L}\d]", "a")).otherwise(v), "a")
    at = F.instr(value, "@")
    domain = F.substring(value, at + 1, F.length(value))
    ending = F.regexp_extract(domain, r"((?:^|\.)example\.(?:com|org|net)|\.[^.]+)$", 1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(ending))
    email = F.concat(_like(stream, lettered(F.substring(value, F.lit(1), at - 1)), zero), F.lit("@"),
                     F.when(host != "", _like(_stream(key, F.lit("domain"), domain, zero), host, zero)).otherwise(host), ending)
    card = _like(stream, wider(value, "0"), F.lit(1))
    body = F.substring(card, F.lit(1), F.length(card) - 1)
    checked = F.concat(body, F.pmod(-_luhn(body, 0), F.lit(10)).cast("string"))
    card = F.when(_luhn(value, 1) % 10 == 0, checked).otherwise(card)
    private = F.when(value.rlike(r"^(?:10|127)\."), F.lit(1)).when(value.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2\d|3[01]))\."), F.lit(2)).otherwise(zero)
    octets = lambda kept: F.array_join(F.transform(F.split(value, r"\."), lambda o, i: F.when(i < kept, o).otherwise((_byte(stream, i) % 254 + 1).cast("string"))), ".")
    ten = F.concat(F.lit("10"), F.regexp_extract(octets(F.lit(1)), r"\..*$", 0))
    six = F.concat_ws(":", F.when(private > 0, "fd00:db8").otherwise("2001:db8"), *[F.substring(stream, 4 * i + 1, 4) for i in range(6)])
    ip = F.when(attempt >= 2 * KEPT, six).when((extra > 0) & (private > 0), ten).otherwise(octets(private))
    phone = _like(stream, wider(value, "0"), F.when(kind.startswith("phone+"), F.substring(kind, 7, 1).cast("int")).otherwise(zero))
    hexed = lambda upper: F.array_join(F.transform(F.split(wider(value, "0"), ""), lambda c, i: _pick(HEX.upper() if upper else HEX, _byte(stream, i))), "")
    secret = (F.when(value.rlike("^[0-9a-f]+$"), hexed(False)).when(value.rlike("^[0-9A-F]+$"), hexed(True))
              .when(value.rlike("^AKIA"), _like(stream, lettered(value), F.lit(4))).otherwise(_like(stream, lettered(value), zero)))
    out = secret
    for k, made in (("iban", _like(stream, wider(value, "0"), F.lit(2))), ("ssn", _like(stream, wider(value, "0"), zero)), ("ip", ip), ("card", card), ("email", email)):
        out = F.when(kind == k, made).otherwise(out)
    out = F.when(kind.startswith("phone"), phone).otherwise(out)
    place = F.sequence(zero, attempt)
    for (script, gender), names in FIRST.items():
        listed = F.array(*[F.lit(n.lower()) for n in names])
        made = F.array_join(F.transform(place, lambda i: F.element_at(listed, _byte(stream, i) % len(names) + 1)), "-")
        own = [f"first {script} {gender}", *([f"first {script} "] if gender == "f" else []),
               *([f"first other {gender}"] + ["first other "] * (gender == "f") if script == "latin" else [])]
        out = F.when(kind.isin(own), made).otherwise(out)
    for script, parts in SYLLABLES.items():
        listed = F.array(*map(F.lit, parts))
        made = F.concat(F.array_join(F.transform(F.sequence(zero, attempt + 2), lambda i: F.element_at(listed, _byte(stream, i) % len(parts) + 1)), ""), F.lit(ENDING[script]))
        out = F.when(kind.isin(f"last {script}", *(["last other"] if script == "latin" else [])), made).otherwise(out)
    return out


def resolved(entities: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate`` of the distinct (kind, value) rows, no two of a kind with one surrogate
    and none equal to a real value of the kind. Surrogates get longer with the attempts, so the rounds end."""
    left = entities.withColumn("attempt", F.lit(0))
    done: list[DataFrame] = []
    while True:
        tried = written(left.withColumn("surrogate", surrogate(key, F.col("kind"), F.col("value"), F.col("attempt"))), "pii-tried")
        if tried.isEmpty():
            return reduce(DataFrame.unionByName, done or [tried]).select("kind", "value", "surrogate")
        real = entities.select("kind", F.col("value").alias("surrogate"))
        taken = reduce(DataFrame.unionByName, [real, *(d.select("kind", "surrogate") for d in done)])
        winners = tried.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).join(taken, ["kind", "surrogate"], "left_anti")
        done.append(written(winners.select("kind", "value", "surrogate"), "pii-won"))
        left = tried.join(done[-1].select("kind", "value"), ["kind", "value"], "left_anti").select(
            "kind", "value", (F.col("attempt") + 1).alias("attempt"))


def _cased(made: Column, like: Column) -> Column:
    """Name words in the case of the original: all upper, all lower, else capitalised."""
    joined = F.array_join(F.transform(F.split(made, "-"), lambda p: F.initcap(p)), "-")
    return F.when((F.upper(like) == like) & (F.length(like) > 1), F.upper(made)).when(F.lower(like) == like, made).otherwise(joined)


def rendered(mention: Column, lookup: Column) -> Column:
    """A mention with its surrogates in its own format; ``lookup`` maps kind and value to surrogates."""
    own = units(mention)
    of = lambda u: F.element_at(lookup, F.concat(u["kind"], F.lit("\x1f"), u["value"]))
    words = name_words(mention)
    title = F.regexp_extract(mention, rf"^({_TITLE}\.? )", 1)
    person = F.concat(title, F.array_join(F.zip_with(own, words, lambda u, w: _cased(of(u), w)), " "))
    made = of(F.get(own, F.lit(0)))
    chars = F.split(mention, "")
    in_format = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(r"^[\p{L}\d]$"), F.substring(
        made, F.length(F.regexp_replace(F.substring(mention, F.lit(1), i + 1), r"[^\p{L}\d]", "")), F.lit(1))).otherwise(c)), "")
    # What a surrogate has more than the mention: behind a number, at the end of the local part of an address.
    in_format = F.concat(in_format, F.substring(made, F.length(F.regexp_replace(mention, r"[^\p{L}\d]", "")) + 1, F.length(made)))
    at = F.instr(mention, "@")
    aligned = F.concat(F.substring(mention, F.lit(1), at - 1), F.repeat(F.lit("-"), F.length(made) - F.length(mention)), F.substring(mention, at, F.length(mention)))
    email = F.array_join(F.zip_with(F.split(aligned, ""), F.split(made, ""), lambda c, m: F.when((F.lower(c) != c) & (F.upper(m) != m), F.upper(m)).otherwise(m)), "")
    kind = F.get(own, F.lit(0))["kind"]
    return (F.when(kind.rlike("^(?:first|last) "), person).when(kind == "email", email)
            .when(kind.rlike("^(?:phone|card|ssn|iban)"), in_format).otherwise(made))


def pseudonymised(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with every entity of ``text`` replaced; ``count`` names a column
    for the number of replaced mentions."""
    counted = count or "__n"
    mentions = F.when(F.col(text).rlike(SIGN), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    found = docs.withColumn("__mentions", F.coalesce(mentions, F.array().cast("array<string>")))
    hits = written(found.where(F.size("__mentions") > 0).withColumn("__row", F.monotonically_increasing_id()), "pii-hits")
    unit = hits.select("__row", F.explode(F.array_distinct("__mentions")).alias("m")).select("__row", F.inline(units(F.col("m")))).distinct()
    unit = written(unit, "pii-units")
    table = resolved(unit.select("kind", "value").distinct(), key)
    maps = unit.join(table, ["kind", "value"]).groupBy("__row").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat("kind", F.lit("\x1f"), "value"), "surrogate"))).alias("__lookup"))
    joined = hits.join(maps, "__row")
    pieces = F.split(text, ENTITY, -1)
    made = F.transform("__mentions", lambda m: rendered(m, F.col("__lookup")))
    whole = F.array_join(F.zip_with(pieces, F.concat(made, F.array(F.lit(""))), lambda p, m: F.concat(p, m)), "")
    keep = [c for c in docs.columns]
    changed = joined.withColumn(counted, F.size("__mentions")).withColumn(text, whole)
    plain = found.where(F.size("__mentions") == 0).withColumn(counted, F.lit(0))
    out = plain.select(*keep, counted).unionByName(changed.select(*keep, counted))
    return out if count else out.drop(counted)
