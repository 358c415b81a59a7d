"""PII surrogates: keyed, type-consistent replacements of detected entities.

Detected are e-mail addresses, phone numbers (international, and national in several
forms), IPv4 and IPv6 addresses, payment cards (of a network's number range, with a valid
check digit), IBANs (with valid check digits), social security numbers, credentials,
and names behind a title. All spellings of an entity share a canonical form (letters in
lower case, digits without separators; a name word by word), and all mentions
of it get the same surrogate: coreference is kept, across documents too.

A surrogate is derived from a secret key, the kind and the canonical form, so
it can't be turned back without the key. It keeps the format: digits for
digits, letters for letters, the mention's own separators and capitals, the
calling or country code, the card's network and the top-level domain, a valid check
digit, octets in range; a name keeps its script, and a given name the gender that its title tells.

Distinctness: all entities' surrogates are compared with each other and with
all real entities of the kind. Of equal ones the first keeps it; the others,
and those that name a real entity, are derived anew until nothing collides.

Everything is built from DataFrame functions. Only documents with entities
move: their text meets the mentions' surrogates by row; all others pass by.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import free_name, written

# Titles, and the letters that invented names are made of.
MALE = ["Mr", "Herr", "Herrn", "Señor", "Sr", "Don", "Monsieur", "господин", "г-н", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Doña", "Madame", "Mme", "госпожа", "г-жа", "Κυρία"]
SCRIPTS = {
    "Cyrillic": (r"\p{IsCyrillic}", "бвгдзклмнпрстф", "аеиоу", "ов", "а"),
    "Greek": (r"\p{IsGreek}", "βγδζκλμνπρστφ", "αεηιου", "ος", "α"),
    "Latin": (r"\p{L}", "bdfgklmnprstvz", "aeiou", "on", "a"),
}

_TITLES = "|".join(sorted(MALE + FEMALE, key=len, reverse=True))
_LOCAL = r"[\p{L}\p{N}._%+-]"
#: Letters and digits of an IBAN, by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_EMAIL = rf"(?<!{_LOCAL}){_LOCAL}++@(?:[\p{{L}}\p{{N}}-]++\.)+\p{{L}}{{2,}}"
_IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
#: IPv6: all eight groups, or fewer around a double colon; the first has four digits, as
#: global, unique local, link-local and multicast addresses have.
_IP6 = (r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{4}(?:(?::[0-9A-Fa-f]{1,4}){7}"
        r"|(?=(?::[0-9A-Fa-f]{1,4}){0,5}::)(?=[0-9A-Fa-f:]*\d)(?::[0-9A-Fa-f]{1,4}){0,5}:(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:]|\.\d)")
#: In this order: North American with brackets, international in groups and in one, North American
#: with hyphens, French, German, Spanish (mobile groups; nine digits in threes only behind a cue).
_PHONE = (r"(?<!\d)(?:\+\d{1,3}[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
          r"|(?<!\d)\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]\d{1,4}){2,5}(?!\d)|(?<!\d)\+[1-9]\d{7,14}(?!\d)"
          r"|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"
          r"|(?<![\d.-])0[1-9](?:[ .-]\d{2}){4}(?![ .-]?\d)|(?<![\d.-])0[1-9]\d{1,3}[ /]\d{5,8}(?![ .-]?\d)"
          r"|(?<![\d.,-])[6-9]\d{2}(?: \d{2}){3}(?! ?\d)"
          r"|(?<=(?i:\b(?:tel|tfno|tlf|teléfono|móvil|phone|call)\b[.:]? ))[6-9]\d{2} \d{3} \d{3}(?! ?\d)")
#: What the last of these finds, without its cue.
_CUED = r"[6-9]\d{2} \d{3} \d{3}"
_SSN = r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])"
_OTHER = "|".join(f"(?:{p})" for p in (_EMAIL, _IP, _IP6, _PHONE, _SSN))
# Calling codes of one and of two digits; all others have three.
CALLING_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                 "81 82 84 86 90 91 92 93 94 95 98")
# Number ranges and lengths of the card networks.
CARD_NETWORKS = {
    "Visa": r"4(?:\d{12}|\d{15}|\d{18})",
    "Mastercard": r"(?:5[1-5]\d\d|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720)\d{12}",
    "American Express": r"3[47]\d{13}",
    "Diners Club": r"3(?:0[0-5]|[689]\d)\d{11,16}",
    "JCB": r"35(?:2[89]|[3-8]\d)\d{12,15}",
    "Discover": r"(?:6011|64[4-9]\d|65\d\d)\d{12,15}",
    "UnionPay": r"62\d{14,17}",
    "Maestro": r"(?:5018|5020|5038|5893|6304|6759|676[1-3])\d{9,15}",
}
_SIZED = "|".join(rf"(?:{codes.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (
    rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, codes in IBAN_LENGTHS.items())
#: Kind and pattern, the first that matches wins. Each pattern starts at a place
#: that a look-behind makes unique in its run, so long runs cost linear time. An IBAN
#: ends where its country's do, a card is looked for in its whole run of digits, and
#: both leave the mentions behind them to the other kinds. After a mention a run of
#: digits may start at once.
PATTERNS = {
    "email": _EMAIL,
    "credential": r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
                  r"|(?i:(?<=password=)[0-9a-z]{8,}+|(?<=(?:token|secret) = \")[0-9a-z]{16,}+(?=\"))",
    "iban": rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}\d{{2}})(?:(?:{_SIZED})(?![0-9A-Za-z])"
            rf"|[A-Z]{{2}}\d{{2}}(?:(?: (?!{_OTHER}))?[A-Z0-9]{{4}}){{2,7}}(?:(?: (?!{_OTHER}))?[A-Z0-9]{{1,3}})?(?![0-9A-Za-z]))",
    "ip": _IP,
    "ip6": _IP6,
    "phone": _PHONE,
    "ssn": _SSN,
    "card": rf"(?:(?=\d)(?<!\d|\d[ -])|\G[ -](?!{_OTHER}))\d(?:\d|[ -](?!{_OTHER})\d){{12,}}+(?!\d)",
    "name": rf"(?<![\p{{L}}-])(?:{_TITLES})\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A group of digits that a card starts with, if it is not the first of its run.
CARD_START = r"^[ -]?(?:[3-6]|2[2-7])\d{3}"
#: No entity without one of these.
HINT = rf"[0-9@]|AKIA|(?i:password=|(?:token|secret) = \")|(?:{_TITLES})\.? \p{{Lu}}"
DIGITS = ["phone", "phone+", "ssn", "card"]


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _packed(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9A-Za-z]", "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits (the last one is not doubled)."""
    return F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: _let(
            F.coalesce(c.try_cast("int"), F.lit(0)) * F.when(i % 2 == 1, 2).otherwise(1),
            lambda v: F.when(v > 9, v - 9).otherwise(v))),
        F.lit(0), lambda a, b: a + b)


def mod97(iban: Column) -> Column:
    """Remainder by 97 of an IBAN (lower case, no blanks): 1 if its check digits are right."""
    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda acc, c: F.when(
        c.rlike("[0-9]"), (acc * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97).otherwise((acc * 100 + F.ascii(c) - 87) % 97))


def _kind(mention: Column) -> Column:
    first = reduce(lambda rest, kind: F.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(rest),
                   reversed([k for k in PATTERNS if k != "credential"]), F.lit("credential"))
    return F.when(mention.rlike(f"^{_CUED}$"), "phone").otherwise(first)


def _cards(run: Column) -> Column:
    """The cards in a run of groups: structs (before, mention, kind, after).

    From each place where a card may start, the longest row of whole groups with
    a network's digits and a right check digit is taken, and the search goes on behind it.
    """
    def text(groups, start, end):
        return F.array_join(F.slice(groups, start + 1, end - start), "")

    def right(digits):
        return F.when(digits.rlike(f"^(?:{'|'.join(CARD_NETWORKS.values())})$"), luhn_sum(digits) % 10 == 0).otherwise(False)

    def step(groups):
        def go(acc, start):
            may = (start == acc["next"]) | ((start > acc["next"]) & F.get(groups, start).rlike(CARD_START))
            ends = F.filter(F.sequence(start + 1, F.least(start + 19, F.size(groups))),
                            lambda end: _let(F.regexp_replace(text(groups, start, end), "[ -]", ""), right))
            return F.when(~may, acc).otherwise(_let(F.array_max(ends), lambda end: F.when(end.isNull(), acc).otherwise(F.struct(
                F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("spans"), end.alias("next")))))
        return go

    def pieces(groups, spans):
        def one(span, i):
            start = F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))
            found = text(groups, span["start"], span["end"])
            return F.struct(
                F.concat(text(groups, start, span["start"]), F.regexp_extract(found, "^[ -]?", 0)).alias("before"),
                F.regexp_replace(found, "^[ -]", "").alias("mention"), F.lit("card").alias("kind"),
                F.when(i == F.size(spans) - 1, text(groups, span["end"], F.size(groups))).otherwise("").alias("after"))
        return F.transform(spans, one)

    return _let(F.regexp_extract_all(run, F.lit("[ -]?[0-9A-Za-z]+"), 0), lambda groups: _let(F.aggregate(
        F.sequence(F.lit(0), F.size(groups) - 1),
        F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.lit(0).alias("next")),
        step(groups), lambda acc: acc["spans"]), lambda spans: pieces(groups, spans)))


def _checked(mention: Column, kind: Column) -> Column:
    """What is an entity in a mention: structs (before, mention, kind, after)."""
    whole = F.array(F.struct(F.lit("").alias("before"), mention.alias("mention"), kind.alias("kind"), F.lit("").alias("after")))
    wrong = (kind == "iban") & (mod97(F.lower(_packed(mention))) != 1)
    return F.when((kind == "card") | wrong, _cards(mention)).otherwise(whole)


def _parts(mention: Column, kind: Column) -> Column:
    """The entities of a mention: structs (prefix kept as is, raw, kind, canon)."""
    def one(prefix, raw, kind, canon):
        return F.struct(prefix.alias("prefix"), raw.alias("raw"), kind.alias("kind"), canon.alias("canon"))

    words = F.split(mention, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    gender = F.when(title.isin(MALE), "m").when(title.isin(FEMALE), "f")

    def name_word(w, i):
        script = reduce(lambda rest, s: F.when(w.rlike(SCRIPTS[s][0]), s).otherwise(rest),
                        reversed(list(SCRIPTS)), F.lit("Latin"))
        role = F.when(i == F.size(words) - 2, "family").otherwise(F.concat(F.lit("given-"), gender))
        return one(F.when(i == 0, F.concat(words[0], F.lit(" "))).otherwise(F.lit(" ")), w,
                   F.concat_ws(":", F.lit("name"), role, script), F.lower(w))

    canon = F.when(kind.isin(DIGITS), _digits(mention)).when(kind == "iban", F.lower(_packed(mention))).otherwise(F.lower(mention))
    abroad = F.when((kind == "phone") & mention.startswith("+"), "phone+").otherwise(kind)
    whole = F.array(one(F.lit(""), mention, abroad, canon))
    return F.when(kind == "name", F.transform(F.slice(words, 2, 9), name_word)).otherwise(whole)


def _draw(key: str, salt: Column, n: Column | int) -> Column:
    """A keyed number in 0..n-1."""
    inner = F.sha2(F.concat(F.lit(key), salt), 256)
    return F.pmod(F.conv(F.substring(F.sha2(F.concat(F.lit(key), inner), 256), 1, 12), 16, 10).cast("long"), F.lit(n))


def _pick(letters: str, key: str, salt: Column) -> Column:
    return F.substring(F.lit(letters), (_draw(key, salt, len(letters)) + 1).cast("int"), F.lit(1))


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The canonical surrogate of an entity at the given attempt."""
    salt = F.concat_ws("\x1f", kind, canon, attempt.cast("string"))

    def at(i):
        return F.concat_ws("\x1f", salt, i.cast("string"))

    def same_class(c, i):
        hexa = canon.rlike("^[0-9a-f]+$") & (kind == "credential") | (kind == "ip6") & c.rlike("[0-9a-f]")
        return (F.when(hexa, _pick("0123456789abcdef", key, at(i))).when(c.rlike(r"\d"), _pick("0123456789", key, at(i)))
                .when(c.rlike(r"\p{L}"), _pick("abcdefghijklmnopqrstuvwxyz", key, at(i))).otherwise(c))

    def chars(s, skip=0):
        """Letter for letter and digit for digit, from place ``skip`` on."""
        return F.array_join(F.transform(F.split(s, ""), lambda c, i: F.when(i < skip, c).otherwise(same_class(c, i))), "")

    tld = F.regexp_extract(canon, r"\.\p{L}+$", 0)
    # After some attempts the address gets longer: short ones may be used up.
    longer = F.when(attempt >= 4, F.concat(attempt.cast("string"), F.lit("."))).otherwise("")
    email = F.concat(longer, chars(F.substring(canon, F.lit(1), F.char_length(canon) - F.char_length(tld))), tld)
    octets = [_draw(key, at(F.lit(i)), n) + 1 for i, n in enumerate((223, 254, 254, 254))]
    ip = F.concat_ws(".", *[o.cast("string") for o in octets])
    body = chars(F.substring(canon, F.lit(1), F.char_length(canon) - 1), 4)
    card = _let(body, lambda b: F.concat(b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
    # The calling code stays, and the digit behind it, which tells what sort of number it is; of
    # national numbers a 0 and the digit behind it. Of the North American ones it is 5.
    code = F.when(canon.rlike(f"^(?:{CALLING_CODES.replace(' ', '|')})"), F.char_length(F.regexp_extract(
        canon, f"^(?:{CALLING_CODES.replace(' ', '|')})", 0))).otherwise(3)
    american = F.lit("5")
    abroad = F.when(canon.startswith("1"), F.concat(F.lit("1"), american, chars(F.substring(canon, 3, 32)))).otherwise(
        F.concat(F.substring(canon, F.lit(1), code + 1), chars(F.substring(canon, code + 2, F.lit(32)))))
    phone = (F.when(canon.startswith("0"), chars(canon, 2)).when(F.char_length(canon) == 9, chars(canon, 1))
             .otherwise(F.concat(american, chars(F.substring(canon, 2, 32)))))
    ip6 = chars(canon, 4)
    account = chars(F.substring(canon, 5, 64))
    iban = _let(F.concat(F.substring(canon, 1, 2), F.lit("00"), account), lambda x: F.concat(
        F.substring(x, 1, 2), F.lpad((98 - mod97(x)).cast("string"), 2, "0"), F.substring(x, 5, 64)))
    ssn = F.concat(F.lit("8"), chars(F.substring(canon, 2, 32)))
    credential = F.when(canon.startswith("akia"), F.concat(F.lit("akia"), chars(F.substring(canon, 5, 64)))).otherwise(chars(canon))
    names = F.lit(None).cast("string")
    for script, (_, consonants, vowels, male, female) in SCRIPTS.items():
        syllables = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2) + attempt.cast("int")), lambda i: F.concat(
            _pick(consonants, key, at(i)), _pick(vowels, key, at(-i)))), "")
        ending = F.when(kind.contains("given-f"), F.concat(_pick(consonants, key, at(F.lit(0))), F.lit(female))).otherwise(
            F.concat(_pick(consonants, key, at(F.lit(0))), F.lit(male)))
        names = F.when(kind.endswith(script), F.concat(syllables, ending)).otherwise(names)
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone).when(kind == "phone+", abroad)
            .when(kind == "ip6", ip6).when(kind == "iban", iban).when(kind == "ssn", ssn).when(kind == "credential", credential).otherwise(names))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, sub) of distinct entities (kind, canon), all ``sub`` of a kind
    distinct and none a real entity."""
    state = written(entities.select("kind", "canon", F.lit(0).alias("attempt"), surrogate(
        key, F.col("kind"), F.col("canon"), F.lit(0)).alias("sub")), "surrogates")
    while True:
        winner = state.groupBy("kind", "sub").agg(F.min("canon").alias("winner"))
        real = entities.select("kind", F.col("canon").alias("sub"), F.lit(True).alias("real"))
        taken = written(winner.join(real, ["kind", "sub"], "left"), "taken")
        judged = state.join(taken, ["kind", "sub"]).withColumn(
            "again", F.col("real").isNotNull() | (F.col("winner") != F.col("canon")))
        state = written(judged.select(
            "kind", "canon", "again", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"), "sub"), "judged")
        if state.filter("again").isEmpty():
            return state.select("kind", "canon", "sub")
        anew = surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt"))
        state = written(state.select("kind", "canon", "attempt", F.when(F.col("again"), anew).otherwise(
            F.col("sub")).alias("sub")), "surrogates")


def _worded(raw: Column, kind: Column, sub: Column) -> Column:
    """A canonical surrogate in the spelling of a mention."""
    by_sign = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(
        c.rlike("[0-9A-Za-z]"), F.substring(sub, F.char_length(_packed(F.substring(raw, F.lit(1), i))) + 1, F.lit(1))).otherwise(c)), "")
    by_case = F.array_join(F.transform(F.split(sub, ""), lambda c, i: F.when(
        F.substring(raw, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    name = F.when((F.char_length(raw) > 1) & (raw == F.upper(raw)), F.upper(sub)).otherwise(F.initcap(sub))
    return (F.when(kind.isin(DIGITS), by_sign).when(kind == "iban", F.upper(by_sign)).when(kind.startswith("name"), name).when(kind == "ip", sub)
            .when((F.char_length(raw) > 1) & (raw == F.upper(raw)) & raw.rlike(r"\p{L}"), F.upper(sub))
            .when((kind == "email") & (F.char_length(raw) != F.char_length(sub)), sub).otherwise(by_case))


def mentions(text: Column) -> Column:
    """All entity strings of a text, in order; null if there is none."""
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), 0))
    return F.when(F.size(found) > 0, found)


def replace_pii(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with entities replaced in ``text_col``; every other column unchanged.

    ``count_col`` adds the number of replaced mentions (it replaces a column of
    that name). Null texts stay null; texts without an entity stay as they are.
    A run of digits with wrong check digits is no card or IBAN, but its groups may
    hold one. An IPv6 address is known by its spelling (in lower case), a phone number
    by its digits, with or without calling code. Repeated rows get equal texts. The same key gives the same surrogates as long as nothing collides.
    """
    columns = [c for c in docs.columns if not count_col or c.lower() != count_col.lower()]
    whole, row = free_name(columns, "whole"), free_name(columns, "row")
    rest = [c for c in columns if c != text_col]
    base = written(docs.select(
        F.struct(F.lit(0).alias(row), *rest).alias(whole), F.col(text_col).alias("text"), mentions(F.col(text_col)).alias("found"),
        F.monotonically_increasing_id().alias("row")), "pii")
    hits = base.filter("found IS NOT NULL").select("row", F.posexplode("found").alias("i", "mention"))
    hits = hits.withColumn("kind", _kind(F.col("mention")))
    hits = hits.select("row", "i", F.posexplode(_checked(F.col("mention"), F.col("kind"))).alias("k", "entity"))
    hits = hits.select("row", "i", "k", "entity.*")
    parts = written(hits.select("row", "i", "k", "before", "after", F.posexplode(_parts(F.col("mention"), F.col("kind"))).alias("j", "part"))
                    .select("row", "i", "k", "j", "before", "after", "part.*"), "parts")
    subs = surrogates(parts.select("kind", "canon").distinct(), key)
    worded = parts.join(subs, ["kind", "canon"]).select("row", "i", "k", "j", F.concat(
        "before", "prefix", _worded(F.col("raw"), F.col("kind"), F.col("sub")), "after").alias("s"))
    # One row per document, with its own mentions only.
    by_row = worded.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("i", "k", "j", "s"))).alias("subs"))
    out = base.filter("found IS NULL").select(whole, "text", F.lit(0).cast("long").alias("n")).unionByName(
        base.filter("found IS NOT NULL").join(by_row, "row", "left").select(
            whole, _rebuilt(F.col("text"), F.col("found"), F.col("subs")).alias("text"),
            F.coalesce(F.size(F.array_distinct(F.transform("subs", lambda x: F.struct(x["i"], x["k"])))), F.lit(0)).cast("long").alias("n")))
    fields = [F.col("text").alias(c) if c == text_col else F.col(f"{whole}.{c}").alias(c) for c in columns]
    return out.select(*fields, *([F.col("n").alias(count_col)] if count_col else []))


def _rebuilt(text: Column, found: Column, subs: Column) -> Column:
    """The text with mention i replaced by its parts (i, k, j, s); others stay."""
    def word(i):
        mine = F.filter(subs, lambda x: x["i"] == i)
        return F.when(F.coalesce(F.size(mine), F.lit(0)) > 0, F.array_join(F.transform(mine, lambda x: x["s"]), "")).otherwise(
            F.coalesce(F.get(found, i), F.lit("")))

    return F.array_join(F.transform(F.split(text, ANY), lambda s, i: F.concat(s, word(i))), "")
