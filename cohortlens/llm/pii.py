"""Format-preserving Feistel pseudonyms for personal data, in DataFrame functions alone.

Numbers and dates that pass validation are permuted by a keyed Feistel network
within their format: a card number stays one with a valid check digit, a phone
number keeps its punctuation and country code, an address stays four octets, a
date stays a date. Phone numbers count as such by their format (country code,
brackets, separators), whatever their digits; a run of ten digits alone only
with valid area and exchange codes. The permutation depends on key and kind only, so equal
values get equal pseudonyms in every document, and the key holder can invert.

A Feistel network here alternates between two halves: each round adds a keyed
hash of one half to the other, digit by digit (letter by letter), so lengths
and character classes stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import once

ROUNDS = 8
KEY = "cohortlens-pseudonym-key"
EPOCH = "1900-01-01"
#: Days that are permuted among each other, from EPOCH on (two halves of eight bits).
DAYS = 1 << 16

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
_ISO = r"(?<![0-9./-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9/-])"
_DAY_FIRST = r"(?<![0-9./-])[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9/-])"
_IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
#: Where a phone number does not go on over a separator.
_OTHER = f"(?:{_ISO}|{_DAY_FIRST}|{_IP}|{_SSN}|{_CARD})"
_GAP = rf"(?:(?:[ ./-]?\(|\)[ ./-]?|[ ./-])(?!{_OTHER}))?"
#: Area, exchange and line: any digits where brackets or separators show the format, else valid first digits.
_FORMATTED = r"(?:\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?|\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]|[0-9]{3}[ .-][0-9]{3})[0-9]{4}"
_PHONE = "(?:" + "|".join((
    rf"(?<![0-9+])(?:\+|00(?=1[ .-]))1[ .-]?(?:{_FORMATTED}|[0-9]{{10}})(?![0-9])",
    rf"(?<![0-9+])\+[1-9](?:{_GAP}[0-9]){{6,14}}(?![0-9])",
    rf"(?<![0-9A-Za-z+.,])00[1-9][0-9]{{0,2}}[ .-](?:{_GAP}[0-9]){{6,12}}(?![0-9A-Za-z])",
    rf"(?<![0-9A-Za-z+])(?:1[ .-]?(?=\()|1[ .-])?{_FORMATTED}(?![0-9A-Za-z])",
    r"(?<![0-9A-Za-z+.,_$#-])1?[2-9][0-9]{2}[2-9][0-9]{6}(?![0-9A-Za-z_-]|[.,][0-9])",
    rf"(?<![0-9A-Za-z+.,/-])(?!{_OTHER}|[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}|0[0-9]+(?![0-9 ./)-]))(?:0|\(0)[1-9](?=[0-9]{{0,3}}\)?[ ./-])(?:{_GAP}[0-9]){{7,10}}(?![0-9A-Za-z])",
)) + ")"
#: Country codes of one and two digits; the others have three.
_COUNTRY = r"(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Kinds in the order in which they are tried at a place.
KINDS = {"email": _EMAIL, "iso_date": _ISO, "date": _DAY_FIRST, "ip": _IP, "phone": _PHONE, "ssn": _SSN, "card": _CARD}
ANY = "|".join(KINDS.values())


def _hash(key: str, kind: str, r: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), half), 256)


def _number(hexed: Column, at, n: int) -> Column:
    return F.conv(F.substring(hexed, at, n), 16, 10).cast("long")


def _added(text: Column, hexed: Column) -> Column:
    """Each digit and letter of ``text`` moved within its class by two hex digits of the hash; control codes stand for digits of smaller classes."""
    def move(c, i):
        by = F.conv(F.substr(hexed, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        in_class = lambda first, size: F.chr(F.pmod(code - first + by, F.lit(size)) + first)
        return (F.when(code.between(48, 57), in_class(48, 10)).when(code.between(97, 122), in_class(97, 26))
                .when(code.between(65, 90), in_class(65, 26)).when(code.between(1, 8), in_class(1, 8))
                .when(code.between(14, 15), in_class(14, 2)).when(code.between(16, 24), in_class(16, 9)).otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), move), "")


def permuted_text(text: Column, key: str, kind: str) -> Column:
    """Feistel over the two halves of a string, class by class."""
    cut = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), cut).alias("a"), F.substr(text, cut + 1, F.length(text)).alias("b"))

    def step(s, r):
        return F.when(r % 2 == 0, F.struct(_added(s["a"], _hash(key, kind, r, s["b"])).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), _added(s["b"], _hash(key, kind, r, s["a"])).alias("b")))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return F.concat(done["a"], done["b"])


def permuted_number(value: Column, half_bits: int, key: str, kind: str) -> Column:
    """Feistel over a number of ``2 * half_bits`` bits."""
    size = 1 << half_bits
    start = F.struct(F.shiftright(value, half_bits).alias("a"), (value % size).alias("b"))

    def step(s, r):
        return F.struct(s["b"].alias("a"), ((s["a"] + _number(_hash(key, kind, r, s["b"].cast("string")), 1, 8)) % size).alias("b"))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return done["a"] * size + done["b"]


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _refilled(v: Column, digits: Column) -> Column:
    """``v`` with its digits replaced in order by ``digits``."""
    def filled(new):
        def fill(c, i):
            return F.when(c.rlike("[0-9]"), F.substr(new, F.length(_digits(F.substr(v, F.lit(1), i + 1))), F.lit(1))).otherwise(c)
        return F.array_join(F.transform(F.split(v, ""), fill), "")
    return once(digits, filled)


def _luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """Luhn sum; places with ``index from the right % 2 == doubled_from_right`` (from 0) count double."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == doubled_from_right, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _card(v: Column, key: str) -> Column:
    d = _digits(v)
    n = F.length(d)
    body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permuted_text(F.substr(d, F.lit(2), n - 2), key, "card"))
    check = (10 - _luhn_sum(body, 0) % 10) % 10
    return F.when(_luhn_sum(d, 1) % 10 == 0, _refilled(v, F.concat(body, check.cast("string"))))


#: Digits that move among each other only: 2-9 and 0-1 where an area or exchange begins, 1-9 behind a trunk 0.
_LEAD = "".join(map(chr, (14, 15, *range(1, 9))))
_NO_ZERO = "".join(map(chr, range(16, 25)))


def _phone(v: Column, key: str) -> Column:
    """Country code and trunk 0 stay, all other digits move; a valid area or exchange code stays valid."""
    nation, plain = F.lit("nation"), F.lit("plain")

    def parts(d):
        kind = F.when(v.rlike(r"^(?:\+|00)"), F.when(d.rlike("^(?:00)?1[0-9]{10}$"), plain).otherwise(nation)).when(
            d.rlike("^1[0-9]{10}$") | v.rlike(f"^(?:{_FORMATTED}|[0-9]{{10}})$"), plain).otherwise(F.lit("trunk"))
        return once(kind, lambda kind: once(
            F.when(kind == nation, F.length(F.regexp_extract(d, rf"^(?:00)?{_COUNTRY}", 0)) + F.when(v.rlike(r"^[+0-9]+[ .-]?\(0\)"), 1).otherwise(0))
            .when(kind == plain, F.length(d) - 10).otherwise(1),
            lambda n: F.struct(kind.alias("kind"), F.substr(d, F.lit(1), n).alias("code"), F.substr(d, n + 1, F.length(d)).alias("own"))))

    def moved(p):
        at = lambda i, n: F.substr(p["own"], F.lit(i), F.lit(n))
        lead = lambda i: F.translate(at(i, 1), "0123456789", _LEAD)
        classed = F.when(p["kind"] == nation, p["own"]).when(p["kind"] == plain, F.concat(lead(1), at(2, 2), lead(4), at(5, 6))).otherwise(
            F.concat(F.translate(at(1, 1), "123456789", _NO_ZERO), at(2, 20)))
        return F.concat(p["code"], once(classed, lambda x: F.translate(permuted_text(x, key, "phone"), _LEAD + _NO_ZERO, "0123456789123456789")))

    return _refilled(v, once(once(_digits(v), parts), moved))


def _ssn(v: Column, key: str) -> Column:
    d = _digits(v)
    area, group, serial = (F.substr(d, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (4, 2), (6, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    # the area stays, the rest is permuted until it is neither group 00 nor serial 0000: a walk of the permutation
    first = permuted_text(F.substr(d, F.lit(4), F.lit(6)), key, "ssn")
    bad = lambda x: x.rlike("^00|0000$")
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(12)), first, lambda x, _: F.when(bad(x), permuted_text(x, key, "ssn")).otherwise(x))
    return F.when(valid, F.concat(F.substr(v, F.lit(1), F.lit(4)), F.substr(walked, F.lit(1), F.lit(2)), F.lit("-"), F.substr(walked, F.lit(3), F.lit(4))))


def _ip(v: Column, key: str) -> Column:
    parts = F.transform(F.split(v, r"\."), lambda p: p.cast("long"))
    value = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a * 256 + p)
    new = permuted_number(value, 16, key, "ip")
    out = F.concat_ws(".", *(F.pmod(F.shiftright(new, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)))
    return F.when(F.forall(parts, lambda p: p <= 255), out)


def _moved_day(day: Column, key: str) -> Column:
    since = F.datediff(day, F.lit(EPOCH).cast("date")).cast("long")
    block = F.floor(since / DAYS).cast("long")
    return F.date_add(F.lit(EPOCH).cast("date"), (block * DAYS + permuted_number(since - block * DAYS, 8, key, "date")).cast("int"))


def _iso_date(v: Column, key: str) -> Column:
    return F.date_format(_moved_day(F.try_to_timestamp(v, F.lit("yyyy-MM-dd")).cast("date"), key), "yyyy-MM-dd")


def _date(v: Column, key: str) -> Column:
    """Day first, or month first where the day-first reading is no date."""
    sep = F.substr(v, F.lit(3), F.lit(1))
    plain = F.regexp_replace(v, "[./]", "-")
    dmy, mdy = (F.try_to_timestamp(plain, F.lit(f)).cast("date") for f in ("dd-MM-yyyy", "MM-dd-yyyy"))
    moved = _moved_day(F.coalesce(dmy, mdy), key)
    out = F.when(dmy.isNotNull(), F.date_format(moved, "dd-MM-yyyy")).otherwise(F.date_format(moved, "MM-dd-yyyy"))
    return F.when(F.substr(v, F.lit(6), F.lit(1)) == sep, F.replace(out, F.lit("-"), sep))


def _email(v: Column, key: str) -> Column:
    return F.concat(permuted_text(F.substring_index(v, "@", 1), key, "email"), F.lit("@"), F.substring_index(v, "@", -1))


_MAKE = {"email": _email, "iso_date": _iso_date, "date": _date, "ip": _ip, "phone": _phone, "ssn": _ssn, "card": _card}


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with ``text`` pseudonymised and one count column ``n_<kind>`` per kind added.

    Values that fail validation (check digit, octet, calendar) stay. Null texts
    stay null with counts 0, texts without personal data stay byte for byte.
    A place belongs to the first kind that matches there.
    """
    text = F.col("text").cast("string")
    counts = [f"n_{k}" for k in KINDS]
    base = docs.drop(*counts, "__m", "__p").withColumn("text", text)

    def made(v: Column) -> Column:
        which, new = None, None
        for k, p in KINDS.items():
            # lookarounds hold at both ends of a value that stands alone
            hit = v.rlike(f"^(?:{p})$")
            which = F.when(hit, F.lit(k)) if which is None else which.when(hit, F.lit(k))
            new = F.when(hit, _MAKE[k](v, key)) if new is None else new.when(hit, _MAKE[k](v, key))
        return F.struct(F.when(new.isNotNull(), which).alias("kind"), F.coalesce(new, v).alias("new"))

    some = F.col("text").rlike("[0-9@]")
    found = base.withColumn("__m", F.when(some, F.transform(F.regexp_extract_all("text", F.lit(ANY), F.lit(0)), made)))
    hit = F.size("__m") > 0
    pieces = F.split("text", ANY, -1)
    spliced = F.array_join(F.zip_with(pieces, F.col("__m"), lambda p, m: F.concat(p, F.coalesce(m["new"], F.lit("")))), "")

    def number_of(k: str) -> Column:
        return F.when(hit, F.size(F.filter("__m", lambda m: m["kind"] == k))).otherwise(F.lit(0)).cast("long").alias(f"n_{k}")

    return found.select(*(F.when(hit, spliced).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in base.columns),
                        *(number_of(k) for k in KINDS))
