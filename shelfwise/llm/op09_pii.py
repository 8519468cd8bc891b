"""Format-preserving pseudonyms for personal data (DataFrame functions only).

Card numbers (Luhn), IPv4 and IPv6 addresses, phone numbers (international, North
American, national with a leading zero), social-security numbers, calendar
dates, e-mail addresses and access secrets are found by one pattern, validated,
and replaced by a keyed permutation of their own format: a Feistel network over the value's symbols, whose round function is SHA-256 of key,
format, round and the other half. A permutation is one-to-one, so equal values
get equal pseudonyms in every document without any lookup table or shuffle,
and unequal ones never meet.

Symbols: a digit moves among digits, a letter among letters of its case, an
IPv4 octet among 0-255, an IPv6 group among its 65536 values (the pseudonym is
spelled uncompressed, so one address links however it is written), a date among
the days of its 400-year calendar cycle; punctuation stays. A card's last digit is recomputed, so it stays Luhn-valid.

A run of digit groups that is no card as a whole may hold one beside other
numbers: every part of 13 to 19 digits at group borders is tried. Parts grouped
as cards are printed go before others; valid parts that overlap all the same are
replaced as one.

A secret is what follows a key's name and ``=`` or ``:``, from 8 characters up to
white space, a quote, comma, semicolon or angle bracket. After ``secret:`` and
``token:`` it must hold a digit or a symbol that prose words lack.
Characters beyond ASCII letters and digits stay. A short IPv6 address counts from
three colons or a first group of three digits (``1::2`` is a slice).

Defined cases: a null text stays null, an empty one empty; matches that fail
their validation stay as they are; repeated rows give repeated results; all
columns of the input come back, ``text`` replaced; helper columns take names
the input doesn't have. Every row is handled alone, whatever its length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh, table

ROUNDS = 10
DAYS = (27, 5411)  # 27 * 5411 days = 400 calendar years
KEY = "shelfwise-demo-key"  # a deployment passes its own

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_VALUE = r"[^\s\"'<>,;]"
_NAMED = r"(?<![a-z])(?:password|passwd|api_?key)[\"']? ?[=:] ?[\"']?"
SECRET = (r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
          rf"|(?i:{_NAMED}|(?<![a-z])(?:secret|token)[\"']? ?(?:=|:(?= ?[\"']?[a-z.!?:()/-]*+(?![\s\"'<>,;]|$))) ?[\"']?)"
          rf"{_VALUE}{{8,}}+[\"']?")
EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"  # a host name's own limits
         r"(?![A-Za-z0-9])")
DATE = (r"(?<![0-9A-Za-z.-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z])"
        r"|(?<![0-9A-Za-z./])[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9A-Za-z])")
IP = rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
IP6 = (rf"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{{0,4}}:)(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f]{{3,4}}:|(?:{_HEX}:|:){{3}})"
       rf"(?=[A-Fa-f:]*+[0-9])(?:(?:{_HEX}:){{1,6}}|:)(?::{_HEX}){{1,6}})(?![0-9A-Za-z]|:|\.[0-9])")
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
PHONE = (r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9A-Za-z])"
         r"|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9A-Za-z])"
         r"|(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9A-Za-z-])")
NATIONAL = r"(?<![0-9A-Za-z.,/-])0[1-9][0-9]{0,3}(?:[ /-][0-9]{2,8}){1,4}(?![0-9A-Za-z]|[.,/-][0-9])"
# a whole run of digit groups, up to where another kind of value begins
CARD = (r"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?![A-Za-z])"
        rf"(?:(?:-| (?!{DATE}|{IP}|{SSN}|{PHONE}))[0-9]++(?![A-Za-z]))*+")
PRINTED = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
REACH = 18  # groups that a card can have after its first
# what every alternative implies comes first, so that most places in a text fail at one look
_NUMBERS = "|".join((DATE, IP, SSN, CARD, PHONE, NATIONAL))
PATTERN = rf"(?=[AaPpSsTt])(?:{SECRET})|(?<![0-9A-Za-z])(?:{EMAIL}|{IP6}|(?=[0-9+(])(?:{_NUMBERS}))"
KINDS = ("secret", "email", "date", "ip6", "ip", "ssn", "card", "phone")

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it on: a lambda's body would repeat it for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def luhn_total(digits: Column, shift: int) -> Column:
    """Luhn sum of a digit string; ``shift`` 1 if a check digit will follow, else 0."""
    def total(chars: Column) -> Column:
        def add(acc: Column, at: Column) -> Column:
            v = F.get(chars, at)
            return acc + F.when((at + shift) % 2 == 1, F.when(v > 4, v * 2 - 9).otherwise(v * 2)).otherwise(v)
        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), F.lit(0), add)
    return let(F.transform(_split(F.reverse(digits)), lambda c: c.cast("int")), total)


def _split(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def is_card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & (luhn_total(digits, 0) % 10 == 0) & ~digits.rlike("^0*$")


def parts_of(value: Column) -> Column:
    """(v, k) pieces of a run of digit groups: the cards in it, and what lies between them."""
    def before(ends: Column, i: Column | int, first: Column) -> Column:
        """Greatest end of what starts from ``first`` to ``i``."""
        a = F.greatest(F.lit(0), first)
        return F.coalesce(F.array_max(F.slice(ends, a + 1, F.greatest(F.lit(0), i - a + 1))), F.lit(-1))

    def tried(g: Column) -> Column:
        def at(_: Column, i: Column) -> Column:
            text = lambda e: F.regexp_replace(F.array_join(F.slice(g, i + 1, e - i + 1), ""), "[ -]$", "")
            upto = F.sequence(i, F.least(i + REACH, F.size(g) - 1))
            valid = F.filter(F.transform(upto, lambda e: F.struct(e.alias("e"), text(e).alias("s"))),
                             lambda c: is_card(F.regexp_replace(c["s"], "[^0-9]", "")))
            return F.transform(valid, lambda c: F.struct(c["e"].alias("e"), c["s"].rlike(PRINTED).alias("p")))
        return let(F.struct(g.alias("g"), F.transform(g, at).alias("c")), printed)

    def printed(x: Column) -> Column:
        last = lambda c: F.coalesce(F.array_max(F.transform(F.filter(c, lambda y: y["p"]), lambda y: y["e"])), F.lit(-1))
        return let(F.struct(x["g"].alias("g"), x["c"].alias("c"), F.transform(x["c"], last).alias("u")), others)

    def others(x: Column) -> Column:
        def end(c: Column, i: Column) -> Column:
            free = F.filter(c, lambda y: before(x["u"], y["e"], i - REACH) < i)
            return F.when(F.get(x["u"], i) >= 0, F.get(x["u"], i)).otherwise(
                F.coalesce(F.array_max(F.transform(free, lambda y: y["e"])), F.lit(-1)))
        return let(F.struct(x["g"].alias("g"), F.transform(x["c"], end).alias("e")), cut)

    def cut(x: Column) -> Column:
        g, e = x["g"], x["e"]
        taken = lambda i: before(e, i, i - REACH) >= i
        joined = lambda i: (before(e, i - 1, i - REACH) >= i) | (~taken(i) & ~taken(i - 1))
        starts = F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: (i == 0) | ~joined(i))

        def piece(s: Column, n: Column, all_: Column) -> Column:
            size = F.coalesce(F.get(all_, n + 1), F.size(g)) - s
            return F.struct(F.array_join(F.slice(g, s + 1, size), "").alias("v"),
                            F.when(F.get(e, s) >= 0, "card").alias("k"))
        return let(starts, lambda all_: F.transform(all_, lambda s, n: piece(s, n, all_)))
    return let(F.regexp_extract_all(value, F.lit("[0-9]+[ -]?"), F.lit(0)), tried)


def kind_of(value: Column) -> Column:
    """Kind of one match after validation; null if it fails."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    as_date = _day(value)
    return (F.when(value.rlike(_whole(SECRET)), "secret")
            .when(value.contains("@"), "email")
            .when(value.rlike(_whole(DATE)), F.when(as_date.isNotNull(), "date"))
            .when(value.rlike(_whole(IP6)), F.when(F.size(_groups(value)) == 8, "ip6"))
            .when(value.rlike(_whole(IP)), "ip")
            .when(value.rlike(_whole(SSN)),
                  F.when(~value.rlike("^(?:000|666|9)") & ~value.rlike("-00-") & ~value.rlike("-0000$"), "ssn"))
            .when(value.rlike(_whole(CARD)) & is_card(digits), "card")
            .when(value.rlike(_whole(PHONE)) & F.length(digits).between(7, 15), "phone")
            .when(value.rlike(_whole(NATIONAL)) & F.length(digits).between(9, 12), "phone"))


def _groups(value: Column) -> Column:
    """The groups of an IPv6 address, zeros put in for ``::`` (eight, if it is one)."""
    some = lambda text: F.filter(F.split(text, ":"), lambda g: g != "")
    head, rest = some(F.substring_index(value, "::", 1)), some(F.regexp_extract(value, "::(.*)$", 1))
    missing = F.when(value.contains("::"), F.greatest(F.lit(1), 8 - F.size(head) - F.size(rest))).otherwise(0)
    return F.concat(head, F.array_repeat(F.lit("0"), missing), rest)


def _day(value: Column) -> Column:
    """Calendar day of a date text (year first, else month first with slashes, day first with dots)."""
    iso = value.rlike("^[0-9]{4}-")
    slash = value.contains("/")
    text = (F.when(iso, value)
            .when(slash, F.concat_ws("-", value.substr(7, 4), value.substr(1, 2), value.substr(4, 2)))
            .otherwise(F.concat_ws("-", value.substr(7, 4), value.substr(4, 2), value.substr(1, 2))))
    return F.try_to_date(text, "yyyy-MM-dd")


def feistel(symbols: Column, radix: Column, tweak: Column, key: str) -> Column:
    """Keyed permutation of an array of symbols, each below its radix.

    The two halves take turns: one is shifted, symbol by symbol and modulo its
    radix, by hashes of the other, which inverts by subtracting.
    """
    def shifted(part: Column, other: Column, size: Column, lead: Column, rnd: Column, offset: Column | int) -> Column:
        def move(seed: Column) -> Column:
            def one(s: Column, i: Column) -> Column:
                draw = F.conv(F.substring(F.sha2(F.concat(seed, i.cast("string")), 256), 1, 13), 16, 10).cast("long")
                return F.pmod(s + draw, F.get(size, i + offset))
            return F.transform(part, one)
        seed = F.concat_ws("|", lead, rnd.cast("string"),
                           F.array_join(F.transform(other, lambda x: x.cast("string")), ","), F.lit(""))
        long = F.size(other) > 256  # hash a long half once, not for every symbol
        return let(let(seed, lambda s: F.when(long, F.sha2(s, 256)).otherwise(s)), move)

    def run(v: Column) -> Column:
        half = F.floor(F.size(v["s"]) / 2).cast("int")

        def rnd(acc: Column, r: Column) -> Column:
            left = F.when(r % 2 == 0, shifted(acc["l"], acc["r"], v["b"], v["t"], r, 0)).otherwise(acc["l"])
            right = F.when(r % 2 == 1, shifted(acc["r"], acc["l"], v["b"], v["t"], r, half)).otherwise(acc["r"])
            return F.struct(left.alias("l"), right.alias("r"))
        start = F.struct(F.slice(v["s"], 1, half).alias("l"),
                         F.slice(v["s"], half + 1, F.size(v["s"]) - half).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, rnd,
                           lambda acc: F.concat(acc["l"], acc["r"]))
    return let(F.struct(symbols.alias("s"), radix.alias("b"), F.concat_ws("|", F.lit(key), tweak).alias("t")), run)


_is = {"0": lambda c: c.between("0", "9"), "a": lambda c: c.between("a", "z"), "A": lambda c: c.between("A", "Z")}


def _chars(text: Column, key: str, kind: str) -> Column:
    """Permute digits and letters within their class; everything else stays."""
    size = lambda c: F.when(_is["0"](c), 10).when(_is["a"](c) | _is["A"](c), 26).otherwise(1).cast("long")
    place = lambda c: (F.when(_is["a"](c), F.ascii(c) - 97).when(_is["A"](c), F.ascii(c) - 65)
                       .when(_is["0"](c), F.ascii(c) - 48).otherwise(0)).cast("long")

    def back(c: Column, s: Column) -> Column:
        pick = lambda letters: F.substring(F.lit(letters), (s + 1).cast("int"), F.lit(1))
        return (F.when(_is["0"](c), pick(DIGITS)).when(_is["a"](c), pick(LOWER)).when(_is["A"](c), pick(UPPER))
                .otherwise(c))

    def permuted(cs: Column) -> Column:
        shape = F.array_join(F.transform(cs, lambda c: F.when(_is["0"](c), "0").when(_is["a"](c), "a")
                                         .when(_is["A"](c), "A").otherwise(c)), "")
        moved = feistel(F.transform(cs, place), F.transform(cs, size), F.concat(F.lit(kind + ":"), shape), key)
        return F.array_join(F.zip_with(cs, moved, back), "")
    return let(_split(text), permuted)


def _digits(value: Column, key: str, kind: str, check: bool = False) -> Column:
    """Permute the digits alone and put them back between the separators, so that
    one number links however it is spaced. ``check``: the last is a Luhn digit."""
    plain = F.regexp_replace(value, "[^0-9]", "")
    if check:
        moved = let(_chars(F.substring(plain, F.lit(1), F.length(plain) - 1), key, kind),
                    lambda m: F.concat(m, ((10 - luhn_total(m, 1) % 10) % 10).cast("string")))
    else:
        moved = _chars(plain, key, kind)

    def spell(m: Column) -> Column:
        step = lambda acc, c: F.struct(
            F.concat(acc["out"], F.when(_is["0"](c), F.substring(m, acc["at"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["at"] + F.when(_is["0"](c), 1).otherwise(0)).alias("at"))
        return F.aggregate(_split(value), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step,
                           lambda acc: acc["out"])
    return let(moved, spell)


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    moved = feistel(octets, F.array_repeat(F.lit(256).cast("long"), 4), F.lit("ip"), key)
    return F.array_join(F.transform(moved, lambda x: x.cast("string")), ".")


def _ip6(value: Column, key: str) -> Column:
    groups = F.transform(_groups(value), lambda x: F.conv(x, 16, 10).cast("long"))
    moved = feistel(groups, F.array_repeat(F.lit(1 << 16).cast("long"), 8), F.lit("ip6"), key)
    return F.array_join(F.transform(moved, lambda x: F.lower(F.hex(x))), ":")


def _date(value: Column, key: str) -> Column:
    """The cycle of 400 years a date lies in stays, the day within it is permuted."""
    days = F.datediff(_day(value), F.lit("2000-01-01").cast("date")).cast("long")
    period = DAYS[0] * DAYS[1]
    start, at = F.floor(days / period) * period, F.pmod(days, F.lit(period))
    moved = feistel(F.array(F.floor(at / DAYS[1]), F.pmod(at, F.lit(DAYS[1]))),
                    F.array(*(F.lit(x).cast("long") for x in DAYS)), F.lit("date"), key)
    day = F.date_add(F.lit("2000-01-01").cast("date"),
                     (start + F.element_at(moved, 1) * DAYS[1] + F.element_at(moved, 2)).cast("int"))
    return (F.when(value.contains("-"), F.date_format(day, "yyyy-MM-dd"))
            .when(value.contains("/"), F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "dd.MM.yyyy")))


def _keep_head(value: Column, head: str, permute) -> Column:
    """Permute what follows the part that ``head`` matches (a key's name, a country code)."""
    lead = F.regexp_extract(value, head, 0)
    return F.concat(lead, permute(F.substring(value, F.length(lead) + 1, F.length(value))))


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    return (F.when(kind == "secret", _keep_head(value, r"(?i)^(?:AKIA|[a-z_]+[\"']? ?[=:] ?[\"']?)",
                                                lambda v: _chars(v, key, "secret")))
            .when(kind == "email", F.concat(_chars(F.regexp_extract(value, r"^(.*)\.", 1), key, "email"),
                                            F.regexp_extract(value, r"\.[A-Za-z]+$", 0)))
            .when(kind == "date", _date(value, key))
            .when(kind == "ip6", _ip6(value, key))
            .when(kind == "ip", _ip(value, key))
            .when(kind == "card", _digits(value, key, "card", check=True))
            .when(kind == "phone", _keep_head(value, r"^(?:\+[0-9]{1,3}(?=[ .(-])|0)?",
                                              lambda v: _digits(v, key, "phone")))
            .when(kind == "ssn", _digits(value, key, "ssn")).otherwise(value))


def pseudonymize(docs: DataFrame, text: str = "text", key: str = KEY, counts: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``counts`` adds n_<kind> and n_pii."""
    found, new = fresh(docs, "pii_found"), fresh(docs, "pii_new")
    one = lambda v: let(kind_of(v), lambda k: F.when(k.isNull() & v.rlike("^[0-9][0-9 -]*[ -][0-9]+$"), parts_of(v))
                        .otherwise(F.array(F.struct(v.alias("v"), k.alias("k")))))
    matched = F.transform(F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0)), one)
    empty = F.array().cast("array<array<struct<v:string,k:string>>>")
    out = docs.withColumn(found, F.when(F.col(text).rlike(PATTERN), matched).otherwise(empty))
    out = out.withColumn(new, F.when(F.size(found) > 0, F.transform(found, lambda ps: F.array_join(
        F.transform(ps, lambda m: pseudonym(m["v"], m["k"], key)), ""))))
    rest = F.split(F.col(text), PATTERN, -1)
    joined = F.array_join(F.zip_with(rest, F.col(new), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = out.withColumn(text, F.when(F.col(new).isNotNull(), joined).otherwise(F.col(text)))
    if counts:
        of = lambda kind: F.size(F.filter(F.flatten(found), lambda m: m["k"] == kind)).cast("long")
        each = {f"n_{k}": of(k) for k in KINDS}
        out = out.withColumns(each)
        out = out.withColumn("n_pii", reduce(lambda a, b: a + b, (F.col(c) for c in each)))
    return out.drop(found, new)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, counts=True)
