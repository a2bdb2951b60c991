"""Personal data: format-preserving Feistel pseudonyms, with DataFrame functions only.

Candidates are found by one regular expression and validated (Luhn for card numbers, mod 97 for account numbers, octets,
calendar dates, area rules). What is valid is permuted by a keyed Feistel network inside its own format: digits stay
digits, letters letters, separators and lengths stay, check digits are worked out anew, dates stay dates. Equal values
get equal pseudonyms in every document, and different values of one format get different pseudonyms. Account, card and phone
numbers are equal however they are separated; a phone number with its country's code (which stays, also "(0)" after it) gets
the digits that it gets without; addresses are equal without regard to letter case, which stays where it is, and keep their
domain. Whoever has the key can undo it.

Two networks do all the work. One permutes a string of digits and letters character by character: the halves take turns
at being shifted, each position by what SHA-256 of key, kind, round and the other half gives. The other permutes whole
numbers below a * b: the parts modulo a and modulo b take turns at having such a hash added.

Defined results: a null text stays null and has no finds, an empty one is empty; a text of any length is searched whole, in
its own row; what looks like a number but fails its check stays as it is, and so do dates with the month first (12/25/2020:
out of scope, as 03/04/2020 would have two readings; day first is what is read); where candidates overlap, the one that
starts first counts, and of those that start at the same place the kind that PATTERN lists first; columns named pii_counts
and the text column are replaced, all others pass; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8  # even: the halves end where they began

# What candidates look like. Lookbehinds keep the search from starting inside a word or number.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\(0\)[ .-]?)?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
#: Country codes: those of one and two digits; all others have three.
CALLING = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
LOCAL_PHONE = r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9]|[.-][0-9])"
#: Lengths of account numbers by country: what follows one is never taken for a part of it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_BY_COUNTRY = "|".join(
    f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items()
)
# Other countries, and other lengths, as long as it goes.
IBAN = rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_BY_COUNTRY}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])"
DATE = r"(?<![0-9])(?:(?:1[89]|2[01])[0-9]{2}-[01][0-9]-[0-3][0-9]|[0-3][0-9][./][01][0-9][./](?:1[89]|2[01])[0-9]{2})(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
KINDS = ("email", "ip", "iban", "phone", "date", "ssn", "card")
PATTERN = "|".join((EMAIL, IP, IBAN, PHONE, LOCAL_PHONE, DATE, SSN, CARD))
#: Days from 1800-01-01 to 2199-12-31: 400 Gregorian years are 189 * 773 days.
FIRST_DAY, DAYS = "1800-01-01", (189, 773)


def _digest(key: str, kind: str, turn: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value).cast("binary"), 256)


def _number(digest: Column, modulus: Column) -> Column:
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), modulus)


def permute_number(x: Column, a: int, b: int, key: str, kind: str) -> Column:
    """A keyed permutation of 0 .. a * b - 1."""

    def step(acc: Column, turn: Column) -> Column:
        shift = _number(_digest(key, kind, turn, acc["v"].cast("string")), acc["mu"])
        return F.struct(acc["v"].alias("u"), F.pmod(acc["u"] + shift, acc["mu"]).alias("v"), acc["mv"].alias("mu"), acc["mu"].alias("mv"))

    long = lambda c: c.cast("long")
    start = F.struct(long(F.floor(x / b)).alias("u"), long(x % b).alias("v"), long(F.lit(a)).alias("mu"), long(F.lit(b)).alias("mv"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["u"] * b + s["v"])


def _shift(text: Column, digest: Column) -> Column:
    """Each digit and letter moved inside its alphabet by two hexadecimal digits of the digest (32 positions, then again)."""

    def one(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(digest, 2 * (i % 32) + 1, 2), 16, 10).cast("int")
        code = F.ascii(c)
        turn = lambda low, n: F.char(low + F.pmod(code - low + by, F.lit(n)))
        return F.when(c.between("0", "9"), turn(48, 10)).when(c.between("a", "z"), turn(97, 26)).when(c.between("A", "Z"), turn(65, 26)).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def permute_text(text: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the strings that have digits and letters in the same places."""
    half = F.floor(F.length(text) / 2).cast("int")

    def step(acc: Column, turn: Column) -> Column:
        return F.struct(acc["v"].alias("u"), _shift(acc["u"], _digest(key, kind, turn, acc["v"])).alias("v"))

    start = F.struct(F.substring(text, F.lit(1), half).alias("u"), F.substring(text, half + 1, F.length(text)).alias("v"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["u"], s["v"]))


def _like(original: Column, plain: Column, kept: str) -> Column:
    """``plain`` laid into the places of ``original`` that match ``kept``; everything else stays."""

    def step(acc: Column, c: Column) -> Column:
        mine = c.rlike(kept)
        return F.struct(
            F.concat(acc["s"], F.when(mine, F.substring(plain, acc["k"], F.lit(1))).otherwise(c)).alias("s"),
            (acc["k"] + F.when(mine, 1).otherwise(0)).alias("k"),
        )

    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))
    return F.aggregate(F.split(original, ""), start, step, lambda a: a["s"])


def _cased(original: Column, plain: Column) -> Column:
    """``plain`` with capital letters where ``original`` has them."""
    letters = F.filter(F.split(original, ""), lambda c: c != "")
    at = lambda i: F.substring(plain, i + 1, F.lit(1))
    return F.array_join(F.transform(letters, lambda c, i: F.when(c.between("A", "Z"), F.upper(at(i))).otherwise(at(i))), "")


def _luhn(digits: Column, last: int) -> Column:
    """Luhn sum of a string of digits; ``last`` 0 if its last digit is the check digit, 1 if the one before it."""
    # From the right, every second digit counts twice, less 9 if that makes two digits.
    reverse = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    worth = F.transform(reverse, lambda c, i: F.when((i + last) % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x)


def _mod97(text: Column) -> Column:
    """Account number moved by four, letters as 10 to 35, modulo 97."""
    moved = F.split(F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4)), "")

    def step(acc: Column, c: Column) -> Column:
        letter = acc * 100 + F.ascii(c) - 55
        return F.pmod(F.when(c == "", acc).when(c.between("0", "9"), acc * 10 + F.ascii(c) - 48).otherwise(letter), F.lit(97))

    return F.aggregate(moved, F.lit(0), step)


def _day(m: Column) -> Column:
    iso = m.substr(5, 1) == "-"
    shape = F.when(iso, m).otherwise(F.concat_ws("-", m.substr(7, 4), m.substr(4, 2), m.substr(1, 2)))
    return F.try_to_timestamp(shape, F.lit("yyyy-MM-dd")).cast("date")


def pseudonym(m: Column, key: str) -> Column:
    """(kind, value) of a candidate; kind is null, and the value unchanged, if it fails its check."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    name = F.substring_index(m, "@", 1)
    mail = F.concat(_cased(name, permute_text(F.lower(name), key, "email")), F.lit("@"), F.substring_index(m, "@", -1))

    octets = F.transform(F.split(m, r"\."), lambda c: c.cast("long"))
    address = permute_number(F.aggregate(octets, F.lit(0).cast("long"), lambda a, x: a * 256 + x), 65536, 65536, key, "ip")
    part = lambda n: F.pmod(F.shiftright(address, n), F.lit(256)).cast("string")
    ip = F.concat_ws(".", part(24), part(16), part(8), part(0))

    plain = F.regexp_replace(m, " ", "")
    body = permute_text(F.substring(plain, F.lit(5), F.length(plain)), key, "iban")
    check = F.lpad((98 - _mod97(F.concat(F.substring(plain, 1, 2), F.lit("00"), body))).cast("string"), 2, "0")
    iban = _like(m, F.concat(F.substring(plain, 1, 2), check, body), "[A-Z0-9]")

    # The country code stays, and the zero that some write behind it; digits after them are permuted, with or without alike.
    code = F.when(m.startswith("+"), F.regexp_extract(digits, f"^(?:{CALLING})", 0)).otherwise("")
    kept = F.when(F.contains(m, F.lit("(0)")), F.concat(code, F.lit("0"))).otherwise(code)
    rest = F.substring(digits, F.length(kept) + 1, F.length(digits))
    phone = _like(m, F.concat(kept, permute_text(rest, key, "phone")), "[0-9]")

    a, b = DAYS
    number = F.datediff(_day(m), F.lit(FIRST_DAY).cast("date")).cast("long")
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), permute_number(number, a, b, key, "date").cast("int"))
    sep = m.substr(3, 1)
    date = F.when(m.substr(5, 1) == "-", F.date_format(moved, "yyyy-MM-dd")).otherwise(F.concat_ws("", F.date_format(moved, "dd"), sep, F.date_format(moved, "MM"), sep, F.date_format(moved, "yyyy")))

    # 898 areas (001-899 but 666), 99 groups, 9999 serials.
    area, group, serial = (m.substr(s, n).cast("long") for s, n in ((1, 3), (5, 2), (8, 4)))
    index = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
    other = permute_number(index, 898 * 99, 9999, key, "ssn")
    at = F.floor(other / (99 * 9999)) + 1
    pad = lambda c, n: F.lpad(c.cast("long").cast("string"), n, "0")
    ssn = F.concat_ws("-", pad(F.when(at >= 666, at + 1).otherwise(at), 3), pad(F.floor(other / 9999) % 99 + 1, 2), pad(other % 9999 + 1, 4))
    real = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)

    payload = permute_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    card = _like(m, F.concat(payload, F.pmod(-_luhn(payload, 1), F.lit(10)).cast("string")), "[0-9]")

    pick = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return (
        F.when(F.contains(m, F.lit("@")), pick("email", mail))
        .when(whole(IP) & F.forall(octets, lambda x: x <= 255), pick("ip", ip))
        .when(whole(IBAN) & (_mod97(plain) == 1), pick("iban", iban))
        .when(m.startswith("+") | whole(LOCAL_PHONE), pick("phone", phone))
        .when(whole(DATE) & _day(m).isNotNull(), pick("date", date))
        .when(whole(SSN) & real, pick("ssn", ssn))
        .when(whole(CARD) & (_luhn(digits, 0) % 10 == 0), pick("card", card))
        .otherwise(F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value")))
    )


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the text's personal data replaced by pseudonyms and pii_counts, a map from kind to finds."""
    t = F.col(f"`{text}`")
    some = t.rlike("[0-9@]")  # every kind has one or the other
    found = F.when(some, F.regexp_extract_all(t, F.lit(PATTERN), 0))
    cols = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols if c != text and c.lower() != "pii_counts"], F.lit(0).alias("__0")).alias("__doc"), t.alias("__t"), found.alias("__m"))
    done = F.when(F.size("__m") > 0, F.transform("__m", lambda m: pseudonym(m, key)))
    packed = packed.withColumn("__p", done)
    gaps = F.split("__t", PATTERN, -1)
    new = F.array_join(F.zip_with(gaps, F.concat(F.transform("__p", lambda p: p["value"]), F.array(F.lit(""))), lambda g, v: F.concat(g, v)), "")
    count = lambda k: F.size(F.filter("__p", lambda p: p["kind"] == k))
    counts = F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k in KINDS]), F.array(*[count(k) for k in KINDS])), lambda _, n: n > 0)
    none = F.expr("cast(map() as map<string, int>)")
    hit = F.col("__p").isNotNull()
    out = packed.select("__doc", F.when(hit, new).otherwise(F.col("__t")).alias("__new"), F.when(hit, counts).otherwise(none).alias("pii_counts"))
    return out.select(*[F.col("__new").alias(c) if c == text else F.col(f"__doc.`{c}`") for c in cols if c.lower() != "pii_counts"], "pii_counts")
