"""Format-preserving pseudonyms by keyed Feistel networks, in DataFrame functions alone.

Validated values are permuted within the set of valid values of their format, so equal values stay equal in all
documents, different ones stay different, and the key's holder could undo it:

    card     13 to 19 digits with a correct check digit: all digits between the first and the check digit are permuted
    phone    numbers of the North American plan among those whose area and exchange codes are likewise assignable or not,
             others with a country code among its digits
    ipv4     among all addresses
    ssn      among all assignable numbers
    date     among all days of 1800 to 2199, in the same notation
    email    letters and digits of the local part, each within its class

Numbers are split into coordinates (l, r) of Z_a x Z_b, and rounds add a keyed hash of one to the other, modulo its size,
so that the permuted set is exactly the valid one.  Text is split into halves, and rounds shift every letter and digit of one
half within its class by a keyed hash of the other.  Values that fail validation stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rewriting import matches, rebuilt

KINDS = ("email", "ipv4", "ssn", "date", "phone", "card")
ROUNDS = 8
KEY_SETTING = "spark.motionloom.pseudonymKey"
# Notations, in the order in which they are tried at a place.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"(?<![\w.-])\d{1,3}(?:\.\d{1,3}){3}(?![\w-]|\.\d)"
SSN = r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])"
ISO_DATE = r"(?<![\w.-])\d{4}-\d{2}-\d{2}(?![\w-])"
LOCAL_DATE = r"(?<![\w./-])\d{2}([./])\d{2}\1\d{4}(?![\w/-])"
NANP = r"(?<![\w.+-])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
ABROAD = r"(?<![\w.+-])\+[2-9]\d{0,2}(?:[ .-]?\(?\d+\)?){2,6}(?![\w-])"
CARD = r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])"
PATTERN = "|".join((EMAIL, IPV4, SSN, ISO_DATE, LOCAL_DATE, NANP, ABROAD, CARD))
FIRST_DAY, DAYS = "1800-01-01", (27, 5_411)  # 400 years of the Gregorian calendar have 27 * 5411 days
IPV4_SIZES, SSN_SIZES = (65_536, 65_536), (898 * 99, 9_999)
#: First values and numbers of area and exchange codes: assignable, area code not assignable, exchange code not.
NANP_CLASSES = (((200, 800), (200, 800)), ((0, 200), (0, 1000)), ((200, 800), (0, 200)))


def _keyed(key: Column, kind: str, turn: Column, value: Column, digits: int = 15, at: Column | int = 1) -> Column:
    """Number from hex digits of the hash of key, kind, round and value."""
    hashed = F.sha2(F.concat_ws("|", key, F.lit(kind), turn.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(hashed, at, digits) if isinstance(at, int) else F.substr(hashed, at, F.lit(digits)), 16, 10).cast("long")


def permuted_number(key: Column, kind: str, value: Column, sizes: tuple[int, int]) -> Column:
    """A permutation of 0 to sizes[0] * sizes[1] - 1."""
    a, b = sizes
    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, F.lit(b)).cast("long").alias("r"))
    turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(x: Column, turn: Column) -> Column:
        left = F.pmod(x["l"] + _keyed(key, kind, turn, x["r"]), F.lit(a))
        right = F.pmod(x["r"] + _keyed(key, kind, turn, x["l"]), F.lit(b))
        return F.struct(F.when(turn % 2 == 0, left).otherwise(x["l"]).cast("long").alias("l"), F.when(turn % 2 == 1, right).otherwise(x["r"]).cast("long").alias("r"))

    return F.aggregate(turns, start, step, lambda x: x["l"] * b + x["r"])


def _chars(t: Column) -> Column:
    return F.filter(F.split(t, ""), lambda c: c != "")


def _shifted(c: Column, by: Column) -> Column:
    out = c
    for first, size in (("a", 26), ("A", 26), ("0", 10)):
        last = chr(ord(first) + size - 1)
        out = F.when(c.between(first, last), F.char(F.ascii(c) - ord(first) + F.pmod(by, F.lit(size)) - F.when(F.ascii(c) - ord(first) + F.pmod(by, F.lit(size)) >= size, size).otherwise(0) + ord(first))).otherwise(out)
    return out


def permuted_text(key: Column, kind: str, t: Column) -> Column:
    """A permutation of the texts with the same classes of characters (ASCII letters of either case, digits, others) at each place."""
    half = F.floor(F.length(t) / 2).cast("int")
    start = F.struct(F.substr(t, F.lit(1), half).alias("l"), F.substr(t, half + 1, F.length(t)).alias("r"))

    def shifted(part: Column, other: Column, turn: Column) -> Column:
        by = lambda k: _keyed(key, kind, turn, F.concat_ws("|", F.floor(k / 8).cast("string"), other), 8, (8 * (k % 8) + 1).cast("int"))
        return F.array_join(F.transform(_chars(part), lambda c, k: _shifted(c, by(k))), "")

    def step(x: Column, turn: Column) -> Column:
        return F.struct(F.when(turn % 2 == 0, shifted(x["l"], x["r"], turn)).otherwise(x["l"]).alias("l"), F.when(turn % 2 == 1, shifted(x["r"], x["l"], turn)).otherwise(x["r"]).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda x: F.concat(x["l"], x["r"]))


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _filled(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced by ``digits`` in order."""
    return F.array_join(F.transform(_chars(template), lambda c, k: F.when(
        c.between("0", "9"), F.substr(digits, F.length(_digits(F.substr(template, F.lit(1), k + 1))), F.lit(1))).otherwise(c)), "")


def luhn_sum(digits: Column) -> Column:
    doubled = F.transform(_chars(F.reverse(digits)), lambda c, k: F.when(k % 2 == 0, c.cast("int")).otherwise(2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda total, x: (total + x).cast("int")) % 10


def _card(key: Column, m: Column) -> tuple[Column, Column]:
    d = _digits(m)
    body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permuted_text(key, "card", F.substr(d, F.lit(2), F.length(d) - 2)))
    check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))), F.lit(10))
    return luhn_sum(d) == 0, _filled(m, F.concat(body, check.cast("string")))


def _part(d: Column, first: Column | int, length: int) -> Column:
    return F.substr(d, F.lit(first) if isinstance(first, int) else first, F.lit(length)).cast("long")


def _nanp(key: Column, m: Column) -> tuple[Column, Column]:
    d = _digits(m)
    at = F.length(d) - 10
    area, exchange, line = _part(d, at + 1, 3), _part(d, at + 4, 3), _part(d, at + 7, 4)
    ten = F.substr(d, at + 1, F.lit(10))
    for (first_area, areas), (first_exchange, exchanges) in NANP_CLASSES:
        inside = area.between(first_area, first_area + areas - 1) & exchange.between(first_exchange, first_exchange + exchanges - 1)
        new = permuted_number(key, "phone", ((area - first_area) * exchanges + exchange - first_exchange) * 10_000 + line, (areas * 100, exchanges * 100))
        codes = F.floor(new / 10_000)
        ten = F.when(inside, F.concat(_padded(F.floor(codes / exchanges) + first_area, 3), _padded(F.pmod(codes, F.lit(exchanges)) + first_exchange, 3),
                                      _padded(F.pmod(new, F.lit(10_000)), 4))).otherwise(ten)
    return F.lit(True), _filled(m, F.concat(F.substr(d, F.lit(1), at), ten))


def _abroad(key: Column, m: Column) -> tuple[Column, Column]:
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}", 0)
    return F.length(_digits(m)).between(8, 15), F.concat(code, permuted_text(key, "abroad", F.substr(m, F.length(code) + 1, F.length(m))))


def _ipv4(key: Column, m: Column) -> tuple[Column, Column]:
    parts = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    new = permuted_number(key, "ipv4", F.aggregate(parts, F.lit(0).cast("long"), lambda total, x: total * 256 + x), IPV4_SIZES)
    octets = [F.pmod(F.floor(new / 256 ** k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)]
    return F.forall(parts, lambda x: x < 256), F.concat_ws(".", *octets)


def _ssn(key: Column, m: Column) -> tuple[Column, Column]:
    area, group, serial = _part(m, 1, 3), _part(m, 5, 2), _part(m, 8, 4)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    new = permuted_number(key, "ssn", (place * 99 + group - 1) * 9_999 + serial - 1, SSN_SIZES)
    head = F.floor(new / 9_999)
    place = F.floor(head / 99)
    area_of = place + 1 + F.when(place >= 665, 1).otherwise(0)
    return (area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0),
            F.concat_ws("-", _padded(area_of, 3), _padded(F.pmod(head, F.lit(99)) + 1, 2), _padded(F.pmod(new, F.lit(9_999)) + 1, 4)))


def _date(key: Column, m: Column) -> tuple[Column, Column]:
    iso = m.substr(5, 1) == "-"
    first, second = _part(m, 1, 2), _part(m, 4, 2)
    month_first = (m.substr(3, 1) == "/") & (first <= 12)  # month/day, unless only day/month can be meant
    year = F.when(iso, m.substr(1, 4)).otherwise(m.substr(7, 4)).cast("int")
    month = F.when(iso, m.substr(6, 2)).when(month_first, m.substr(1, 2)).otherwise(m.substr(4, 2)).cast("int")
    day = F.when(iso, m.substr(9, 2)).when(month_first, m.substr(4, 2)).otherwise(m.substr(1, 2)).cast("int")
    plausible = year.between(1800, 2199) & month.between(1, 12) & (day >= 1)
    valid = F.when(plausible, day <= F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))).otherwise(F.lit(False))
    days = F.datediff(F.when(valid, F.make_date(year, month, day)), F.to_date(F.lit(FIRST_DAY))).cast("long")
    new = F.date_add(F.to_date(F.lit(FIRST_DAY)), permuted_number(key, "date", days, DAYS).cast("int"))
    y, mo, d = _padded(F.year(new), 4), _padded(F.month(new), 2), _padded(F.dayofmonth(new), 2)
    mark = m.substr(3, 1)
    local = F.when(month_first, F.concat(mo, mark, d, mark, y)).otherwise(F.concat(d, mark, mo, mark, y))
    return valid, F.when(iso, F.concat_ws("-", y, mo, d)).otherwise(local)


def _email(key: Column, m: Column) -> tuple[Column, Column]:
    at = F.instr(m, "@")
    return F.lit(True), F.concat(permuted_text(key, "email", F.substr(m, F.lit(1), at - 1)), F.substr(m, at, F.length(m)))


def _replaced(key: Column, m: Column) -> Column:
    """Kind (NULL: not valid) and new text of a match."""
    notations = ((m.contains("@"), "email", _email), (m.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "ipv4", _ipv4), (m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn", _ssn),
                 (m.rlike(r"^\d{4}-\d{2}-\d{2}$|^\d{2}[./]\d{2}[./]\d{4}$"), "date", _date), (m.rlike(f"^(?:{NANP})$"), "phone", _nanp),
                 (m.rlike(r"^\+"), "phone", _abroad), (F.lit(True), "card", _card))
    unchanged = F.struct(F.lit(None).cast("string").alias("kind"), m.alias("new"))
    out = unchanged
    for applies, kind, make in reversed(notations):
        valid, new = make(key, m)
        out = F.when(applies, F.when(valid, F.struct(F.lit(kind).alias("kind"), new.alias("new"))).otherwise(unchanged)).otherwise(out)
    return out


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and the number of values replaced, n_email to n_card.

    A NULL text stays NULL and has no values; repeated rows and NULL ids are treated like any other.  Columns named as the counts
    are replaced, all others are kept.
    """
    counts = [f"n_{kind}" for kind in KINDS]
    names = [c for c in docs.columns if c not in counts]
    text, keyed = F.col("text"), F.lit(key)
    found = docs.select(*names).withColumn("_motionloom_found", F.when(text.rlike("[0-9@]"), matches(text, PATTERN)).otherwise(F.array().cast("array<string>")))
    found = found.withColumn("_motionloom_found", F.transform("_motionloom_found", lambda m: _replaced(keyed, m)))
    made = found.withColumn("text", rebuilt(text, PATTERN, F.col("_motionloom_found"), lambda m: m["new"]))
    return made.select(*names, *(F.coalesce(_number(kind), F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS))


def _number(kind: str) -> Column:
    return F.size(F.filter("_motionloom_found", lambda m: m["kind"] == kind))
