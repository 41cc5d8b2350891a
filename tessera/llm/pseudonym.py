"""Format-preserving pseudonyms by keyed Feistel networks (operator 2).

Personal values in a text are found, validated and replaced by another value
of the same format under a secret key. A value's pseudonym depends on the key
and the value alone, so equal values stay linked across documents, and the
permutation can be undone with the key.

Numbers: the value is an index below a * b, split into a half modulo a and a
half modulo b; each of ``ROUNDS`` rounds adds a keyed SHA-256 value of one
half to the other, so the result is a permutation of exactly that domain and
every result is valid again:

- card numbers of 13 to 19 digits with a right check digit: all digits but
  the last are permuted, the check digit is set anew;
- phone numbers of the form +1 (ddd) ddd-dddd: all ten digits;
- social security numbers: area 001-899 without 666, group and serial not 0;
- IPv4 addresses: all 32 bits;
- ISO dates that exist, from 1900-01-01 on for 73,000 days.

Strings (the local part of e-mail addresses, hexadecimal secrets, access key
ids): the halves of the string shift each other's characters within their
class (digit, lower, upper case letter, or hexadecimal digit).

DataFrame functions only; a row is rewritten in place, without any shuffle.

Defined cases: null text stays null; numbers that fail validation stay; rows
without a value are returned as they are; repeated rows give equal rows;
other columns are ignored by the query and kept by ``pseudonymise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: kind -> pattern, in the order in which they are tried at a place
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"(?<![0-9])\+1 ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "card": (
        r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
        r"|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,4}(?:[ -][0-9]{1,3})?)(?![0-9A-Za-z])"
    ),
    "access_key": r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{16,64}(?![0-9A-Za-z])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
DAY0, DAYS = "1900-01-01", 73_000


def keyed(key: str, kind: str, turn: Column, value: Column) -> Column:
    """A 60-bit value of the key, the format, the round and a half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permuted(x: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """The keyed permutation of 0 .. a * b - 1."""
    def turn(halves: Column, k: Column) -> Column:
        left, right = halves["left"], halves["right"]
        return F.struct(
            F.when(k % 2 == 0, F.pmod(left + F.pmod(keyed(key, kind, k, right), a), a)).otherwise(left).alias("left"),
            F.when(k % 2 == 1, F.pmod(right + F.pmod(keyed(key, kind, k, left), b), b)).otherwise(right).alias("right"),
        )

    # not by a double's division, which rounds cards of 17 digits and more
    start = F.struct(F.call_function("div", x, b).alias("left"), F.pmod(x, b).cast("long").alias("right"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda h: h["left"] * b + h["right"])


def shifted(text: Column, hexadecimal: bool, key: str, kind: str) -> Column:
    """The keyed permutation of strings that have the same classes of
    characters at the same places."""
    def move(c: Column, by: Column) -> Column:
        code = F.ascii(c)
        place = lambda first, n: F.char(F.pmod(code - first + by, F.lit(n)) + first)
        if hexadecimal:
            at = F.position(c, F.lit("0123456789abcdef"))
            return F.substring(F.lit("0123456789abcdef"), (F.pmod(at - 1 + by, F.lit(16)) + 1).cast("int"), 1)
        return (
            F.when(c.between("0", "9"), place(48, 10)).when(c.between("a", "z"), place(97, 26))
            .when(c.between("A", "Z"), place(65, 26)).otherwise(c)
        )

    def turn(halves: Column, k: Column) -> Column:
        one, other = halves["one"], halves["other"]
        moved = F.transform(one, lambda c, i: move(c, F.pmod(
            keyed(key, kind, k, F.concat_ws("|", F.array_join(other, ""), i.cast("string"))), F.lit(1 << 30))))
        return F.struct(other.alias("one"), moved.alias("other"))

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    half = F.floor(F.size(chars) / 2).cast("int")
    start = F.struct(F.slice(chars, F.lit(1), half).alias("one"), F.slice(chars, half + 1, F.size(chars)).alias("other"))
    join = lambda h: F.concat(F.array_join(h["one"], ""), F.array_join(h["other"], ""))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, join)


def digit_sum(digits: Column, doubled_from: int) -> Column:
    """Luhn sum of a digit string, doubling every second digit from the right,
    beginning with the last (0) or the one before it (1)."""
    def add(total: Column, c: Column) -> Column:
        d = c["d"].cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(c["i"] % 2 == doubled_from, twice).otherwise(d)

    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.struct(c.alias("d"), i.alias("i")))
    return F.aggregate(each, F.lit(0), add)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _refill(pattern: Column, digits: Column) -> Column:
    """The digits in the places that digits have in ``pattern``."""
    step = lambda acc, c: F.when(
        c.between("0", "9"), F.struct(F.concat(acc["out"], F.substr(digits, acc["n"], F.lit(1))).alias("out"), (acc["n"] + 1).alias("n"))
    ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["n"].alias("n")))
    chars = F.filter(F.split(pattern, ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("n")), step, lambda acc: acc["out"])


def card(value: Column, key: str) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits) - 1
    payload = F.substr(digits, F.lit(1), n).cast("long")
    low = F.floor(n / 2).cast("int")
    fresh = F.lpad(permuted(payload, _power(n - low), _power(low), key, "card").cast("string"), n, "0")
    check = F.pmod(F.lit(10) - digit_sum(fresh, 0) % 10, F.lit(10)).cast("string")
    return F.when(digit_sum(digits, 1) % 10 == 0, _refill(value, F.concat(fresh, check))).otherwise(value)


def phone(value: Column, key: str) -> Column:
    digits = F.substr(F.regexp_replace(value, "[^0-9]", ""), F.lit(2))
    fresh = permuted(digits.cast("long"), F.lit(100_000), F.lit(100_000), key, "phone")
    return _refill(value, F.concat(F.lit("1"), F.lpad(fresh.cast("string"), 10, "0")))


def ssn(value: Column, key: str) -> Column:
    part = lambda at, n: F.substr(value, F.lit(at), F.lit(n)).cast("long")
    area, group, serial = part(1, 3), part(5, 2), part(8, 4)
    right = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    fresh = permuted((place * 99 + group - 1) * 9999 + serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")
    left = F.floor(fresh / 9999)
    new = F.floor(left / 99) + 1
    new = new + F.when(new >= 666, 1).otherwise(0)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.when(right, F.concat_ws("-", pad(new, 3), pad(left % 99 + 1, 2), pad(fresh % 9999 + 1, 4))).otherwise(value)


def ip(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    number = F.aggregate(parts, F.expr("0L"), lambda acc, p: acc * 256 + p)
    fresh = permuted(number, F.lit(65536), F.lit(65536), key, "ip")
    octets = [F.pmod(F.floor(fresh / (1 << s)), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]
    return F.when(F.forall(parts, lambda p: p < 256), F.concat_ws(".", *octets)).otherwise(value)


def date(value: Column, key: str) -> Column:
    day = F.datediff(F.try_to_date(value, "yyyy-MM-dd"), F.lit(DAY0).cast("date")).cast("long")
    fresh = permuted(day, F.lit(250), F.lit(DAYS // 250), key, "date")
    return F.when(day.between(0, DAYS - 1), F.date_format(F.date_add(F.lit(DAY0).cast("date"), fresh.cast("int")), "yyyy-MM-dd")).otherwise(value)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; the value itself if it isn't valid."""
    local, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    ways = {
        "email": F.concat(shifted(local, False, key, "email"), F.lit("@"), host),
        "phone": phone(value, key), "ip": ip(value, key), "date": date(value, key), "ssn": ssn(value, key), "card": card(value, key),
        "access_key": F.concat(F.lit("AKIA"), shifted(F.substr(value, F.lit(5)), False, key, "access_key")),
        "secret": shifted(value, True, key, "secret"),
    }
    out = None
    for kind, new in ways.items():
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), new) if out is None else out.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), new)
    return out.otherwise(value)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the values in text replaced, and n_replaced. Texts with
    neither digit nor @ hold no value and are passed by."""
    pattern = F.lit(ANY)
    maybe = docs.withColumn("_found", F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(F.array().cast("array<string>")))
    fresh = maybe.withColumn("_new", F.transform("_found", lambda v: pseudonym(v, key)))
    pieces = F.zip_with(F.split("text", ANY, -1), F.col("_new"), lambda p, v: F.concat(p, F.coalesce(v, F.lit(""))))
    changed = F.size(F.filter(F.zip_with("_found", "_new", lambda x, y: x != y), lambda z: z)).cast("long")
    return (
        fresh.withColumn("n_replaced", F.coalesce(changed, F.lit(0)).cast("long"))
        .withColumn("text", F.when(F.size("_found") > 0, F.array_join(pieces, "")).otherwise(F.col("text")))
        .drop("_found", "_new")
    )
