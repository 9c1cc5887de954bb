"""Personal data replaced by format-preserving pseudonyms.

What is found and valid is permuted within its own format by a keyed Feistel network: a card number stays a
card number with a right check digit, a date a date, an address an address. The permutation depends on the key and
the value alone, so that equal values stay equal in all documents, and different ones different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import once

ROUNDS = 8

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
SECRET = r"(?<=(?i:password|passwd|secret|api_key|apikey|token)[=:])[^\s\"'#*$%&|!]++"
CLOUD_KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
HEX = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)"
DATE = r"(?<![\d.-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d-])"
PHONE = r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
NATIONAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d+])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
KINDS = {
    "email": EMAIL, "secret": SECRET, "cloud_key": CLOUD_KEY, "hex": HEX, "address": ADDRESS, "date": DATE,
    "phone": PHONE, "national": NATIONAL, "card": CARD,
}
PATTERN = "|".join(KINDS.values())
#: Every kind has one of these.
HINT = r"[0-9@=:]"

#: One cycle of the calendar from 1800 on, as pairs of the two factors of its number of days.
EPOCH, DAY_FACTORS = "1800-01-01", (189, 773)


def _pad(round_: Column, half: Column, tweak: str, key: str) -> Column:
    parts = [F.lit(key), F.lit(tweak), round_.cast("string"), F.array_join(half.cast("array<string>"), ",")]
    return F.sha2(F.concat_ws(":", *parts).cast("binary"), 256)


def _add(half: Column, pad: Column, radix: int) -> Column:
    """Adds two bytes of the pad to each symbol, modulo the radix. Halves of over 16 symbols use the pad again."""
    shift = lambda i: F.conv(F.substring(pad, (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
    return F.transform(half, lambda s, i: (s + shift(i)) % radix)


def feistel(symbols: Column, tweak: str, key: str, radix: int, other: int | None = None) -> Column:
    """Permutes an array of symbols below `radix`; the second half's are below `other` if that is given.

    Each round adds to one half a pad made of the key, the round and the other half. That can be undone for any
    pad, so different arrays of a length always become different ones.
    """
    middle = F.size(symbols).cast("int").bitwiseAND(F.lit(~0))
    middle = F.floor(middle / 2).cast("int")
    start = F.struct(
        F.slice(symbols, 1, middle).alias("a"), F.slice(symbols, middle + 1, F.size(symbols) - middle).alias("b")
    )

    def turn(s: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, _add(s.a, _pad(i, s.b, tweak, key), radix)).otherwise(s.a)
        right = F.when(i % 2 == 1, _add(s.b, _pad(i, s.a, tweak, key), other or radix)).otherwise(s.b)
        return F.struct(left.alias("a"), right.alias("b"))

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, turn, lambda s: F.concat(s.a, s.b))


def _class(text: Column, members: str, radix: int, first: int, tweak: str, key: str) -> Column:
    """Permutes the characters of a class (consecutive from the code `first`) and leaves all others in place."""
    found = F.regexp_extract_all(text, F.lit(members), F.lit(0))
    symbols = F.transform(found, lambda c: F.ascii(c) - first)

    def put(new: Column) -> Column:
        letters = F.transform(new, lambda s: F.char(s + first))
        return F.array_join(F.zip_with(F.split(text, members, -1), F.array_append(letters, F.lit("")), lambda a, b: F.concat(a, b)), "")

    return once(feistel(symbols, tweak, key, radix), put)


def by_class(text: Column, tweak: str, key: str) -> Column:
    """Permutes digits among digits, small letters among small letters, capitals among capitals."""
    digits = _class(text, "[0-9]", 10, ord("0"), f"{tweak}/0", key)
    small = once(digits, lambda t: _class(t, "[a-z]", 26, ord("a"), f"{tweak}/a", key))
    return once(small, lambda t: _class(t, "[A-Z]", 26, ord("A"), f"{tweak}/A", key))


def digits_of(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("[0-9]"), F.lit(0)), lambda d: d.cast("int"))


def luhn_sum(digits: Column) -> Column:
    """Sum of digits in which every second, from the last but one, is doubled; a valid number's is divisible by 10."""
    n = F.size(digits)
    doubled = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 0, (d * 2) % 10 + F.floor(d * 2 / 10).cast("int")).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d)


def _put_digits(text: Column, digits: Column) -> Column:
    put = F.array_append(digits.cast("array<string>"), F.lit(""))
    return F.array_join(F.zip_with(F.split(text, "[0-9]", -1), put, lambda a, b: F.concat(a, b)), "")


def _card(text: Column, key: str) -> Column:
    def checked(body: Column) -> Column:
        whole = F.array_append(body, F.lit(0))
        return F.array_append(body, (10 - luhn_sum(whole) % 10) % 10)

    body = lambda d: feistel(F.slice(d, 1, F.size(d) - 1), "card", key, 10)
    return _put_digits(text, once(once(digits_of(text), body), checked))


def _address(text: Column, key: str) -> Column:
    octets = F.transform(F.split(text, "[.]"), lambda o: o.cast("int"))
    return F.array_join(feistel(octets, "address", key, 256).cast("array<string>"), ".")


def _hex(text: Column, key: str) -> Column:
    symbols = F.transform(F.regexp_extract_all(text, F.lit("."), F.lit(0)), lambda c: F.conv(c, 16, 10).cast("int"))
    made = F.array_join(F.transform(feistel(symbols, "hex", key, 16), lambda s: F.lower(F.hex(s))), "")
    return F.when(text == F.lower(text), made).otherwise(F.upper(made))


def _day(text: Column) -> Column:
    """Day of the cycle that a date names; null if it names none."""
    iso = F.when(text.contains("-"), text).when(
        text.contains("."), F.regexp_replace(text, r"(\d\d).(\d\d).(\d{4})", "$3-$2-$1")
    )
    # Of dates with slashes, month first if that is a month, else day first.
    american = F.regexp_replace(text, r"(\d\d).(\d\d).(\d{4})", "$3-$1-$2")
    iso = iso.otherwise(F.when(F.substring(text, 1, 2) <= "12", american).otherwise(F.regexp_replace(text, r"(\d\d).(\d\d).(\d{4})", "$3-$2-$1")))
    day = F.date_diff(F.try_to_date(iso, "yyyy-MM-dd"), F.lit(EPOCH).cast("date"))
    return F.when(day.between(0, DAY_FACTORS[0] * DAY_FACTORS[1] - 1), day)


def _date(text: Column, key: str) -> Column:
    big, small = DAY_FACTORS

    def made(d: Column) -> Column:
        pair = feistel(F.array(F.floor(d / small).cast("int"), d % small), "date", key, big, small)
        return once(pair, lambda p: F.date_add(F.lit(EPOCH).cast("date"), F.get(p, F.lit(0)) * small + F.get(p, F.lit(1))))

    def written(day: Column) -> Column:
        day_first = F.substring(text, 1, 2) > "12"
        slashed = F.when(day_first & (F.dayofmonth(day) > 12), F.date_format(day, "dd/MM/yyyy")).otherwise(
            F.date_format(day, "MM/dd/yyyy")
        )
        return F.when(text.contains("-"), F.date_format(day, "yyyy-MM-dd")).when(
            text.contains("."), F.date_format(day, "dd.MM.yyyy")
        ).otherwise(slashed)

    return once(once(_day(text), made), written)


def kind_of(text: Column) -> Column:
    """Which kind a find is of; null if it is none that is valid."""
    is_ = lambda name: text.rlike(f"^(?:{KINDS[name]})$")
    digits = digits_of(text)
    return (
        F.when(is_("email"), "email")
        .when(is_("cloud_key"), "cloud_key")
        .when(is_("address"), "address")
        .when(is_("date"), F.when(_day(text).isNotNull(), "date"))
        .when(is_("phone"), F.when(F.size(digits).between(8, 15), "phone"))
        .when(is_("national"), "national")
        .when(is_("card"), F.when(once(digits, luhn_sum) % 10 == 0, "card"))
        .when(is_("hex"), "hex")
        .otherwise("secret")
    )


def pseudonym(text: Column, kind: Column, key: str) -> Column:
    at = F.instr(text, "@")
    local = F.substring(text, F.lit(1), at - 1)
    code = F.regexp_extract(text, r"^\+\d{1,3}(?=[ .(-])|^\+\d", 0)
    return (
        F.when(kind == "email", F.concat(by_class(local, "email", key), F.substring(text, at, F.length(text))))
        .when(kind == "cloud_key", F.concat(F.lit("AKIA"), by_class(F.substring(text, 5, 16), "cloud_key", key)))
        .when(kind == "address", _address(text, key))
        .when(kind == "date", _date(text, key))
        .when(kind == "phone", F.concat(code, _class(F.substring(text, F.length(code) + 1, F.length(text)), "[0-9]", 10, ord("0"), "phone", key)))
        .when(kind == "national", _class(text, "[0-9]", 10, ord("0"), "national", key))
        .when(kind == "card", _card(text, key))
        .when(kind == "hex", _hex(text, key))
        .when(kind == "secret", by_class(text, "secret", key))
        .otherwise(text)
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """One row per row of `docs`: doc_id, text, n_replaced, kinds (of what was replaced, in order).

    `key` is a secret: who knows it can undo the permutation, and the same key gives the same pseudonyms.

    Emails (the part before the @), secrets after `password=` and the like, cloud keys, long hexadecimal numbers,
    IPv4 addresses, dates from 1800 to 2199, international phone numbers (all but the country code), national numbers
    of the form 3-2-4 and card numbers with a right check digit. What looks alike but is not valid stays. A date with
    slashes whose first part is no month is written day first where that tells it apart. Null texts stay null, all
    others without a find stay as they are. Rows that repeat are replaced one by one. Other columns are ignored,
    whatever their names. An empty table gives an empty result.
    """
    hit = F.col("text").rlike(HINT) & F.col("text").rlike(PATTERN)
    nothing = F.array().cast("array<string>")
    found = docs.select(
        "doc_id", "text", F.when(hit, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(nothing).alias("found")
    )
    kinds = found.withColumn("all_kinds", F.transform("found", kind_of))
    made = kinds.withColumn("made", F.zip_with("found", "all_kinds", lambda t, k: pseudonym(t, k, key)))
    pieces = F.split("text", PATTERN, -1)
    joined = F.array_join(F.zip_with(pieces, F.array_append("made", F.lit("")), lambda a, b: F.concat(a, b)), "")
    return made.select(
        "doc_id",
        F.when(F.size("found") > 0, joined).otherwise(F.col("text")).alias("text"),
        F.size(F.array_compact("all_kinds")).alias("n_replaced"),
        F.array_compact("all_kinds").alias("kinds"),
    )
