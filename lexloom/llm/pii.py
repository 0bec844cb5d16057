"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses, with DataFrame functions alone.

Candidates are found by one pattern and validated (Luhn, mod 97, number plan, octets, calendar); a valid one is permuted
by a keyed Feistel network over exactly the values of its format, so equal values get equal pseudonyms in every document
and different values different ones. What is not valid stays as it is, and so does all other text.

Everything is a projection: no shuffle, no Python on executors. Defined cases: a null text stays null with no values; a
null id stays null; repeated rows give repeated rows; other columns are kept by `pseudonymise` and its two added columns
(`pii_values`, `pii_kinds`) replace any of that name; an empty table gives an empty result.
"""

from __future__ import annotations

import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused

ROUNDS = 8
#: Dates are permuted within spans of 400 years, from 0200-01-01 on: their 146,097 days are 189 x 773. What is before the
#: first of the 24 spans (0001 to 0199, 72,683 days) and after the last (9800 to 9999, 73,048 days) are spans too.
FIRST_DAY, SPAN, SPANS = "0200-01-01", 146_097, 24
DAYS, DAYS_BEFORE, DAYS_AFTER = (189, 773), (13, 5591), (8, 9131)

NOT_BEFORE, NOT_AFTER = r"(?<![\p{L}\p{N}_])(?<!\p{N}[.,-])", r"(?![\p{L}\p{N}_])"
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])(?=[A-Za-z0-9])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})(?:\.[A-Za-z0-9-]{1,63}){0,5}\.[A-Za-z]{2,24}",
    "iban": NOT_BEFORE + r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + NOT_AFTER,
    "date": NOT_BEFORE + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})" + NOT_AFTER + r"(?![.,/-][0-9])",
    "ip": NOT_BEFORE + r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}" + NOT_AFTER + r"(?!\.[0-9])",
    "ssn": NOT_BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + NOT_AFTER + r"(?!-[0-9])",
    "card": NOT_BEFORE + r"(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})" + NOT_AFTER + r"(?!-[0-9])",
    "phone": r"(?<![\p{L}\p{N}_+.])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}" + NOT_AFTER + r"(?![.-][0-9])",
    "intl": r"(?<![\p{L}\p{N}_+.])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,12}(?:[ .-][0-9]{2,5}(?!\.[0-9])){0,4}" + NOT_AFTER,
}
#: Without addresses; the look-ahead passes over letters, which are most of a text.
NUMBERS = "(?=[A-Z0-9+(])(?:" + "|".join(f"(?:{p})" for kind, p in KINDS.items() if kind != "email") + ")"
PATTERN = f"(?:{KINDS['email']})|{NUMBERS}"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def number(value: Column) -> Column:
    """A digit string as a number; empty is 0."""
    return F.coalesce(F.expr("null").cast("long"), F.when(F.length(value) > 0, value.cast("long")), F.lit(0))


def keyed(key: str, tag: str, *parts: Column) -> Column:
    """48 keyed bits of the parts. Plans hold a key that is derived for the tag (HMAC-SHA-256), never the secret itself."""
    joined = F.concat_ws("|", F.lit(derived(key, tag)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(joined, 256), 1, 12), 16, 10).cast("long")


def derived(key: str, tag: str) -> str:
    return hmac.new(key.encode(), b"pseudonyms/" + tag.encode(), "sha256").hexdigest()


def feistel(left: Column, right: Column, radix_left: Column, radix_right: Column, key: str, tag: str) -> Column:
    """Permute pairs of a left below one radix and a right below another: struct<left, right>."""
    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))

    def turn(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, (acc["left"] + keyed(key, tag, i, acc["right"])) % radix_left).otherwise(acc["left"]).alias("left"),
            F.when(even, acc["right"]).otherwise((acc["right"] + keyed(key, tag, i, acc["left"])) % radix_right).alias("right"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def let(value: Column, body) -> Column:
    """Name an expression so that it is computed once: body gets the named column."""
    return F.element_at(F.transform(F.array(value), body), 1)


def permute_digits(value: Column, key: str, tag: str) -> Column:
    """Permute the digit strings of each length up to 30 among themselves."""
    size = F.length(value)
    a = F.floor(size / 2).cast("int")
    power = lambda n: F.pow(F.lit(10.0), n).cast("long")
    left = number(F.substring(value, F.lit(1), a))
    right = number(F.substring(value, a + 1, size - a))
    made = feistel(left, right, power(a), power(size - a), key, tag + "/")
    return let(made, lambda m: F.concat(F.when(a > 0, F.lpad(m["left"].cast("string"), a, "0")).otherwise(F.lit("")), F.lpad(m["right"].cast("string"), size - a, "0")))


def luhn_sum(value: Column) -> Column:
    """Luhn sum of a digit string whose last digit counts once."""
    def weigh(c: Column, i: Column) -> Column:
        v = c.cast("int")
        return F.when(i % 2 == 0, v).otherwise(v * 2 - F.when(v > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.split(F.reverse(value), ""), weigh), F.lit(0), lambda acc, v: acc + v)


def refill(shape: Column, value: Column) -> Column:
    """Put the digits of value, in order, where shape has digits."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def turn(acc: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.struct(F.concat(acc["out"], F.when(digit, F.substring(value, acc["at"], F.lit(1))).otherwise(c)).alias("out"), (acc["at"] + digit.cast("int")).alias("at"))

    return F.aggregate(F.split(shape, ""), start, turn)["out"]


def mod97(value: Column) -> Column:
    """An account number, rearranged, with letters as two digits, modulo 97."""
    moved = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))


def as_card(m: Column, key: str) -> Column:
    d = digits(m)
    size = F.length(d)
    # The first digit, which names the brand, stays; the last is the check digit.
    body = let(d, lambda v: F.concat(F.substring(v, 1, 1), permute_digits(F.substring(v, F.lit(2), size - 2), key, "card")))
    full = let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    return F.when(luhn_sum(d) % 10 == 0, refill(m, full))


def as_ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, *at).cast("long") for at in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    made = feistel(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")
    return F.when(valid, let(made, lambda p: F.format_string(
        "%03d-%02d-%04d", p["left"] + F.when(p["left"] >= 665, 2).otherwise(1), F.floor(p["right"] / 9999) + 1, p["right"] % 9999 + 1)))


def as_ip(m: Column, key: str) -> Column:
    octets = F.split(m, r"\.")
    o = [F.element_at(octets, i).cast("long") for i in (1, 2, 3, 4)]
    valid = F.forall(octets, lambda x: (x.cast("int") < 256) & ((x == "0") | ~x.startswith("0")))
    made = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip")
    return F.when(valid, let(made, lambda p: F.concat_ws(".", *[x.cast("string") for x in (F.floor(p["left"] / 256), p["left"] % 256, F.floor(p["right"] / 256), p["right"] % 256)])))


def as_phone(m: Column, key: str) -> Column:
    """North American numbers: area and exchange stay within 200 to 999."""
    d = digits(m)
    ten = F.substring(d, F.length(d) - 9, F.lit(10))
    area, exchange, line = (F.substring(ten, *at).cast("long") for at in ((1, 3), (4, 3), (7, 4)))
    made = feistel((area - 200) * 100 + F.floor(line / 100), (exchange - 200) * 100 + line % 100, F.lit(80_000), F.lit(80_000), key, "phone")
    full = let(made, lambda p: F.concat(
        F.substring(d, F.lit(1), F.length(d) - 10),
        F.format_string("%03d%03d%02d%02d", F.floor(p["left"] / 100) + 200, F.floor(p["right"] / 100) + 200, p["left"] % 100, p["right"] % 100)))
    return refill(m, full)


def as_intl(m: Column, key: str) -> Column:
    """Numbers with a country code: its first digit stays, which keeps the zone; 8 to 15 digits in all."""
    d = digits(m)
    size = F.length(d)
    full = F.concat(F.substring(d, 1, 1), permute_digits(F.substring(d, F.lit(2), size - 1), key, "intl"))
    return F.when(size.between(8, 15), refill(m, full))


def as_iban(m: Column, key: str) -> Column:
    plain = F.regexp_replace(m, " ", "")
    body = F.substring(plain, F.lit(5), F.length(plain))
    numbers = digits(body)
    # Up to 30 digits; letters of the account stay, and the two check digits are worked out again.
    made = let(F.concat(F.substring(plain, 1, 2), F.lit("00"), refill(body, permute_digits(numbers, key, "iban"))), lambda v: F.concat(
        F.substring(v, 1, 2), F.lpad((98 - mod97(v)).cast("string"), 2, "0"), F.substring(v, F.lit(5), F.length(v))))
    return F.when((mod97(plain) == 1) & (F.length(numbers) > 0), refill(m, digits(made)))


def as_date(m: Column, key: str) -> Column:
    iso, day_first = m.rlike("^[0-9]{4}"), m.contains(".")
    sep = F.when(iso, F.substring(m, 5, 1)).otherwise(F.substring(m, 3, 1))
    y = F.when(iso, F.substring(m, 1, 4)).otherwise(F.substring(m, 7, 4))
    first, second = F.when(iso, F.substring(m, 6, 2)).otherwise(F.substring(m, 1, 2)), F.when(iso, F.substring(m, 9, 2)).otherwise(F.substring(m, 4, 2))
    # Slashes: month first where that is a date, else day first.
    us = F.try_to_timestamp(F.concat_ws("-", y, first, second), F.lit("yyyy-MM-dd")).cast("date")
    eu = F.try_to_timestamp(F.concat_ws("-", y, second, first), F.lit("yyyy-MM-dd")).cast("date")
    month_first = iso | (~day_first & us.isNotNull())
    since = F.datediff(F.when(month_first, us).otherwise(eu), F.lit(FIRST_DAY).cast("date"))
    before, after = since < 0, since >= SPANS * SPAN
    of_span = lambda k: F.when(before, DAYS_BEFORE[k]).when(after, DAYS_AFTER[k]).otherwise(DAYS[k])
    base = F.when(before, -DAYS_BEFORE[0] * DAYS_BEFORE[1]).when(after, SPANS * SPAN).otherwise(F.floor(since / SPAN) * SPAN)
    n = since - base
    made = feistel(F.floor(n / of_span(1)), n % of_span(1), of_span(0), of_span(1), key, "date")
    day = lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (base + p["left"] * of_span(1) + p["right"]).cast("int"))

    def written(p: Column) -> Column:
        parts = F.date_format(day(p), "yyyy"), F.date_format(day(p), "MM"), F.date_format(day(p), "dd")
        return F.when(iso, F.concat_ws("\x00", *parts)).when(month_first, F.concat_ws("\x00", parts[1], parts[2], parts[0])).otherwise(F.concat_ws("\x00", parts[2], parts[1], parts[0]))

    return F.when(since.isNotNull(), F.replace(let(made, written), F.lit("\x00"), sep))


def shift_letters(half: Column, other: Column, key: str, i: Column, sign: int = 1) -> Column:
    """Move each letter and digit of one half within its class, by keyed amounts that depend on the other half."""
    stream = F.sha2(F.concat_ws("|", F.lit(derived(key, "email")), i.cast("string"), other), 256)

    def move(c: Column, at: Column) -> Column:
        by = F.conv(F.substring(stream, (at % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        turn = lambda low, n: F.char((code - low + by) % n + low)
        return F.when(c.between("a", "z"), turn(97, 26)).when(c.between("A", "Z"), turn(65, 26)).when(c.between("0", "9"), turn(48, 10)).otherwise(c)

    return F.array_join(F.transform(F.split(half, ""), move), "")


def as_email(m: Column, key: str) -> Column:
    """The local part is permuted among those of its shape; the domain stays."""
    local = F.substring_index(m, "@", 1)
    a = F.ceil(F.length(local) / 2).cast("int")
    start = F.struct(F.substring(local, F.lit(1), a).alias("left"), F.substring(local, a + 1, F.length(local)).alias("right"))

    def turn(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, shift_letters(acc["left"], acc["right"], key, i)).otherwise(acc["left"]).alias("left"),
            F.when(even, acc["right"]).otherwise(shift_letters(acc["right"], acc["left"], key, i)).alias("right"),
        )

    made = F.aggregate(F.sequence(F.lit(0), F.lit(3)), start, turn)
    return let(made, lambda p: F.concat(p["left"], p["right"], F.substring(m, F.length(local) + 1, F.length(m))))


MAKERS = {"email": as_email, "iban": as_iban, "date": as_date, "ip": as_ip, "ssn": as_ssn, "card": as_card, "phone": as_phone, "intl": as_intl}


def kind_of(m: Column) -> Column:
    """Which alternative a match is, by shape."""
    found = F.lit(None).cast("string")
    shapes = {
        "email": m.contains("@"),
        "iban": m.rlike("^[A-Z]{2}"),
        "date": m.rlike(r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})$"),
        "ip": m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"),
        "ssn": m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        "phone": m.rlike(r"^(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}$"),
        "intl": m.startswith("+"),
    }
    for kind, test in reversed(shapes.items()):
        found = F.when(test, kind).otherwise(F.lit("card") if kind == "intl" else found)
    return found


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a match, or null where it is not valid."""
    out = None
    for name, maker in MAKERS.items():
        out = F.when(kind == name, maker(m, key)) if out is None else out.when(kind == name, maker(m, key))
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """All columns of docs with the text pseudonymised, and pii_values (their number) and pii_kinds (sorted, distinct)."""
    text = F.col(text_col)
    # Looking for "@" or a digit is cheap; most texts have neither.
    mail, none = F.contains(text, F.lit("@")), F.array().cast("array<string>")
    found = (
        F.when(mail, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
        .when(text.rlike("[0-9]"), F.regexp_extract_all(text, F.lit(NUMBERS), F.lit(0))).otherwise(none)
    )
    held = docs.drop("pii_values", "pii_kinds")
    found_, made_ = unused(held, "pii_found"), unused(held, "pii_made")
    held = held.withColumn(found_, found)
    made = F.transform(found_, lambda m: let(kind_of(m), lambda k: F.struct(m.alias("old"), k.alias("kind"), pseudonym(m, k, key).alias("new"))))
    held = held.withColumn(made_, F.when(F.size(found_) > 0, made))
    between = F.when(mail, F.split(text, PATTERN, -1)).otherwise(F.split(text, NUMBERS, -1))
    joined = F.array_join(F.zip_with(between, F.transform(made_, lambda x: F.coalesce(x["new"], x["old"])), lambda s, r: F.concat(s, F.coalesce(r, F.lit("")))), "")
    valid = F.filter(made_, lambda x: x["new"].isNotNull())
    return (
        held.withColumn("pii_values", F.coalesce(F.size(valid), F.lit(0)))
        .withColumn("pii_kinds", F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(valid, lambda x: x["kind"]))), ","), F.lit("")))
        .withColumn(text_col, F.when(F.size(made_) > 0, joined).otherwise(text))
        .drop(found_, made_)
    )
