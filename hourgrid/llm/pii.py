"""Format-preserving Feistel pseudonyms of personal data, in DataFrame functions only.

Numbers and dates that validate are permuted with a key within their own format, so the
result looks and validates alike, and equal values get equal pseudonyms in all
documents: they stay linked. A value is split into two numbers (a, b) of ranges A and B;
in every round each is moved by a keyed hash of the other, modulo its range, which is a
permutation of A x B whatever the ranges are, and is undone by going backwards.

========  ==================================  ===========================================
kind      validated by                        kept; permuted
========  ==================================  ===========================================
card      13 to 19 digits, Luhn's check       first digit, separators; others (check digit anew)
phone     ten digits, exchange 200 to 999     separators; area code, exchange, line number
ip        four numbers up to 255              the form; both halves
date      calendar days 1700 to 2099          separators, order; the day's number
email     local part and a dotted domain      domain, separators; letters and digits of the local part
========  ==================================  ===========================================

Zero-padding of dates is written in full. Values of an exchange 555 keep it, as it marks
numbers that belong to nobody.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("card", "phone", "ip", "date", "email")
#: Days of 400 years, the period of the calendar: 146097 = 189 * 773.
DAYS = (189, 773)
FIRST_DAY = "DATE'1700-01-01'"

CARD = r"(?<![0-9A-Za-z])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{13,19})(?![0-9A-Za-z])"
PHONE = r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9A-Za-z])"
IP = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
DATE = r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9A-Za-z/-]|\.[0-9])"
EMAIL = r"(?<![0-9A-Za-z._%+-])[0-9A-Za-z][0-9A-Za-z._%+-]{0,63}+@(?:[0-9A-Za-z-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![0-9A-Za-z-])"
ANY = f"(?:{EMAIL})|(?:{CARD})|(?:{PHONE})|(?:{IP})|(?:{DATE})"


def number(digits: Column) -> Column:
    return digits.cast("bigint")


def feistel(pair: Column, size_a: Column, size_b: Column, key: str, kind: str, back: bool = False) -> Column:
    """Permute struct (a, b) within its ranges; ``back`` undoes it.

    The rounds are a fold over their numbers, so the expression stays small.
    """
    rounds = F.lit(list(range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)))
    sign = -1 if back else 1

    def step(x: Column, n: Column) -> Column:
        a, b = x["a"], x["b"]
        salt = F.concat_ws("|", F.lit(f"{key}|{kind}"), n.cast("string"))

        def hashed(by: Column, size: Column) -> Column:
            word = F.concat_ws("|", salt, size.cast("string"), by.cast("string"))
            return F.pmod(F.conv(F.substring(F.sha2(word, 256), 1, 15), 16, 10).cast("bigint"), size)

        on_a = F.struct(F.pmod(a + sign * hashed(b, size_a), size_a).alias("a"), b.alias("b"))
        on_b = F.struct(a.alias("a"), F.pmod(b + sign * hashed(a, size_b), size_b).alias("b"))
        return F.when(n % 2 == 0, on_a).otherwise(on_b)

    return F.aggregate(rounds, pair, step)


def pair(a: Column, b: Column) -> Column:
    return F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))


def power(base: int, n: Column) -> Column:
    return F.element_at(F.lit([base ** i for i in range(10)]).cast("array<bigint>"), (n + 1).cast("int"))


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum, with the last digit as the check digit."""
    backwards = F.split(F.reverse(digits), "")
    doubled = F.transform(backwards, lambda d, i: F.when(i % 2 == 1, F.element_at(
        F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9]), d.cast("int") + 1)).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def refill(form: Column, digits: Column) -> Column:
    """The digits of ``form`` replaced in order by others; all else stays."""
    chars = F.split(form, "")
    seen = F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), lambda acc, c: F.when(
        c.rlike("^[0-9]$"), F.struct(F.concat(acc["out"], F.substr(digits, acc["at"], F.lit(1))).alias("out"),
                                     (acc["at"] + 1).alias("at"))
    ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))))
    return seen["out"]


def card(value: Column, key: str, back: bool) -> Column:
    """First digit kept, the digits between permuted in two halves, the check digit worked out anew."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    body = F.substr(digits, F.lit(2), F.length(digits) - 2)
    n_a = F.floor(F.length(body) / 2).cast("int")
    n_b = F.length(body) - n_a
    new = feistel(pair(number(F.substr(body, F.lit(1), n_a)), number(F.substr(body, n_a + 1, n_b))),
                  power(10, n_a), power(10, n_b), key, "card", back)
    head = F.concat(F.substring(digits, 1, 1), _padded(new["a"], n_a), _padded(new["b"], n_b))
    check = F.pmod(10 - luhn_sum(F.concat(head, F.lit("0"))) % 10, F.lit(10)).cast("string")
    return refill(value, F.concat(head, check))


def is_card(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0)


def _padded(n: Column, width: Column) -> Column:
    return F.lpad(n.cast("string"), width, F.lit("0"))


def phone(value: Column, key: str, back: bool) -> Column:
    """Area code and exchange (200 to 999, or 555 kept) against the line number."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    long = F.length(digits) == 11
    ten = F.right(digits, F.lit(10))
    area, exchange, line = (F.substring(ten, s, n) for s, n in ((1, 3), (4, 3), (7, 4)))
    free = exchange != "555"
    # exchanges other than 555, numbered without a gap
    code = number(exchange) - 200 - (number(exchange) > 555).cast("int")
    a = F.when(free, number(area) * 799 + code).otherwise(number(area))
    new = feistel(pair(a, number(line)), F.when(free, F.lit(1000 * 799)).otherwise(F.lit(1000)).cast("bigint"),
                  F.lit(10_000).cast("bigint"), key, "phone", back)
    number_of = F.when(free, F.floor(new["a"] / 799)).otherwise(new["a"])
    code_of = new["a"] % 799 + 200
    exchange_of = F.when(free, code_of + (code_of >= 555).cast("int")).otherwise(F.lit(555))
    out = F.concat(_padded(number_of, F.lit(3)), exchange_of.cast("string"), _padded(new["b"], F.lit(4)))
    return refill(value, F.concat(F.when(long, F.substring(digits, 1, 1)).otherwise(F.lit("")), out))


def ip(value: Column, key: str, back: bool) -> Column:
    part = [F.split_part(value, F.lit("."), F.lit(i)).cast("bigint") for i in (1, 2, 3, 4)]
    new = feistel(pair(part[0] * 256 + part[1], part[2] * 256 + part[3]), F.lit(65536).cast("bigint"),
                  F.lit(65536).cast("bigint"), key, "ip", back)
    return F.concat_ws(".", *(x.cast("bigint").cast("string") for h in ("a", "b")
                              for x in (F.floor(new[h] / 256), new[h] % 256)))


def is_ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda x: (x.cast("int") <= 255) & x.rlike("^(0|[1-9][0-9]*)$"))


def day(value: Column) -> Column:
    """The calendar day of 2024-01-31, 1/31/2024 (month first) or 31.1.2024; null if there is none."""
    iso, slashed = value.contains("-"), value.contains("/")
    one, two, three = (F.regexp_extract(value, "^([0-9]+)[-/.]([0-9]+)[-/.]([0-9]+)$", i) for i in (1, 2, 3))
    y = F.when(iso, one).otherwise(three)
    m = F.when(slashed, one).otherwise(two)
    d = F.when(iso, three).when(slashed, two).otherwise(one)
    return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")


def date(value: Column, key: str, back: bool) -> Column:
    at = F.datediff(day(value), F.expr(FIRST_DAY)).cast("bigint")
    a, b = (F.lit(n).cast("bigint") for n in DAYS)
    new = feistel(pair(F.floor(at / DAYS[1]), at % DAYS[1]), a, b, key, "date", back)
    out = F.date_add(F.expr(FIRST_DAY), (new["a"] * DAYS[1] + new["b"]).cast("int"))
    return F.when(value.contains("-"), F.date_format(out, "yyyy-MM-dd")).when(
        value.contains("/"), F.date_format(out, "MM/dd/yyyy")).otherwise(F.date_format(out, "dd.MM.yyyy"))


def is_date(value: Column) -> Column:
    return F.coalesce(F.year(day(value)).between(1700, 2099), F.lit(False))


def email(value: Column, key: str, back: bool) -> Column:
    """Letters and digits of the local part, in runs of up to eight of a kind, each in two halves.

    A run's key holds its length, kind and place, so equal local parts stay equal; the
    domain takes no part, so a person is linked over domains as well.
    """
    local = F.lower(F.split_part(value, F.lit("@"), F.lit(1)))
    runs = F.regexp_extract_all(local, F.lit("[a-z]{1,8}|[0-9]{1,8}|[^a-z0-9]+"), F.lit(0))

    def other(run: Column, i: Column) -> Column:
        letters = run.rlike("^[a-z]")
        base = F.when(letters, F.lit(26)).otherwise(F.lit(10)).cast("bigint")
        chars = F.filter(F.split(run, ""), lambda c: c != "")
        values = F.transform(chars, lambda c: F.when(letters, F.ascii(c) - 97).otherwise(F.ascii(c) - 48).cast("bigint"))
        n = F.size(values)
        half = F.ceil(n / 2).cast("int")

        def joined(part: Column) -> Column:
            return F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, v: acc * base + v)

        def size(width: Column) -> Column:
            return F.aggregate(F.array_repeat(base, width), F.lit(1).cast("bigint"), lambda acc, v: acc * v)

        def spelt(x: Column, width: Column) -> Column:
            return F.aggregate(F.array_repeat(base, width), F.struct(F.lit("").alias("out"), x.alias("left")),
                               lambda acc, v: F.struct(
                                   F.concat(F.chr((acc["left"] % v) + F.when(letters, F.lit(97)).otherwise(F.lit(48))),
                                            acc["out"]).alias("out"),
                                   F.floor(acc["left"] / v).cast("bigint").alias("left")))["out"]

        new = feistel(pair(joined(F.slice(values, F.lit(1), half)), joined(F.slice(values, half + 1, n - half))),
                      size(half), size(n - half), key, "email", back)
        return F.when(run.rlike("^[a-z0-9]"), F.concat(spelt(new["a"], half), spelt(new["b"], n - half))).otherwise(run)

    return F.concat(F.array_join(F.transform(runs, other), ""), F.lit("@"), F.split_part(value, F.lit("@"), F.lit(2)))


def kind_of(value: Column) -> Column:
    """The kind of a found value, or null if it does not validate."""
    return F.when(value.contains("@"), "email").when(
        value.rlike(f"^(?:{CARD})$") & is_card(value), "card").when(value.rlike(f"^(?:{PHONE})$"), "phone").when(
        value.rlike(f"^(?:{IP})$") & is_ip(value), "ip").when(value.rlike(f"^(?:{DATE})$") & is_date(value), "date")


def pseudonym(value: Column, kind: Column, key: str, back: bool = False) -> Column:
    """The value's pseudonym within its kind; the value itself if the kind is null."""
    return F.when(kind == "email", email(value, key, back)).when(kind == "card", card(value, key, back)).when(
        kind == "phone", phone(value, key, back)).when(kind == "ip", ip(value, key, back)).when(
        kind == "date", date(value, key, back)).otherwise(value)


def _is(kind: str):
    return lambda v: v["kind"].eqNullSafe(F.lit(kind))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", back: bool = False) -> DataFrame:
    """All columns, with pseudonyms in the text and their number of each kind (``n_card``, ...).

    ``back`` turns pseudonyms into the values again, except for capitals in e-mail
    addresses and dates that were not padded with zeros.

    Null texts stay null with counts of 0; texts without values stay as they are, byte by
    byte, and so does all that stands between values. Found values that do not validate
    stay. Equal values, also within other documents or repeated rows, get equal
    pseudonyms under a key. No rows give no rows. Columns of the input with the name of a
    count are replaced.
    """
    counts = [f"n_{k}" for k in KINDS]
    text = F.col(f"`{text_col}`")
    spot = "\x01found"
    # values first, once a row; each with its kind
    found = F.when(text.rlike(ANY), F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda v: F.struct(
        v.alias("value"), kind_of(v).alias("kind"))))
    rows = docs.select(*(f"`{c}`" for c in docs.columns if c not in counts), found.alias(spot))
    hit = F.col(f"`{spot}`")
    new = F.transform(hit, lambda v: pseudonym(v["value"], v["kind"], key, back))
    pieces = F.split(text, ANY, -1)
    joined = F.array_join(F.zip_with(pieces, F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    others = [F.when(hit.isNotNull(), joined).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`")
              for c in rows.columns if c != spot]
    return rows.select(*others, *(F.coalesce(F.size(F.filter(hit, _is(k))), F.lit(0))
                                  .cast("long").alias(f"n_{k}") for k in KINDS))
