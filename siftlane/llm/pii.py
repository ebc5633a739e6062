"""Format-preserving pseudonyms for personal numbers, dates, addresses and e-mail names.

Values are found by one pattern over the whole text, checked, and replaced by a keyed
permutation of their own format, so equal values have equal pseudonyms in every document and a
pseudonym passes the same checks as the value (of ssn and phone the format is all that is checked):

* ``card``: 13 to 19 digits with a right Luhn digit; all digits but the last are permuted, the
  last is computed again. Of a run of digits that has none, its first part between separators
  that is such a number, the longest of those that begin together.
* ``iban``: right remainder modulo 97; country kept, account characters permuted within their
  class, check digits computed again.
* ``ssn``: three, two and four digits; ``phone``: ten digits with an optional country code, which
  is kept. The digits are permuted, the marks between them stay.
* ``date``: days from 1900-01-01 on that exist, as y-m-d, m/d/y or d.m.y; the day's number is
  permuted among DATE_A times DATE_B days. With slashes the month is first where that is a date; what can
  only be d/m/y is permuted among such dates.
* ``ip``: four numbers up to 255, permuted among all 32-bit addresses.
* ``email``: letters and digits of the local part, each within its class; the domain stays.

The permutation is an alternating Feistel network of ten rounds: of two halves one at a time is
shifted, each symbol modulo the size of its class, by what SHA-256 of key, kind, round and the
other half gives. A round can be undone whatever that function is, so the whole is one to one.
What fails its check isn't changed. All of it is built-in functions.

Nulls: a null text stays null, with no values found. An empty text stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds, and their patterns in the order in which they are tried at a place.
KINDS = ("email", "date", "ssn", "ip", "iban", "phone", "card")
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    "date": r"(?<![\w.])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)",
    "phone": r"(?<![\w)])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)",
    "card": r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)",
}
ANY = "|".join(PATTERNS[k] for k in KINDS)
DATE_FIRST, DATE_A, DATE_B = "1900-01-01", 270, 270
#: A date with slashes whose first number can't be a month; steps in which such a date meets another (all but surely in a few).
DAY_FIRST, WALK = r"^(1[3-9]|2\d|3[01])/", 96
ROUNDS = 10


def chars(s: Column) -> Column:
    """The characters of a string."""
    return F.filter(F.split(s, ""), lambda c: c != "")


def digest_number(key: str, kind: str, step: Column, other: Column, at: Column, width: int = 12) -> Column:
    """The round function: a number below 16 to the width, for symbol ``at`` of the half that is shifted."""
    block = (at / 5).cast("int")
    h = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), block.cast("string"), other), 256)
    return F.conv(F.substring(h, F.lit(1) + F.lit(width) * (at % 5), F.lit(width)), 16, 10).cast("long")


def shifted(c: Column, by: Column) -> Column:
    """A character moved on within its class; others stay."""
    code = F.ascii(c)

    def moved(first: str, size: int) -> Column:
        return F.char((F.lit(ord(first)) + F.pmod(code - ord(first) + by, F.lit(size))).cast("int"))

    return F.when(c.between("0", "9"), moved("0", 10)).when(c.between("a", "z"), moved("a", 26)).when(c.between("A", "Z"), moved("A", 26)).otherwise(c)


def permuted_symbols(value: Column, key: str, kind: str) -> Column:
    """A string's letters and digits, permuted within their classes and places."""

    def mix(half: Column, other: Column, step: Column) -> Column:
        return F.transform(half, lambda c, i: shifted(c, digest_number(key, kind, step, F.array_join(other, ""), i)))

    def turn(acc: Column, step: Column) -> Column:
        even = step % 2 == 0
        left = F.when(even, mix(acc["l"], acc["r"], step)).otherwise(acc["l"])
        right = F.when(even, acc["r"]).otherwise(mix(acc["r"], acc["l"], step))
        return F.struct(left.alias("l"), right.alias("r"))

    own = chars(value)
    half = F.greatest(F.lit(1), (F.size(own) / 2).cast("int"))
    start = F.struct(F.slice(own, F.lit(1), half).alias("l"), F.slice(own, half + 1, F.size(own)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda acc: F.array_join(F.concat(acc["l"], acc["r"]), ""))


def permuted_number(n: Column, a: int, b: int, key: str, kind: str) -> Column:
    """A number below a times b, permuted among those."""

    def turn(acc: Column, step: Column) -> Column:
        even = step % 2 == 0
        left = F.pmod(acc["l"] + digest_number(key, kind, step, acc["r"].cast("string"), F.lit(0)), F.lit(a))
        right = F.pmod(acc["r"] + digest_number(key, kind, step, acc["l"].cast("string"), F.lit(0)), F.lit(b))
        return F.struct(F.when(even, left).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise(right).alias("r"))

    n = n.cast("long")
    start = F.struct(F.floor(n / b).cast("long").alias("l"), F.pmod(n, F.lit(b)).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda acc: acc["l"] * b + acc["r"])


def laid_in(form: Column, digits: Column) -> Column:
    """The digits of a form replaced by others, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(acc: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        new = F.when(digit, F.substring(digits, acc["at"], F.lit(1))).otherwise(c)
        return F.struct(F.concat(acc["out"], new).alias("out"), F.when(digit, acc["at"] + 1).otherwise(acc["at"]).alias("at"))

    return F.aggregate(chars(form), start, step, lambda acc: acc["out"])


def luhn_digit(digits: Column) -> Column:
    """The check digit that belongs behind these digits."""
    doubled = F.transform(F.reverse(chars(digits)), lambda c, i: F.when(i % 2 == 1, c.cast("int")).when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda acc, x: acc + x), F.lit(10)).cast("string")


def mod97(text: Column) -> Column:
    """The remainder modulo 97 of letters (A is 10) and digits."""
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(chars(text), F.lit(0), lambda acc, c: F.pmod(acc * F.when(value(c) > 9, 100).otherwise(10) + value(c), F.lit(97)))


def pseudonym(kind: str, m: Column, key: str) -> Column:
    """What stands for a match of a kind's pattern; null if it fails the kind's check."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "email":
        local = F.substring_index(m, "@", 1)
        return F.concat(permuted_symbols(local, key, kind), F.substring(m, F.length(local) + 1, F.length(m)))
    if kind == "card":
        body = F.substring(digits, F.lit(1), F.length(digits) - 1)
        new = permuted_symbols(body, key, kind)
        return F.when(F.right(digits, F.lit(1)) == luhn_digit(body), laid_in(m, F.concat(new, luhn_digit(new))))
    if kind == "iban":
        country, account = F.substring(m, 1, 2), F.substring(m, F.lit(5), F.length(m))
        new = permuted_symbols(account, key, kind)
        check = F.lpad((F.lit(98) - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return F.when(mod97(F.concat(account, country, F.substring(m, 3, 2))) == 1, F.concat(country, check, new))
    if kind == "ssn":
        return laid_in(m, permuted_symbols(digits, key, kind))
    if kind == "phone":
        code = F.substring(digits, F.lit(1), F.length(digits) - 10)
        return laid_in(m, F.concat(code, permuted_symbols(F.right(digits, F.lit(10)), key, kind)))
    if kind == "ip":
        parts = F.transform(F.split(m, "[.]"), lambda p: p.cast("long"))
        number = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc * 256 + p)
        new = permuted_number(number, 1 << 16, 1 << 16, key, kind)
        out = F.concat_ws(".", *[F.pmod(F.shiftright(new, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])
        return F.when(F.forall(parts, lambda p: p < 256), out)
    out = F.lit(None).cast("string")
    date_of = lambda n: F.date_add(F.lit(DATE_FIRST).cast("date"), n.cast("int"))
    for like, form in ((DAY_FIRST, "dd/MM/yyyy"), (r"^\d{4}-", "yyyy-MM-dd"), (r"/", "MM/dd/yyyy"), (r"^\d{2}[.]", "dd.MM.yyyy")):
        day = F.datediff(F.try_to_timestamp(m, F.lit(form)).cast("date"), F.lit(DATE_FIRST).cast("date")).cast("long")
        one = permuted_number(day, DATE_A, DATE_B, key, kind)
        if like == DAY_FIRST:  # permuted again until the day can't be a month, which keeps it one to one among such dates
            start = F.struct(day.alias("n"), F.lit(False).alias("done"))

            def walk(acc: Column, _: Column) -> Column:
                new = permuted_number(acc["n"], DATE_A, DATE_B, key, "day_first")
                return F.when(acc["done"], acc).otherwise(F.struct(new.alias("n"), (F.dayofmonth(date_of(new)) > 12).alias("done")))

            one = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, walk, lambda acc: F.when(acc["done"], acc["n"]))
        new = F.when((day >= 0) & (day < DATE_A * DATE_B), F.date_format(date_of(one), form))
        out = F.coalesce(F.when(m.rlike(like), new), out)
    return out


def kind_of(m: Column) -> Column:
    """The kind of a match of ANY."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})$"), "date")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(m.rlike(r"^[A-Z]"), "iban")
        .when(m.rlike(r"^[+(]") | (F.length(digits) == 10), "phone")
        .otherwise("card")
    )


def card_span(m: Column) -> Column:
    """(at, n): where in a run of digits the card number lies; null if there is none."""
    mark = lambda i: F.substring(m, i, F.lit(1)).isin(" ", "-")
    places = F.sequence(F.lit(1), F.length(m))
    starts = F.filter(places, lambda i: (i == 1) | mark(i - 1))
    ends = F.reverse(F.filter(places, lambda i: (i == F.length(m)) | mark(i + 1)))
    spans = F.flatten(F.transform(starts, lambda i: F.transform(ends, lambda j: F.struct(i.alias("at"), (j - i + 1).alias("n")))))

    def valid(s: Column) -> Column:
        digits = F.regexp_replace(F.substring(m, s["at"], s["n"]), "[^0-9]", "")
        return F.when((s["n"] > 12) & F.length(digits).between(13, 19), F.right(digits, F.lit(1)) == luhn_digit(F.substring(digits, F.lit(1), F.length(digits) - 1))).otherwise(False)

    return F.get(F.filter(spans, valid), F.lit(0))


def replaced(kind: Column, m: Column, key: str) -> Column:
    """The pseudonym of a value; null if it fails its check."""
    out = F.lit(None).cast("string")
    for k in KINDS:
        out = F.when(kind == k, pseudonym(k, m, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text") -> DataFrame:
    """docs with pseudonyms in the text, and pii: array of (kind, value, pseudonym), checked values only, in order.

    A value that is its own pseudonym is listed too."""
    kept = [c for c in docs.columns if c != "pii"]
    text = F.col(text_col)
    none = F.from_json(F.lit("[]"), "array<struct<kind:string,value:string,pseudonym:string,before:string,after:string>>")
    hits = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: F.struct(kind_of(m).alias("kind"), m.alias("m"), F.when(kind_of(m) == "card", card_span(m)).alias("span")))
    part = lambda h, at, n: F.substring(h["m"], at, n)
    parts = F.transform(
        hits,
        lambda h: F.struct(
            h["kind"].alias("kind"),
            F.coalesce(part(h, h["span"]["at"], h["span"]["n"]), h["m"]).alias("value"),
            F.coalesce(part(h, F.lit(1), h["span"]["at"] - 1), F.lit("")).alias("before"),
            F.coalesce(part(h, h["span"]["at"] + h["span"]["n"], F.length(h["m"])), F.lit("")).alias("after"),
        ),
    )
    found = F.transform(parts, lambda p: F.struct(p["kind"].alias("kind"), p["value"].alias("value"), replaced(p["kind"], p["value"], key).alias("pseudonym"), p["before"].alias("before"), p["after"].alias("after")))
    has = F.coalesce(F.rlike(text, F.lit(ANY)), F.lit(False))
    work = docs.select(*kept, F.when(has, found).otherwise(none).alias("__m"))
    new_of = lambda m: F.coalesce(F.concat(m["before"], F.coalesce(m["pseudonym"], m["value"]), m["after"]), F.lit(""))
    laid = F.array_join(F.zip_with(F.split(text, ANY, -1), F.col("__m"), lambda g, m: F.concat(g, new_of(m))), "")
    new = F.when(F.size("__m") == 0, text).otherwise(laid)
    checked = F.transform(F.filter("__m", lambda m: m["pseudonym"].isNotNull()), lambda m: F.struct(m["kind"].alias("kind"), m["value"].alias("value"), m["pseudonym"].alias("pseudonym")))
    return work.select(*[new.alias(c) if c == text_col else F.col(c) for c in kept], checked.alias("pii"))
