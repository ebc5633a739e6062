"""Telephone numbers by the world's numbering plan: longest country code first, national lengths, trunk digits; E.164 or the plain fallback."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftlane.functions.text import let, text_of

#: Country code, least and most digits of a national number, the trunk digit that is dropped behind the code, names of the country.
PLAN = (
    ("1", 10, 10, "", ("united states", "usa", "canada")), ("7", 10, 10, "8", ("russia", "kazakhstan")), ("20", 8, 10, "0", ("egypt",)), ("27", 9, 9, "0", ("south africa",)),
    ("30", 10, 10, "", ("greece",)), ("31", 9, 9, "0", ("netherlands",)), ("32", 8, 9, "0", ("belgium",)), ("33", 9, 9, "0", ("france",)), ("34", 9, 9, "", ("spain",)),
    ("39", 6, 11, "", ("italy",)), ("40", 9, 9, "0", ("romania",)), ("41", 9, 9, "0", ("switzerland",)), ("43", 7, 13, "0", ("austria",)), ("44", 9, 10, "0", ("united kingdom", "uk")),
    ("45", 8, 8, "", ("denmark",)), ("46", 7, 9, "0", ("sweden",)), ("47", 8, 8, "", ("norway",)), ("48", 9, 9, "", ("poland",)), ("49", 7, 11, "0", ("germany",)),
    ("51", 8, 9, "0", ("peru",)), ("52", 10, 10, "", ("mexico",)), ("54", 10, 11, "0", ("argentina",)), ("55", 10, 11, "0", ("brazil",)), ("56", 9, 9, "", ("chile",)),
    ("57", 8, 10, "", ("colombia",)), ("58", 10, 10, "0", ("venezuela",)), ("60", 8, 10, "0", ("malaysia",)), ("61", 9, 9, "0", ("australia",)), ("62", 8, 12, "0", ("indonesia",)),
    ("63", 8, 10, "0", ("philippines",)), ("65", 8, 8, "", ("singapore",)), ("66", 8, 9, "0", ("thailand",)), ("81", 9, 10, "0", ("japan",)), ("82", 8, 10, "0", ("south korea",)),
    ("84", 9, 10, "0", ("vietnam",)), ("86", 9, 11, "0", ("china",)), ("90", 10, 10, "0", ("turkey", "turkiye", "türkiye")), ("91", 10, 10, "0", ("india",)), ("92", 9, 10, "0", ("pakistan",)),
    ("94", 9, 9, "0", ("sri lanka",)), ("98", 10, 10, "0", ("iran",)), ("212", 9, 9, "0", ("morocco",)), ("213", 8, 9, "0", ("algeria",)), ("216", 8, 8, "", ("tunisia",)),
    ("218", 8, 9, "0", ("libya",)), ("251", 9, 9, "0", ("ethiopia",)), ("254", 9, 9, "0", ("kenya",)), ("351", 9, 9, "", ("portugal",)), ("353", 7, 9, "0", ("ireland",)),
    ("359", 7, 9, "0", ("bulgaria",)), ("380", 9, 9, "0", ("ukraine",)), ("420", 9, 9, "", ("czechia", "czech republic")), ("502", 8, 8, "", ("guatemala",)), ("503", 8, 8, "", ("el salvador",)),
    ("504", 8, 8, "", ("honduras",)), ("505", 8, 8, "", ("nicaragua",)), ("506", 8, 8, "", ("costa rica",)), ("507", 7, 8, "", ("panama",)), ("591", 8, 8, "0", ("bolivia",)),
    ("593", 8, 9, "0", ("ecuador",)), ("595", 9, 9, "0", ("paraguay",)), ("598", 8, 8, "0", ("uruguay",)), ("852", 8, 8, "", ("hong kong",)), ("880", 8, 10, "0", ("bangladesh",)),
    ("886", 8, 9, "0", ("taiwan",)), ("962", 8, 9, "0", ("jordan",)), ("966", 8, 9, "0", ("saudi arabia",)), ("971", 8, 9, "0", ("united arab emirates", "uae")), ("972", 8, 9, "0", ("israel",)), ("998", 9, 9, "", ("uzbekistan",)),
)
#: What stands for a number in forms, and how many digits a number without a plan has.
PLACEHOLDERS = ("10000000", "12345678", "00000000", "1234567890")
PLAIN_DIGITS = (10, 15)
CANDIDATE = r"(?:\+|\(|[0-9])[0-9 ()./\-\x{00A0}]{5,24}[0-9]"


def rule_of(digits: Column) -> Column:
    """The plan's (code, least, most, trunk) for digits that begin with a country code, the longest code first; null if there is none."""
    table = F.create_map(*[x for code, lo, hi, trunk, _ in PLAN for x in (F.lit(code), F.struct(F.lit(code).alias("code"), F.lit(lo).alias("least"), F.lit(hi).alias("most"), F.lit(trunk).alias("trunk")))])
    return F.coalesce(*[F.try_element_at(table, F.substring(digits, 1, n)) for n in (3, 2, 1)])


def code_of(country: Column) -> Column:
    """The country code of a country by its name."""
    table = F.create_map(*[F.lit(x) for code, *_, names in PLAN for n in names for x in (n, code)])
    return F.try_element_at(table, F.lower(F.trim(country)))


def without_trunk(national: Column, rule: Column) -> Column:
    """A national number without the trunk digit, if it has one and would be long enough without it."""
    shorter = F.substring(national, F.lit(2), F.length(national))
    return F.when((rule["trunk"] != "") & F.startswith(national, rule["trunk"]) & (F.length(national) > rule["least"]), shorter).otherwise(national)


def numbered(digits: Column) -> Column:
    """Digits from the country code on as E.164, null where the plan has no such number."""

    def by(rule: Column) -> Column:
        national = without_trunk(F.substring(digits, F.length(rule["code"]) + 1, F.length(digits)), rule)
        return F.when(F.length(national).between(rule["least"], rule["most"]), F.concat(F.lit("+"), rule["code"], national))

    return let(rule_of(digits), by)


def phone_numbers(text: str | Column, country: str | Column | None = None) -> Column:
    """Numbers in a text, each once, in order: array of (number, valid). Valid ones are E.164: numbers with + or 00 by the longest country code that
    the plan knows, others as national numbers of ``country`` if it is given. Of the rest those of 10 to 15 digits stay as
    they are written, trimmed, but for placeholders and runs that begin in zeros."""
    t = text_of(text)
    found = F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0))
    home = None if country is None else code_of(text_of(country))

    def one(raw: Column) -> Column:
        def of(digits: Column) -> Column:
            whole = F.when(F.contains(raw, F.lit("+")), numbered(digits)).when(F.startswith(digits, F.lit("00")), numbered(F.substring(digits, F.lit(3), F.length(digits))))
            if home is not None:
                whole = whole.when(home.isNotNull(), numbered(F.concat(home, digits)))
            zeros = F.startswith(digits, F.lit("00")) & (F.size(F.array_distinct(F.split(F.substring(digits, 1, 4), ""))) <= 2)
            plain = F.length(digits).between(*PLAIN_DIGITS) & ~digits.isin(*PLACEHOLDERS) & ~zeros
            return F.when(whole.isNotNull(), F.struct(whole.alias("number"), F.lit(True).alias("valid"))).when(plain, F.struct(F.trim(raw).alias("number"), F.lit(False).alias("valid")))

        return let(F.regexp_replace(raw, "[^0-9]", ""), of)

    return F.array_distinct(F.filter(F.transform(found, one), lambda x: x.isNotNull()))
