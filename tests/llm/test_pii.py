"""Pseudonyms against a plain Feistel network, and their formats' own checks."""

import datetime as dt
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from siftlane.llm import pii, registry

KEY = "k"
ROWS = [
    (1, None),
    (2, ""),
    (3, "Card 4785380592391147, again 4785-3805-9239-1147; not 4785380592391142."),
    (4, "call +1 (155) 555-6503%%% or 155-555-6503, that.92@mail2.example.com### and A@b.co"),
    (4, "call +1 (155) 555-6503%%% or 155-555-6503, that.92@mail2.example.com### and A@b.co"),
    (5, "born 1987-02-28, 02/29/2000, 31.12.1999; not 1987-02-30 nor 13/40/2000, 2.3.4.5, 10.255.0.1 and 300.1.1.1 v1.2.3.4.5"),
    (6, "GB82WEST12345698765432 DE89370400440532013000 not GB83WEST12345698765432, 123-45-6789"),
    (None, "é🙂 x@y.z.org é" + " plain" * 30_000),
    (8, "a" * 30_000 + " " + "9" * 30_000 + " " + "a." * 10_000 + "@"),
]


def number(step, kind, other, at):
    h = hashlib.sha256(f"{KEY}|{kind}|{step}|{at // 5}|{other}".encode()).hexdigest()
    return int(h[12 * (at % 5) : 12 * (at % 5) + 12], 16)


def symbols(value, kind):
    half = max(1, len(value) // 2)
    sides = [list(value[:half]), list(value[half:])]
    for step in range(pii.ROUNDS):
        own, other = sides[step % 2], "".join(sides[1 - step % 2])
        for i, c in enumerate(own):
            for first, size in (("0", 10), ("a", 26), ("A", 26)):
                if first <= c < chr(ord(first) + size):
                    own[i] = chr(ord(first) + (ord(c) - ord(first) + number(step, kind, other, i)) % size)
                    break
    return "".join(sides[0] + sides[1])


def luhn(digits):
    return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))) % 10 == 0


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


@pytest.mark.parametrize("rows", [ROWS, []])
def test_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as pii", "2 as kind")
    got = pii.pseudonymise(docs, KEY)
    assert got.columns == ["doc_id", "text", "kind", "pii"]
    out = got.collect()
    assert [(r.doc_id, r.text is None) for r in out] == [(i, t is None) for i, t in rows]
    if not rows:
        return
    text = {r.doc_id: r.text for r in out}
    one, two, bad = re.findall(r"[\d-]{16,}", text[3])
    assert one == two.replace("-", "") and luhn(one) and one[:-1] == symbols("478538059239114", "card") and bad == "4785380592391142"
    phone = symbols("1555556503", "phone")
    assert text[4] == f"call +1 ({phone[:3]}) {phone[3:6]}-{phone[6:]}%%% or {phone[:3]}-{phone[3:6]}-{phone[6:]}, {symbols('that.92', 'email')}@mail2.example.com### and {symbols('A', 'email')}@b.co"
    a, b, c = (re.search(p, text[5])[0] for p in (r"\d{4}-\d\d-\d\d", r"\d\d/\d\d/\d{4}", r"\d\d\.\d\d\.\d{4}"))
    for s, f in ((a, "%Y-%m-%d"), (b, "%m/%d/%Y"), (c, "%d.%m.%Y")):
        assert dt.date(1900, 1, 1) <= dt.datetime.strptime(s, f).date() < dt.date(1900, 1, 1) + dt.timedelta(72900)
    assert "not 1987-02-30 nor 13/40/2000" in text[5] and "300.1.1.1 v1.2.3.4.5" in text[5]
    ibans = re.findall(r"[A-Z]{2}\d\d\w{11,}", text[6])
    assert [i[:2] for i in ibans] == ["GB", "DE", "GB"] and [mod97(i) for i in ibans[:2]] == [1, 1] and ibans[2] == "GB83WEST12345698765432"
    assert re.fullmatch("[A-Z]{4}", ibans[0][4:8]) and symbols("123456789", "ssn") in re.search(r"\d{3}-\d\d-\d{4}", text[6])[0].replace("-", "")
    assert text[8] == rows[-1][1]
    assert text[None] == rows[-2][1].replace("x@y", symbols("x", "email") + "@y")


def test_permutations_are_one_to_one(spark):
    days = spark.range(pii.DATE_A * pii.DATE_B).select(pii.permuted_number(F.col("id"), pii.DATE_A, pii.DATE_B, KEY, "date").alias("n"))
    assert tuple(days.agg(F.countDistinct("n"), F.min("n"), F.max("n")).first()) == (72900, 0, 72899)
    codes = spark.range(10000).select(pii.permuted_symbols(F.lpad(F.col("id").cast("string"), 4, "0"), KEY, "x").alias("s"))
    assert codes.distinct().count() == 10000


def test_query_hides_values_and_leaves_others(spark):
    sf = "/root/testdata/sf0.01"
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    after = {r.doc_id: r for r in registry.op6_pseudonyms(spark, sf).collect()}
    personal = [r"[a-z]+\.\d+@[a-z0-9.]+", r"\+\d \(\d{3}\) \d{3}-\d{4}", r"(?<!\w)\d{16}(?!\w)", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w)"]
    linked = {}
    for i, text in before.items():
        values = [m for p in personal for m in re.findall(p, text)]
        new = [m for p in personal for m in re.findall(p, after[i].text)]
        assert len(values) == len(new)
        pairs = [(v, n) for v, n in zip(values, new) if len(v) != 16 or not v.isdigit() or luhn(v)]
        assert {v for v, n in zip(values, new) if v == n} == set(values) - {v for v, _ in pairs}
        values = [v for v, _ in pairs]
        for v, n in pairs:
            assert linked.setdefault(v, n) == n
        if not values:
            assert after[i].text == text
    assert len(set(linked.values())) == len(linked) > 20


def test_cards_beside_other_numbers(spark):
    texts = ["pay 4111 1111 1111 1111 123 now", "pay 123 4111 1111 1111 1111 now", "4111-1111-1111-1111 12", "4111 1111 1111 1112 123"]
    rows = pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").orderBy("doc_id").collect()
    assert [[(p.kind, p.value) for p in r.pii] for r in rows] == [[("card", "4111 1111 1111 1111")], [("card", "4111 1111 1111 1111")], [("card", "4111-1111-1111-1111")], []]
    for t, r in zip(texts, rows):
        for p in r.pii:
            t = t.replace(p.value, p.pseudonym)
        assert r.text == t


def test_values_that_are_their_own_pseudonyms_are_listed(spark):
    """By this key one letter's shifts add up to nothing."""
    row = pii.pseudonymise(spark.createDataFrame([(0, "a@x.com")], "doc_id long, text string"), "k11").first()
    assert row.text == "a@x.com" and [tuple(p) for p in row.pii] == [("email", "a@x.com", "a@x.com")]


def test_day_first_dates(spark):
    """d/m/y that can't be m/d/y: one to one among such dates, as strings, and m/d/y stays apart from them."""
    days = [dt.date(1900, 1, 1) + dt.timedelta(days=i) for i in range(0, 3000)]
    values = [f"{d:%d/%m/%Y}" for d in days if d.day > 12] + ["25/12/2024", "31/12/2079", "30/02/2024", "32/01/2024", "25/13/2024"]
    got = [[(x.kind, x.value, x.pseudonym) for x in r.pii] for r in pii.pseudonymise(spark.createDataFrame([(v,) for v in values], "text string"), KEY).collect()]
    assert got[-3:] == [[], [], []]
    new = [x[0][2] for x in got[:-3]]
    assert len(set(new)) == len(new) and all(dt.datetime.strptime(x, "%d/%m/%Y").day > 12 for x in new)
    assert sum(a == b for a, b in zip(values, new)) <= 3
