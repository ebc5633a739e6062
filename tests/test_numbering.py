"""Numbers of ten countries, trunk digits, lengths, national numbers, placeholders."""

import pytest

from siftlane.functions import numbering as N

CASES = [
    ("Tel: +90 (0212) 555 44 33", None, [("+902125554433", True)]),
    ("0090 532 111 22 33", None, [("+905321112233", True)]),
    ("+44 (0)20 7946 0958 / +44 20 7946 0958", None, [("+442079460958", True)]),
    ("+1 (415) 555-2671", None, [("+14155552671", True)]),
    ("+1 415 555 267", None, [("+1 415 555 267", False)]),
    ("+55 11 91234-5678", "Brazil", [("+5511912345678", True)]),
    ("+49 711 123456", None, [("+49711123456", True)]),
    ("+39 06 1234 5678", None, [("+390612345678", True)]),
    ("+880 1711-123456", None, [("+8801711123456", True)]),
    ("+998 71 1234567 and +7 495 123 45 67", None, [("+998711234567", True), ("+74951234567", True)]),
    ("+34 91 123 45 67", None, [("+34911234567", True)]),
    ("0212 555 44 33", "Turkey", [("+902125554433", True)]),
    ("0212 555 44 33", None, [("0212 555 44 33", False)]),
    ("0212 555 44 33", "Atlantis", [("0212 555 44 33", False)]),
    ("12345678, 1234567890; 0000-1111-2222 viewBox 0 0 100 100", None, []),
    ("+999 123 45678901", None, [("+999 123 45678901", False)]),
    ("call 12", "Turkey", []),
    (None, None, []),
]


@pytest.mark.parametrize("text,country,want", CASES)
def test_numbers(spark, text, country, want):
    df = spark.createDataFrame([(text, country)], "t string, c string")
    assert [tuple(x) for x in df.select(N.phone_numbers("t", "c").alias("p")).first().p] == want


def test_longest_code_wins(spark):
    codes = [c for c, *_ in N.PLAN]
    assert len(codes) == len(set(codes))
    for short in codes:
        for long in codes:
            if long != short and long.startswith(short):
                raise AssertionError((short, long))
    rows = spark.createDataFrame([("2125554433",), ("201234567890",), ("7495",), ("",)], "d string").select(N.rule_of(N.F.col("d")).alias("r")).collect()
    assert [r.r and r.r.code for r in rows] == ["212", "20", "7", None]
