"""Workbooks by rows: what is written is read, odd sheets, filters, and memory that doesn't grow with the rows."""

import io
import tracemalloc
import zipfile

import pytest

from siftlane.sources import workbooks


def book(sheet, strings=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/worksheets/sheet10.xml", f'<worksheet xmlns="{workbooks.MAIN[1:-1]}"><sheetData/></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{workbooks.MAIN[1:-1]}"><cols/><sheetData>{sheet}</sheetData><extra/></worksheet>')
        if strings:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{workbooks.MAIN[1:-1]}">{strings}</sst>')
    out.seek(0)
    return out


def test_cells():
    strings = "<si><t>é</t></si><si/><si><r><t>two </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></si>"
    sheet = '<row r="1"><c r="B1" t="s"><v>0</v></c><c r="AA1" t="s"><v>2</v></c></row><row/><row><c><v>4.5</v></c><c t="inlineStr"><is><t>a</t><t>b</t></is></c><c t="s"><v>1</v></c></row>'
    rows = list(workbooks.sheet_rows(book(sheet, strings)))
    assert rows[0][1] == "é" and rows[0][26] == "two runs" and len(rows[0]) == 27 and rows[1:] == [[], ["4.5", "ab", ""]]
    assert list(workbooks.sheet_rows(book(""))) == []


def test_members_and_filters(spark, tmp_path):
    rows = [("a.xlsx", 0, ["Members of 2024", None]), ("a.xlsx", 1, ["Category", "Country", "Member name", "Joined"]), ("a.xlsx", 2, ["Mill", "Peru", "Alfa & <Co>", "2001"]), ("a.xlsx", 3, ["Mill", "Peru", " Beta ", None]), ("a.xlsx", 4, ["Shop", "Peru", "Gamma", ""]), ("a.xlsx", 5, ["Mill", "Egypt", "Delta"]), ("a.xlsx", 6, ["Mill", "Egypt", ""]), ("a.xlsx", 7, ["Mill", "Egypt", "nan"]), ("b.xlsx", 0, ["no", "header"])]
    path = str(tmp_path / "books")
    written = workbooks.write_workbooks(spark.createDataFrame(rows, "file string, row long, cells array<string>"), path).collect()
    assert sorted(r.rows for r in written) == [1, 8]
    got = lambda **f: sorted(tuple(r)[1:] for r in workbooks.member_list(spark, f"{path}/*.xlsx", **f).collect())
    assert got() == [("Alfa & <Co>", "Peru", "Mill", "2001", ""), ("Beta", "Peru", "Mill", "", ""), ("Delta", "Egypt", "Mill", "", ""), ("Gamma", "Peru", "Shop", "", "")]
    assert [r[0] for r in got(countries=["PERU "], categories=["mill"])] == ["Alfa & <Co>", "Beta"]
    (tmp_path / "c.csv").write_text("﻿Company,Land\nCompany,Country\n\"Eta, Ltd\",Peru\n\n", encoding="utf-8")
    held = spark.read.format("binaryFile").load(str(tmp_path / "c.csv")).select("path", "content")
    assert [(r.company, r.country) for r in workbooks.members_of(held).collect()] == [("Eta, Ltd", "Peru")]
    nothing = spark.createDataFrame([(None, None), ("x", None)], "path string, content binary")
    assert workbooks.members_of(nothing).count() == 0
    assert [r.company for r in workbooks.registered_list(spark, {"directory_url": f"{path}/a.xlsx", "countries": ["egypt"]}).collect()] == ["Delta"]


def test_rows_do_not_stay_in_memory():
    def peak(n):
        text = "".join(f'<row><c t="inlineStr"><is><t>company number {i} of a long list</t></is></c><c><v>{i}</v></c></row>' for i in range(n))
        source = book(text)
        del text
        tracemalloc.start()
        assert sum(1 for _ in workbooks.sheet_rows(source)) == n
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert peak(20_000) < peak(2_000) + 200_000


@pytest.mark.parametrize("header,want", [(["Firm", "Country"], {"country": 1}), (["Membership no", "Country", "Organisation"], {"company": 2, "country": 1, "category": 0}), (["Name", "country", "Web"], {"company": 0, "country": 1, "website": 2})])
def test_fields(header, want):
    assert workbooks.field_columns(header) == want
