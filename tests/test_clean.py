"""Cleaning, sections, truncation, listing pages."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sievework import schemas
from sievework.functions import clean, text
from sievework.sources import listing, store


def values(spark, column, inputs):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", column(F.col("v")).alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


def test_money(spark):
    got = values(spark, clean.parse_money, ["€1,234,567.89", "£50,000", "1,500.50", "", ",", "about $12.5 or 13", None])
    assert got == [Decimal("1234567.89"), Decimal(50000), Decimal("1500.50"), None, None, Decimal("12.5"), None]


def test_date(spark):
    inputs = ["25/12/2024", "25-12-2024", "", "2024-12-25", "25/12/2024 10:11:12", "25/12/24", "31/02/2024", None]
    want = date(2024, 12, 25)
    assert values(spark, clean.parse_date, inputs) == [want, want, None, want, want, None, None, None]


def test_datetime(spark):
    got = values(spark, clean.parse_datetime, ["25/12/2024 10:11:12", "2024-12-25 10:11:12", "25/12/2024", "25/12/2024 25:00:00"])
    assert got == [datetime(2024, 12, 25, 10, 11, 12), None, None, None]


def test_migration(spark):
    got = values(spark, clean.migrate_timestamp, ["Fri Jun 13 12:54:34 IST 2025", "Fri Jux 13 12:54:34 IST 2025", "13/06/2025", ""])
    assert got == [datetime(2025, 6, 13, 12, 54, 34), None, None, None]
    assert values(spark, clean.migrate_money, ["€1,000.5", "£7", "12", "x12", "$5", ""]) == [
        Decimal("1000.50"), Decimal("7.00"), Decimal("12.00"), None, None, None
    ]


def test_strip_html(spark):
    got = values(spark, clean.strip_html, [" <b>a</b> > b ", "x <i", "plain", "<p>\n two\n</p>"])
    assert got == ["a  b", "x", "plain", "two"]


def test_blank_covers_all_white_space(spark):
    assert values(spark, clean.presence_flag, [" \t\r\n", "  ", "x", None, ""]) == [0, 0, 1, 0, 0]


def test_year(spark):
    assert values(spark, clean.contains_year, ["in 2024", "x2024", "1999", "2024/25", None]) == [1, 0, 0, 1, 0]


def test_section(spark):
    got = values(spark, text.extract_section, [
        "1 Intro\n5 Lot\nall of it\n5.1 more\n6 Next\n7 End", "a\n5.1 one\n5.2 two\n6.1 rest", "nothing", "", "x\n 5  LOT 1\nto the end", None,
    ])
    assert got == ["5 Lot\nall of it\n5.1 more", "5.1 one\n5.2 two", "", "", "5  LOT 1\nto the end", ""]


def test_truncate_never_splits_a_character(spark):
    sources, limits = ("plain text", "ééééé", "aé€😀z", ""), range(1, 12)
    cut = lambda s, n: s if len(s.encode()) <= n else s.encode()[:n].decode(errors="ignore") + "..."
    df = spark.createDataFrame([(s,) for s in sources], "v string")
    for row in df.select("v", *[text.truncate_bytes("v", n).alias(f"c{n}") for n in limits]).collect():
        assert [row[f"c{n}"] for n in limits] == [cut(row["v"], n) for n in limits]


def test_word_count(spark):
    assert values(spark, text.word_count, ["a b  c", " ", "a b", None]) == [3, 0, 2, 0]


PAGE = """<table><thead><tr><th>n</th></tr></thead><tbody>
<tr><td>1</td><td><a href="x">Supply &amp; fit</a></td><td> 77 </td><td>City <b>Council</b></td><td>01/02/2025 10:00:00</td>
<td>02/03/2025 12:00:00</td><td>Open</td><td>Live</td><td><img src="p"></td><td></td><td>05/03/2025</td><td>&euro;1,000</td></tr>
<tr><td>2</td><td>short row</td></tr></tbody></table>"""


def test_listing_rows(spark):
    pages = spark.createDataFrame([(3, PAGE)], "page_no int, html string")
    first, second = listing.extract_listing_rows(pages, "http://x/").orderBy("row_no").collect()
    assert (first["page_no"], first["title"], first["resource_id"]) == (3, "Supply & fit", "77")
    assert first["ca"] == "City <b>Council</b>" and first["pdf_url"] == "http://x/77" and first["value"] == "€1,000"
    assert second["title"] == "short row" and second["resource_id"] == "" and second["pdf_url"] == ""
    typed = clean.type_records(listing.extract_listing_rows(pages, "http://x/")).orderBy("resource_id").collect()
    assert [r["resource_id"] for r in typed] == [0, 77]
    assert typed[1]["value"] == Decimal("1000.00") and typed[1]["published"] == datetime(2025, 2, 1, 10)


def test_second_layout_needs_the_document_cell(spark):
    cells = ["", "t", "5", "ca", "x", "p", "d", "pr", "st", "", "aw", "v"]
    row = "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    full = row.replace("<td></td><td>aw", "<td>pdf</td><td>aw")
    bad = full.replace("<td>5</td>", "<td>no number</td>")
    pages = spark.createDataFrame([(1, f"<table>{row}{full}{bad}</table>")], "page_no int, html string")
    good, rejected = listing.split_bad_keys(listing.extract_listing_rows(pages, "u=", "v2"))
    assert sorted(r["pdf_url"] for r in good.collect()) == ["", "u=5"]
    assert [r["resource_id"] for r in rejected.collect()] == ["no number"]


@pytest.mark.parametrize("request_, window", [
    ({}, (1, 11)), ({"start_page": 5, "max_pages": 3}, (5, 8)), ({"offset": 7, "start_page": 5}, (1, 8)),
    ({"start_page": 4, "test_mode": True}, (4, 5)),
])
def test_page_window(request_, window):
    assert listing.page_window(**request_) == window


def test_align_schema_twice_is_once(spark):
    df = spark.createDataFrame([(1, "t", "x")], "resource_id int, title string, other string")
    once = schemas.align_schema(df, schemas.NOTICES, schemas.NOTICE_DEFAULTS)
    assert once.schema == schemas.align_schema(once, schemas.NOTICES, schemas.NOTICE_DEFAULTS).schema
    row = once.first()
    assert row["ml_status"] == "pending" and row["notification_sent"] is False and row["other"] == "x" and row["bid"] is None


def test_dictionary_lines(spark, tmp_path):
    (tmp_path / "codes.txt").write_text("72000000,IT services\n\n 48000000 ,Software, and more\n,none\n")
    rows = store.load_code_dictionary(spark, str(tmp_path / "codes.txt")).orderBy("code_pos").collect()
    assert [r["code"] for r in rows] == ["72000000", "48000000"]


def test_routes_partition_the_input(spark, tmp_path):
    df = spark.createDataFrame([(1, "u"), (2, ""), (3, None)], "resource_id long, pdf_url string")
    store.write_routes(store.route_by_url(df), str(tmp_path / "out"))
    back = {r["resource_id"]: r["route"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert back == {1: "documents", 2: "direct", 3: "direct"}


def test_times_keep_their_offset(spark):
    texts = ["2025-06-13T10:00:00.5+02:00", "2025-06-13T10:00:00Z", "2025-06-13 10:00:00", "2025-06-13T00:30:00-0100", "1969-12-31T23:00:00+01:00", "no time", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [str(r["u"]) for r in df.select("i", clean.utc_time("t").alias("u")).orderBy("i").collect()]
    assert got == ["2025-06-13 08:00:00.500000", "2025-06-13 10:00:00", "2025-06-13 10:00:00", "2025-06-13 01:30:00", "1969-12-31 22:00:00", "None", "None"]
