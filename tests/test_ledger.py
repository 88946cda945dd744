import datetime

import pytest
from pyspark.sql import Observation

from hearthmill.operators import ledger
from hearthmill.operators.quality import split_errors
from hearthmill.sources import statements

SPLIT_HEADER = '"Account Number","Post Date","Check","Description","Debit","Credit","Status"'
SPLIT_ROWS = [
    '"XXXX-4417","2026-03-02","","GREENGROCER 8","-118.40","","Cleared"',
    '"XXXX-4417","2026-03-04","","BOOKS ""R"" US","-31.05","","Cleared"',
    '"XXXX-4417","2026-03-07","101","CITY UTIL","-87.00","","Cleared"',
    '"XXXX-4417","2026-03-11","","FUEL 77","-54.30","","posted"',
    '"XXXX-4417","2026-03-15","","PAY","","2950.00","Cleared"',
    '"XXXX-4417","2026-03-20","","LUNCH","-12.75",""," PENDING "',
]


@pytest.fixture
def folder(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.write_text("\n".join(lines), encoding="utf-8")
        return str(path)

    return write


def amounts(rows):
    return sorted(r["amount"] for r in rows.collect())


def test_split_statement(spark, folder):
    rows = ledger.canonical(ledger.read_ledger(spark, folder("a.csv", SPLIT_HEADER, *SPLIT_ROWS)))
    assert rows.columns == ["account_number", "post_date", "check", "description", "amount", "status"]
    found = sorted(rows.collect(), key=lambda r: r["post_date"])
    assert [r["amount"] for r in found] == [-118.4, -31.05, -87.0, -54.3, 2950.0]
    assert {r["account_number"] for r in found} == {"XXXX-4417"}
    assert [r["check"] for r in found] == ["", "", "101", "", ""]
    assert found[1]["description"] == 'BOOKS "R" US'
    assert found[3]["status"] == "posted"
    assert found[0]["post_date"] == datetime.date(2026, 3, 2)


def test_signed_statement(spark, folder):
    path = folder(
        "Export_3521_091926.csv", "Date,Sub-description,Memo,Amount",
        '2026-01-02, Rent ,x,"-$1,234.50"', "bad date,Gift,y,(12.00)", "2026-01-03,Pay,z,10",
    )
    found = sorted(ledger.read_ledger(spark, path).collect(), key=lambda r: r["amount"])
    assert [r["amount"] for r in found] == [-1234.5, 0.0, 10.0]
    assert [r["amount_ok"] for r in found] == [True, False, True]
    assert found[1]["post_date"] is None and found[1]["post_date_raw"] == "bad date"
    assert found[1]["amount_raw"] == "(12.00)"
    assert {(r["account_number"], r["status"], r["check"]) for r in found} == {("XXXX-3521", "Cleared", "")}
    assert found[0]["description"] == "Rent"


def test_layouts_with_columns_in_any_order(spark, folder, tmp_path):
    folder("a.csv", SPLIT_HEADER, *SPLIT_ROWS)
    folder("b.csv", "status,credit,debit,description,check,post date, Account Number", "ok,5,2,net,,2026-01-01,9876")
    folder("c d_7777.csv", "Amount,Sub-description,Date", "1.5,x,2026-01-01")
    rows, rejected = split_errors(ledger.read_ledger(spark, str(tmp_path)))
    assert rejected.count() == 0
    assert amounts(rows) == sorted([-118.4, -31.05, -87.0, -54.3, 2950.0, 3.0, 1.5])
    by_amount = {r["amount"]: r["account_number"] for r in rows.collect()}
    assert by_amount[3.0] == "XXXX-9876" and by_amount[1.5] == "XXXX-7777"


def test_short_long_and_multi_line_rows(spark, folder):
    path = folder(
        "a.csv", SPLIT_HEADER,
        '"1","2026-01-01","","two\nlines","1.00","","ok"',
        '"1","2026-01-01","","short","2.00"',
        '"1","2026-01-01","","long","3.00","","ok","extra"',
    )
    rows, rejected = split_errors(ledger.read_ledger(spark, path))
    assert amounts(rows) == [-2.0, -1.0]
    assert {r["description"] for r in rows.collect()} == {"two\nlines", "short"}
    (bad,) = rejected.collect()
    assert "extra" in bad["record"] and bad["error"] == "more cells than the header"


def test_long_rows_of_a_layout_with_dropped_columns(spark, folder):
    path = folder(
        "x_1234.csv", "Date,Sub-description,Amount,Memo,Tail",
        "2026-01-01,fits,1.00,m,t", "2026-01-02,short,2.00", '2026-01-03,"q, ""uoted""",3.00,m,""',
        "2026-01-04,long,4.00,m,,x", "2026-01-05,long,5.00,m,t,", '2026-01-06,long,6.00,"m,",t,y',
    )
    rows, rejected = split_errors(ledger.read_ledger(spark, path))
    assert amounts(rows) == [1.0, 2.0, 3.0]
    assert sorted(r["record"][:10] for r in rejected.collect()) == ["2026-01-04", "2026-01-05", "2026-01-06"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_layout_scan_agrees(spark, folder, multi_line):
    path = folder("a.csv", SPLIT_HEADER, *SPLIT_ROWS)
    rows = statements.read_layout(spark, path, statements.header_columns(SPLIT_HEADER), multi_line)
    assert amounts(ledger.normalize_split(rows)) == amounts(ledger.read_ledger(spark, path))


def test_unknown_layout_is_kept_aside(spark, folder, tmp_path):
    folder("a.csv", SPLIT_HEADER, *SPLIT_ROWS)
    folder("b.csv", "Foo,Bar", "1,2", "3,4")
    rows, rejected = split_errors(ledger.read_ledger(spark, str(tmp_path)))
    assert rows.count() == 5
    assert sorted(r["record"] for r in rejected.collect()) == ["1,2", "3,4", "Foo,Bar"]


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ledger.read_ledger(spark, str(tmp_path / "none.csv"))


def test_missing_columns_fail_before_any_job(spark):
    frame = spark.createDataFrame([("1",)], "Amount string")
    with pytest.raises(ledger.LayoutError, match="post_date"):
        ledger.normalize_split(frame)
    with pytest.raises(ledger.LayoutError, match="Sub-description"):
        ledger.normalize_signed(frame)


def test_pending_rows_are_counted(spark, folder):
    rows = statements.read_layout(
        spark, folder("a.csv", SPLIT_HEADER, *SPLIT_ROWS), statements.header_columns(SPLIT_HEADER)
    )
    counts = Observation("pending")
    assert ledger.normalize_split(rows, counts).count() == 5
    assert counts.get == {"pending_rows": 1}


def test_blank_lines_and_repeated_or_blank_headers(spark, folder):
    assert statements.header_columns('A, a ,,"x,y",A') == ["A", "a.1", "Unnamed: 2", "x,y", "A.2"]
    path = folder("a_1111.csv", "", "Date,Sub-description,Amount,Amount,", "2026-01-01,x,1,2,", "", "2026-01-02,y,3,4,")
    assert amounts(ledger.read_ledger(spark, path)) == [1.0, 3.0]


def test_repeated_required_column_is_kept_aside(spark, folder):
    path = folder("a.csv", SPLIT_HEADER.replace('"Check"', '"Check","post_date"'), '"1","2026-01-01","","2026-01-02","d","1","","ok"')
    rows = ledger.read_ledger(spark, path).collect()
    assert {r["error"] for r in rows} == {"unknown layout"} and len(rows) == 2


def test_header_only_file_gives_no_rows(spark, folder):
    assert ledger.read_ledger(spark, folder("a.csv", SPLIT_HEADER)).count() == 0
