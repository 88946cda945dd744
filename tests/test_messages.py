import base64

import pytest
from pyspark.sql import functions as F

from hearthmill.operators.messages import extract_bills
from hearthmill.operators.quality import split_errors
from hearthmill.sources import documents, sinks

HEAD = "From: a@example.com\nSubject: March bill\nDate: Fri, 6 Mar 2026 08:15:00 -0600\n"
HTML = (
    "<html><body><div>\n  <h1>Statement</h1>\n <p>Hi,</p><br><p>Account number: 77776666</p>"
    "<p>Please pay: <strong>$212.40</strong></p></div></body></html>"
)
MAILS = {
    "html": HEAD + 'Content-Type: text/html; charset="UTF-8"\n\n' + HTML,
    "twin": HEAD
    + 'Content-Type: multipart/alternative; boundary="b"\n\n--b\nContent-Type: text/html\n\n<p>$999.99</p>\n'
    + "--b\nContent-Type: text/plain\n\nplain 1,234.56\n--b--\n",
    "nested": HEAD
    + 'Content-Type: multipart/mixed; boundary="o"\n\n--o\nContent-Type: multipart/alternative; boundary="i"\n\n'
    + "--i\nContent-Type: text/plain\n\nfirst 1.00\n--i--\n--o\nContent-Type: text/plain\n"
    + "Content-Disposition: attachment; filename=x.txt\n\nsecond 2.00\n--o--\n",
    "nodate": "Subject:   \nContent-Type: text/plain\n\nno figures",
    "baddate": "Subject: x\nDate: soon\n\nbody 5.00",
    "late": "Subject: x\nDate: Thu, 31 Dec 2026 23:59:00 -0600\n\nbody",
    "encoded": "Subject: =?utf-8?b?" + base64.b64encode("Reçu été".encode()).decode() + "?=\n\nx 3.25",
    "charset": "Subject: x\nContent-Type: text/plain; charset=no-such\n\ncafé 4.50",
    "image": "Subject: x\nContent-Type: image/png\n\nabc",
    "quoted": "Subject: x\nContent-Type: text/plain; charset=latin-1\nContent-Transfer-Encoding: quoted-printable\n\ncaf=E9 7.00",
}
WANTED = {
    "html": ("2026-03-06", "March bill", 212.4, "Statement\nHi,\nAccount number: 77776666\nPlease pay:\n$212.40"),
    "twin": ("2026-03-06", "March bill", 1234.56, "plain 1,234.56"),
    "nested": ("2026-03-06", "March bill", 2.0, "first 1.00\nsecond 2.00"),
    "nodate": (None, None, None, "no figures"),
    "baddate": (None, "x", 5.0, "body 5.00"),
    "late": ("2026-12-31", "x", None, "body"),
    "encoded": (None, "Reçu été", 3.25, "x 3.25"),
    "charset": (None, "x", 4.5, "café 4.50"),
    "image": (None, "x", None, ""),
    "quoted": (None, "x", 7.0, "café 7.00"),
}


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    for name, mail in MAILS.items():
        (folder / f"bill_{name}.eml").write_bytes(mail.encode())
    (folder / "bill_broken.eml").write_bytes(b"\x89PNG\r\n\x1a\n\xff\xd8 no headers")
    (folder / "other.txt").write_text("Subject: not listed\n\n9.99")
    return str(folder)


def test_messages(spark, inbox):
    found = extract_bills(documents.read_documents(spark, inbox, "bill_*.eml"))
    bills, rejected = split_errors(found)
    name = F.regexp_extract("path", r"bill_(\w+)\.eml", 1)
    rows = bills.select(name, "date", "subject", "total_amount", "raw_body_text").collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == WANTED
    (bad,) = rejected.select(name, "error").collect()
    assert bad[0] == "broken" and "headers" in bad[1]


def test_discovery_is_sorted_and_filtered(spark, inbox):
    paths = [r["path"] for r in documents.discover_documents(spark, inbox, "*.eml").collect()]
    assert len(paths) == len(MAILS) + 1 and paths == sorted(paths)


def test_no_matching_file_is_an_error(spark, inbox):
    with pytest.raises(FileNotFoundError):
        documents.read_documents(spark, inbox, "*.msg")


def test_staged_csv(spark, inbox, tmp_path):
    bills, _ = split_errors(extract_bills(documents.read_documents(spark, inbox, "bill_*.eml")))
    path = str(tmp_path / "staged")
    for _ in range(2):
        sinks.stage_bills_csv(bills, path)
    back = sinks.read_staged_bills(spark, path)
    assert back.columns == ["date", "subject", "total_amount", "raw_body_text"]
    assert back.count() == len(MAILS)
    assert back.where("subject = 'Reçu été'").first()["total_amount"] == 3.25
    assert back.where("total_amount = 212.40").first()["raw_body_text"] == WANTED["html"][3]


def test_empty_batch_still_writes_the_header(spark, inbox, tmp_path):
    bills, _ = split_errors(extract_bills(documents.read_documents(spark, inbox, "bill_broken.eml")))
    sinks.stage_bills_csv(bills, str(tmp_path / "staged"))
    (line,) = spark.read.text(str(tmp_path / "staged")).collect()
    assert line[0] == "date,subject,total_amount,raw_body_text"
