import datetime

import pytest

from hearthmill.functions import dates, money, probes, text


def test_strip_matches_python(values):
    cells = [" a\t", "\n a b \r\n", "\xa0x　", "\x1fy\x1c", "", "   ", None]
    assert values(text.strip, cells) == [c if c is None else c.strip() for c in cells]


def test_unsigned_amount(values):
    cells = {
        "$1,234.56": 1234.56, "($465.73)": 465.73, "-118.40": 118.4, "": 0.0, "nan": 0.0, "None": 0.0,
        "abc": 0.0, " 12 ": 12.0, ".5": 0.5, "5.": 5.0, "1e2": 100.0, "1e-2": 100.0, "1.5d": 0.0,
        "0x10": 0.0, "1_0": 0.0, "+7": 7.0, "NaN": 0.0, None: 0.0,
    }
    assert values(money.unsigned_amount, cells) == list(cells.values())


def test_signed_amount(values):
    cells = {"-$1,234.50": -1234.5, "(12.00)": 0.0, "2950.00": 2950.0, "": 0.0, "--5": 0.0, "-": 0.0, "1e-2": 0.01}
    assert values(money.signed_amount, cells) == list(cells.values())


def test_infinite_amount_is_kept(values):
    assert values(money.signed_amount, ["-inf", "Infinity"]) == [float("-inf"), float("inf")]


def test_unreadable_is_not_missing(values):
    cells = {"": False, "nan": False, "None": False, None: False, "NaN": True, "abc": True, "(1.0)": False, "$": False}
    assert values(money.unsigned_unreadable, cells) == list(cells.values())
    assert values(money.signed_unreadable, ["(1.0)", "1.0", "-"]) == [True, False, True]


def test_account_mask(values):
    cells = {
        "4000-1234-5678": "XXXX-5678", "XXXX-1234": "XXXX-1234", "12": "XXXX-12", "": "XXXX-REDACTED",
        "abc": "XXXX-REDACTED", None: "XXXX-REDACTED", "12345": "XXXX-2345",
    }
    assert values(text.redact_account, cells) == list(cells.values())


def test_account_from_file_name(values):
    cells = {
        "/in/Export_Plan_3521_091926.csv": "XXXX-3521", "file:/in/x_2026_3521.csv": "XXXX-2026",
        "/in/export.csv": "XXXX-REDACTED", "/in/a_35211.csv": "XXXX-REDACTED", "/in/1234.csv": "XXXX-1234",
        "/1234_x/a.csv": "XXXX-REDACTED",
    }
    assert values(text.account_from_file_name, cells) == list(cells.values())


def test_ledger_date(values):
    day = datetime.date
    cells = {
        "2026-09-01": day(2026, 9, 1), "2026-9-1": day(2026, 9, 1), "20260901": day(2026, 9, 1),
        "2026-09": day(2026, 9, 1), "2026-09-01T10:00:00": day(2026, 9, 1), "2026-09-01 10:00": day(2026, 9, 1),
        "09/01/2026": None, "2026-02-31": None, " 2026-09-01": None, "2026-09-01x": None, "2026-09-01 x": None,
        "": None, None: None, "20261301": None,
    }
    assert values(dates.ledger_date, cells) == list(cells.values())


RECEIPTS = {
    "2016/05/04 33.00 96.04": ("2016-05-04", 96.04),
    "2022-86-71 2016_5_4 TOTAL 1,234.56": ("2016-05-04", 234.56),
    "2016-02-31 9.99": ("2016-02-31", 9.99),
    "no figures": (None, None),
    "": (None, None),
    "2016-13-2016-05-04": (None, None),
    "2016-05-123": ("2016-05-12", None),
    "2016-05-45 12.345": (None, 12.34),
    "2016-00-10 2016-1-0 2017-10-09": ("2017-10-09", None),
    None: (None, None),
}


def test_receipt_fields(values):
    assert values(dates.receipt_date_text, RECEIPTS) == [d for d, _ in RECEIPTS.values()]
    assert values(money.receipt_total, RECEIPTS) == [t for _, t in RECEIPTS.values()]


def test_receipt_date_type(values):
    assert values(dates.receipt_date, ["2016-02-31", "2016-05-04", None]) == [None, datetime.date(2016, 5, 4), None]


def test_bill_total(values):
    cells = {
        "due $1,234.56 or 12.00": 1234.56, "12345,678.90": 345678.9, "192.168.1.1": 192.16, "none": None, "": None,
        "1,23.45": 23.45, "1234567.89": 1234567.89,
    }
    assert values(money.bill_total, cells) == list(cells.values())


def test_message_date_keeps_own_offset(values):
    cells = ["Wed, 23 Sep 2026 23:59:00 -0600", "1 Jan 2026 00:00:00 +0000", "soon", None]
    assert values(dates.message_date, cells) == [
        datetime.date(2026, 9, 23), datetime.date(2026, 1, 1), None, None
    ]


def test_ping(values):
    cells = ["64 bytes time=4.12 ms", "Time<1ms", "time=abc", "", "time=1 ms time=2 ms", None]
    assert values(probes.ping_latency, cells) == [4.12, 1.0, None, None, 1.0, None]
    assert values(probes.ping_status, cells) == ["ONLINE", "ONLINE", "TIMEOUT", "TIMEOUT", "ONLINE", "TIMEOUT"]


def test_daemon_document(values):
    cells = {
        '{"ContainersRunning": 4}': 4, '{"running": 4}': 0, "{}": 0, "broken": None, "[1]": None,
        '{"ContainersRunning": "7"}': 7, '{"ContainersRunning": "x"}': None, '{"ContainersRunning": null}': None,
    }
    assert values(probes.running_containers, cells) == list(cells.values())


def test_collection_time(spark):
    now = datetime.datetime.now(datetime.UTC).replace(microsecond=0, tzinfo=None)
    stamp = spark.range(1).select(dates.collected_at()).first()[0]
    assert abs(datetime.datetime.strptime(stamp, "%Y-%m-%dT%H:%M:%SZ") - now) < datetime.timedelta(minutes=1)


def test_personal_data(values):
    masked = values(text.mask_personal_data, ["mail a.b@c.org, acct 77776666, room 12345"])
    assert masked == ["mail [EMAIL], acct [NUMBER], room 12345"]


PAGES = [
    "<html><style>p{}</style><p> Hi <b>there</b></p><script>var a='</p>';</script><!-- x --> end &amp;lt; &nbsp;</html>",
    "plain &lt;b&gt;",
    "<a title='a>b' href=\"x>y\">link</a><br/>two\n lines",
    "<p>open<script>never closed <b>x</b>",
    "<template><p>no</p></template>yes",
    "<title>cut &amp</title><p>&copy 2026 &euro;5 &amp;copy; &#39;x&#39; a & b &ampersand</p>",
    "",
]


def test_html_text_native_equals_parser(values):
    from hearthmill.operators.messages import visible_text

    native = values(text.html_visible_text, PAGES)
    assert native == [visible_text(page) for page in PAGES]
    assert native[0] == "Hi\nthere\nend &lt;"
    assert native[2] == "link\ntwo\n lines"


def test_html_first_construct_wins_and_all_references(values):
    """Against the standard library, which shares no constants with the column form."""
    from html import unescape

    pages = ['<p>a</p><script>var s="<!--";</script><p>Total $9.99</p>', "<!-- <script> -->b<style>/*<script>*/</style>c", "<a title='<!--'>d</a>e"]
    assert values(text.html_visible_text, pages) == ["a\nTotal $9.99", "b\nc", "d\ne"]
    cells = [
        "x&eacute;y &#233; &#xE9; &#X1F600; &#128512 z", "&#150;&#x80;&#129;|&#0;|&#xD800;|&#1114112;|&#99999999999999999999;|&#xFFFFFFFFFFFFFFFFFFFF;", "&#1;|&#xFFFE;|&#64976;|&#000065;",
        "&nosuch; &amp;eacute; &#38;lt; &NotEqualTilde; &; &# &#x; &#xg;", "&Alpha;&beta;&copy", None,
    ]
    assert values(text.html_visible_text, cells) == [c if c is None else unescape(c) for c in cells]


def test_html_entities():
    from hearthmill.operators.messages import visible_text

    assert visible_text("&eacute;&#8364;&#150;&#x41; &nosuch; &amp<br>") == "\xe9\u20ac\u2013A &nosuch &"


def test_html_hides_ruby_annotations():
    from hearthmill.operators.messages import visible_text

    assert visible_text("<ruby>a<rp>(</rp><rt>b</ruby>c") == "a\nc"


@pytest.mark.parametrize("size", [200_000])
def test_html_long_tag_and_text(values, size):
    page = "<img alt='" + "x" * size + "'>" + "y" * size + "<a " + "b " * size + ">z</a>"
    assert values(text.html_visible_text, [page]) == ["y" * size + "\nz"]


def test_headers_to_snake_case():
    assert text.snake_case(" Post Date ") == "post_date"
    assert text.snake_case("Sub-description") == "sub-description"
