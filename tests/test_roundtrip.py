"""Generated values are rendered, parsed in one DataFrame and compared."""

import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hearthmill.functions import dates, money, text

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
cents = st.lists(st.integers(0, 10**12), min_size=50, max_size=200)
days = st.lists(st.dates(datetime.date(1000, 1, 1), datetime.date(9999, 12, 31)), min_size=50, max_size=200)


@FEW
@given(cents)
def test_amounts(values, numbers):
    amounts = [n / 100 for n in numbers]
    assert values(money.unsigned_amount, [f"(${a:,.2f})" for a in amounts]) == amounts
    assert values(money.unsigned_amount, [f"-{a:.2f}" for a in amounts]) == amounts
    assert values(money.signed_amount, [f"\t-${a:,.2f} " for a in amounts]) == [-a for a in amounts]
    assert values(money.bill_total, [f"0.00 due ${a:,.2f}." for a in amounts]) == amounts
    assert values(money.receipt_total, [f"0.00\nT0TAL {a:.2f}L" for a in amounts]) == amounts


@FEW
@given(days)
def test_receipt_dates(values, chosen):
    slips = [f"no 2022-86-71 on {d.year:04d}/{d.month}_{d.day} 10:22" for d in chosen]
    found = values(dates.receipt_date_text, slips)
    assert found == [d.isoformat() for d in chosen]
    assert values(dates.receipt_date, found) == chosen


@FEW
@given(st.lists(st.text("0123456789 -xX", max_size=20), min_size=50, max_size=200))
def test_account_masks(values, cells):
    digits = ["".join(c for c in cell if c.isdigit()) for cell in cells]
    wanted = [f"XXXX-{d[-4:]}" if d else "XXXX-REDACTED" for d in digits]
    assert values(text.redact_account, cells) == wanted


@FEW
@given(st.lists(st.text(max_size=30).filter(lambda s: "\x00" not in s), min_size=20, max_size=100))
def test_strip(values, cells):
    cells = [c.encode("utf-8", "ignore").decode() for c in cells]
    assert values(text.strip, cells) == [c.strip() for c in cells]
