"""Scalar expressions against plain Python models."""

import datetime as dt
import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom import functions as x
from ledgerloom.functions.text import capitalise_words

DELIMITERS = set(" \t\n!?@\"^#$&~_,.:;+-*%/|\\[](){}<>")


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def initcap(text):
    out, start = [], True
    for ch in text.lower():
        out.append(ch.upper() if start else ch)
        start = ch in DELIMITERS
    return "".join(out)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.text(alphabet="abZ'é-_. (x)/\\@#5\t", max_size=12), min_size=5, max_size=60))
def test_initcap(spark, values):
    assert column(spark, values, capitalise_words) == [initcap(v) for v in values]


def test_blank_handling(spark):
    values = [None, "", "   ", " a B ", "\tq"]
    assert column(spark, values, x.norm_upper) == [None, None, "", "A B", "\tQ"]
    assert column(spark, values, x.norm_lower) == [None, None, "", "a b", "\tq"]
    assert column(spark, values, x.missing_flag) == [True, True, True, False, False]
    assert column(spark, ["usd ", "", None], x.default_currency) == ["USD", "USD", "USD"]


def test_dates(spark):
    values = ["2024-02-29", "2024-02-30", "02/03/2024", "2/3/2024", "13/45/2024", "05-Mar-2024", "05-MAR-2024", "2024", "", None, "x", "2024-01-02T10:00:00", " 2024-01-02 "]
    d = dt.date
    want = [d(2024, 2, 29), None, d(2024, 2, 3), d(2024, 2, 3), None, d(2024, 3, 5), d(2024, 3, 5), None, None, None, None, d(2024, 1, 2), d(2024, 1, 2)]
    assert column(spark, values, x.safe_date) == want
    assert column(spark, values, x.invalid_date_flag) == [w is None and bool(v and v.strip()) for v, w in zip(values, want)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.one_of(
    st.decimals(min_value=-10**15, max_value=10**15, allow_nan=False, allow_infinity=False, places=6).map(str),
    st.sampled_from(["", " 12.34567 ", "1,234", "abc", "1e3", "9" * 18, "9" * 15, "-0"]),
), min_size=5, max_size=60))
def test_numbers(spark, values):
    def dec(text, places, digits):
        try:
            number = Decimal(text.strip()).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)
        except InvalidOperation:
            return None
        return number if abs(number) < Decimal(10) ** (digits - places) else None

    assert column(spark, values, x.safe_decimal) == [dec(v, 4, 18) for v in values]
    assert column(spark, values, x.safe_integer) == [None if dec(v, 0, 38) is None else int(dec(v, 0, 38)) for v in values]


def test_line_total_overflow_is_null(spark):
    df = spark.createDataFrame([(10**17, Decimal("99999999999999.0000")), (3, Decimal("1.5000")), (None, Decimal("1.0000"))], "q bigint, p decimal(18,4)")
    got = [r[0] for r in df.select(x.line_total(F.col("q"), F.col("p"))).collect()]
    assert got == [None, Decimal("4.5000"), None]


def test_email(spark):
    pattern = re.compile(r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}")
    values = ["a@b.co", " A@B.CO ", "a@b", "a b@c.de", "xx a@b.com yy", "a@b.com\n", "", "  ", None, "@b.com", "a@b.c"]
    want = ["MISSING" if not (v or "").strip(" ") else "VALID" if pattern.fullmatch(v.strip(" ").lower()) else "INVALID" for v in values]
    assert column(spark, values, x.email_status) == want
    assert column(spark, ["a@b.co", "plain"], x.email_domain) == ["b.co", ""]


def test_codes(spark):
    values = ["Credit Card", "CC", "debit_card", "DC", "PayPal", "Pay Pal", "wire", "bank transfer", "", "  ", None, "crypto"]
    want = ["CREDIT_CARD", "CREDIT_CARD", "DEBIT_CARD", "DEBIT_CARD", "PAYPAL", "OTHER", "BANK_TRANSFER", "BANK_TRANSFER", "MISSING", "MISSING", "MISSING", "OTHER"]
    assert column(spark, values, x.payment_method_code) == want
    assert column(spark, [" gold ", "vip", None], x.loyalty_tier_code) == ["GOLD", "UNKNOWN", "UNKNOWN"]
    assert column(spark, ["Yes", "0", "T", "maybe", "", None], x.text_to_boolean) == [True, False, True, None, None, None]


def test_full_names(spark):
    df = spark.createDataFrame(
        [(None, None, "ada lovelace king"), (None, None, "plato"), ("x", None, "ada b"), ("", "y", "ada b"), (None, None, ""), (None, None, None)],
        "f string, l string, n string",
    )
    got = [tuple(r) for r in df.select(x.first_name_from(F.col("f"), F.col("n")), x.last_name_from(F.col("l"), F.col("n"))).collect()]
    assert got == [("Ada", "Lovelace"), ("Plato", ""), ("X", "B"), ("Ada", "Y"), (None, None), (None, None)]
