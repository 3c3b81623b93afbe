from datetime import date

import pytest
from pyspark.sql import functions as F

from siltworks.functions import columns as fn
from siltworks.functions import names


def values(spark, build, *given):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_null_tokens(spark):
    assert values(spark, fn.null_if_token, " N/A\t", "null", "", "x", None, "-", "none of it") == [None, None, None, "x", None, None, "none of it"]


def test_numbers(spark):
    assert values(spark, fn.clean_number, "$1,061.5", "86 832€", "5d", "1e3", ".5", "TND 3", "", None) == [1061.5, 86832.0, None, 1000.0, 0.5, None, None, None]
    assert values(spark, fn.clean_integer, "14.0", "14.4", "-10", "99999999999") == [14, None, -10, None]


@pytest.mark.parametrize(
    ("text", "day"),
    [("1999-03-14", (1999, 3, 14)), (" 14/03/1999 ", (1999, 3, 14)), ("08/12/89", (1989, 12, 8)), ("08/12/21", (2021, 12, 8)), ("12/25/1998", (1998, 12, 25)), ("1987", (1987, 1, 1)), ("19990314", (1999, 3, 14)), ("August 3, 1996", (1996, 8, 3)), ("1995-05", (1995, 5, 1)), ("31/02/2001", None), ("x", None)],
)
def test_dates(spark, text, day):
    assert values(spark, fn.parsed_date, text) == [date(*day) if day else None]


def test_dates_of_the_wrong_width_or_digits(spark):
    assert values(spark, fn.parsed_date, "1999-3-14", "99-03-1999", "१९९९-03-14", "9999999", "1999-03-14x", "August 3 1996", None) == [None] * 7


@pytest.mark.parametrize("text", ["2024-W05-3", "2024W053", "2024-W05", "2020-W53-7", "2021-W53-1", "2026-W01-1", "2024-W00-1", "2024-W05-8", "2024-W053", "2024W05-3", "2024-W5-3", "0000-W01-1"])
def test_week_dates(spark, text):
    try:
        day = date.fromisoformat(text)
    except ValueError:
        day = None
    assert values(spark, fn.iso_date, text) == [day]


def test_epochs_and_phones(spark):
    assert values(spark, fn.epoch_text, "0", "1700000000", "1700000000000", "x") == ["1970-01-01 00:00:00", "2023-11-14 22:13:20", "2023-11-14 22:13:20", None]
    assert values(spark, fn.phone, "+216.20.123.456", "00216 31 234 567", "0 50 123 456", "2012345", "00000000", None) == ["20123456", "31234567", "50123456", None, None, None]


def test_predicates(spark):
    assert values(spark, fn.is_email, "a@b.tn", "é@b.tn", "a@b", None) == [True, False, False, None]
    assert values(spark, fn.is_iban, "TN59 1000 6035 1835 9847 8831", "TN59") == [True, False]
    assert values(spark, fn.repaired_gender, "Homme", "féminin", "M", "x", None) == ["m", "f", "m", None, None]
    assert values(spark, fn.word_count, " a  b ", "", None) == [2, 0, None]


def test_names():
    assert [names.snake(n) for n in ("CustomerID", "HTTPServer", "my Col.x", "_a_")] == ["customer_id", "http_server", "my_col_x", "a"]
    assert names.is_financial("account_id") and not names.is_financial("account_id", whole_words=True)
    assert names.is_date("created_at") and names.is_date("end") and not names.is_date("gender") and not names.is_date("attend")
    assert names.domain("x", ["client_id"]) == "customer_profile" and names.domain("audit_x", ["a"]) == "event_log"
    assert names.Resolver(["IBAN", "b"], {"r": "B", "s": "none"}).first(["iban"], "r") == "b"
