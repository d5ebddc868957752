import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlens.functions import surrogate_key, try_date, try_money, try_rate, yn_flag, blank_to_null


def py_key(*parts):
    norm = ["^^" if p is None else str(p).strip().upper() for p in parts]
    return hashlib.sha256("||".join(norm).encode()).hexdigest()[:24]


def test_surrogate_key_matches_definition(spark):
    df = spark.createDataFrame(
        [("CBS", "A1"), ("cbs", " a1 "), (None, "A1"), ("TRD", "A1"), ("CBS", None)],
        "sys string, id string")
    got = [r.k for r in df.select(surrogate_key("sys", "id").alias("k")).collect()]
    want = [py_key("CBS", "A1"), py_key("cbs", " a1 "), py_key(None, "A1"),
            py_key("TRD", "A1"), py_key("CBS", None)]
    assert got == want
    # case and padding do not change the key; system and null position do
    assert got[0] == got[1]
    assert len({got[0], got[2], got[3], got[4]}) == 4
    assert all(len(k) == 24 for k in got)


def test_typing(spark):
    df = spark.createDataFrame(
        [("2026-03-31", "12.345", "0.12345", "Y"),
         (" 2026-3-1 ", "", "x", "N"),
         ("2026-03", "1e3", None, "y"),
         ("2026", "99999999999999999999999", "", ""),
         ("", "-0.005", "1.5", None),
         ("31/03/2026", "abc", "0.1", " Y")],
        "d string, m string, r string, f string")
    out = df.select(try_date("d").alias("d"), try_money("m").alias("m"),
                    try_rate("r").alias("r"), yn_flag("f").alias("f")).collect()
    import datetime as dt
    assert [r.d for r in out] == [dt.date(2026, 3, 31), dt.date(2026, 3, 1), None, None, None, None]
    assert [r.m for r in out] == [Decimal("12.35"), None, Decimal("1000.00"), None,
                                  Decimal("-0.01"), None]
    assert [r.r for r in out] == [Decimal("0.1235"), None, None, None, Decimal("1.5000"),
                                  Decimal("0.1000")]
    assert [r.f for r in out] == [True, False, False, False, None, False]


def test_blank_to_null(spark):
    df = spark.createDataFrame([(" x ",), ("",), ("   ",), (None,)], "v string")
    assert [r.v for r in df.select(blank_to_null("v").alias("v")).collect()] == \
        ["x", None, None, None]
