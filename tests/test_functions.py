import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from medallion.functions.connect_decimal import decode_connect_decimal, encode_connect_decimal
from medallion.functions.keys import attribute_hash, business_key


@pytest.mark.parametrize(
    "text,expected",
    [
        ("BOI=", Decimal("12.50")),  # worked example: 0x04E2 = 1250
        ("A1I=", Decimal("8.50")),
        ("AIA=", Decimal("1.28")),
        ("/w==", Decimal("-0.01")),  # two's complement, signed
        ("gAA=", Decimal("-327.68")),
        ("AA==", Decimal("0.00")),
        (None, None),
        ("not base64!", None),
        ("AAAAAAAAAAAE4g==", Decimal("12.50")),  # sign-extended to ten bytes
        ("//////////////////////////8=", Decimal("-0.01")),  # and to twenty
        ("AQIDBAUGBwgJ", None),  # nine bytes: beyond numeric(10,2)
        ("", None),
        ("AlQL5AA=", None),  # unscaled 10,000,000,000 overflows numeric(10,2)
    ],
)
def test_decode_connect_decimal(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(decode_connect_decimal(F.col("t"), 10, 2).alias("d")).first()["d"]
    assert got == expected


@pytest.mark.parametrize("unscaled", [10**37 - 1, -(10**37), 2**64, -(2**64), 2**63, -(2**63) - 1, 255, -256, 0])
@pytest.mark.parametrize("extra", [0, 1, 9])
def test_decode_wide_decimals(spark, unscaled, extra):
    import base64

    size = (unscaled.bit_length() + 8) // 8 + extra
    text = base64.b64encode(unscaled.to_bytes(size, "big", signed=True)).decode()
    got = spark.createDataFrame([(text,)], "t string").select(decode_connect_decimal(F.col("t"), 38, 0).alias("d")).first()["d"]
    assert got == unscaled


def test_decimal_round_trip(spark):
    values = ["0.00", "0.01", "1.27", "1.28", "-1.28", "-1.29", "12.50", "327.67", "327.68",
              "-0.01", "99999999.99", "-99999999.99", "8.50", "21474836.47"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(F.col("v").cast("decimal(10,2)").alias("v"))
    out = df.select("v", decode_connect_decimal(encode_connect_decimal(F.col("v"), 2), 10, 2).alias("back")).collect()
    for r in out:
        assert r["v"] == r["back"], r


def _sha(parts):
    return hashlib.sha256("||".join(parts).encode()).hexdigest()


def test_business_key_normalizes_and_nulls(spark):
    df = spark.createDataFrame([(" ms. chanthy ", None, 7)], "a string, b string, c int")
    got = df.select(business_key("a", "b", "c").alias("k")).first()["k"]
    assert got == _sha(["MS. CHANTHY", "^^NULL^^", "7"])


def test_business_key_upper_cases_accents(spark):
    df = spark.createDataFrame([("é",)], "a string")
    assert df.select(business_key("a").alias("k")).first()["k"] == _sha(["É"])


def test_attribute_hash_keeps_case_and_order(spark):
    df = spark.createDataFrame([(" Wok ", "x", True)], "a string, b string, d boolean")
    row = df.select(attribute_hash("a", "b", "d").alias("h1"), attribute_hash("b", "a", "d").alias("h2")).first()
    assert row["h1"] == _sha([" Wok ", "x", "true"])
    assert row["h1"] != row["h2"]
