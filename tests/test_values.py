from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadloom.functions.text import FLAIR_SYMBOLS, WHITESPACE, is_blank, only_symbols, strip
from threadloom.functions.values import epoch, flag, rounded_ratio


def test_whitespace_is_what_strip_removes():
    assert all(c.isspace() for c in WHITESPACE)
    assert len(WHITESPACE) == sum(chr(i).isspace() for i in range(0x110000))


@pytest.fixture(scope="module")
def texts(spark):
    values = [None, "", " ", "\t\n", "\u00a0", "\u2003x\u3000", " a b ", "!!!", " *\t", "!a",
              "~`|", "[deleted]", "\u200b", "{}<>?/\\"]
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_strip_and_blank(texts):
    for row in texts.select("v", strip(F.col("v")).alias("s"), is_blank(F.col("v")).alias("b")).collect():
        assert row.s == (None if row.v is None else row.v.strip())
        assert row.b == (row.v is None or row.v.strip() == "")


def test_only_symbols(texts):
    for row in texts.select("v", only_symbols(F.col("v")).alias("o")).collect():
        expected = bool(row.v) and all(c in FLAIR_SYMBOLS for c in row.v.strip())
        assert row.o == expected, row


def test_flag(spark):
    df = spark.createDataFrame(
        [(None, None, None, None), (0, 0.0, "", False), (2, 0.9, "x", True),
         (-1, -1.5, "0", True), (1, float("nan"), " ", True)],
        "i int, d double, s string, b boolean",
    )
    got = df.select(*[flag(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]).collect()
    assert [tuple(r) for r in got] == [
        (False, False, False, False), (False, False, False, False), (True, False, True, True),
        (True, True, True, True), (True, False, True, True),
    ]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**4)), min_size=200, max_size=200))
def test_rounded_ratio_is_decimal_half_up(spark, pairs):
    pairs = pairs + [(1, 8), (3, 8), (5, 1000), (0, 3), (2675, 1000)]
    df = spark.createDataFrame(pairs, "t long, n long")
    for row in df.select("t", "n", rounded_ratio(F.col("t"), F.col("n")).alias("r")).collect():
        exact = (Decimal(row.t) / Decimal(row.n)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert row.r == float(exact)


def test_ratio_without_rows_is_null(spark):
    row = spark.range(1).select(rounded_ratio(F.lit(0), F.lit(0)).alias("r")).first()
    assert row.r is None


def test_epoch():
    assert epoch("1970-01-02T00:00:01") == 86401
    assert epoch("2015-05-28T00:00:00") == 1432771200
