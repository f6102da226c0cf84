from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from halala.functions import amounts, casts, documents, keys


def one(spark, expression, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return frame.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-09-01", dt.date(2026, 9, 1)),
        (" 2026-9-1 ", dt.date(2026, 9, 1)),
        ("2026", None),
        ("2026-09", None),
        ("", None),
        ("soon", None),
        ("2026-13-01", None),
    ],
)
def test_date_or_null(spark, text, expected):
    assert one(spark, casts.date_or_null("t"), t=text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("1.23455", Decimal("1.2346")), ("1e3", Decimal("1000.0000")), (" 5 ", Decimal("5.0000")), ("", None), ("abc", None)],
)
def test_decimal_or_null(spark, text, expected):
    assert one(spark, casts.decimal_or_null("t", 4), t=text) == expected


def test_timestamps(spark):
    cut = casts.naive_timestamp_or_null("t")
    assert one(spark, cut, t="2026-09-01T09:00:00+00:00") == dt.datetime(2026, 9, 1, 9)
    assert one(spark, cut, t="not yet") is None
    assert one(spark, casts.epoch_to_naive("t"), t="1788307199") == dt.datetime(2026, 9, 1, 23, 59, 59)
    assert one(spark, casts.epoch_to_naive(F.lit(None).cast("string"))) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, casts.epoch_to_naive("t"), t="later")


def test_document_numbers_stay_exact(spark):
    raw = '{"rates": {"X": 1234567890.123456789012, "Y": null, "1. open": "3"}}'
    doc = documents.document("raw")
    assert one(spark, documents.text_at(doc, "rates", "X"), raw=raw) == "1234567890.123456789012"
    assert one(spark, documents.text_at(doc, "rates", "Y"), raw=raw) is None
    assert one(spark, documents.text_at(doc, "rates", "1. open"), raw=raw) == "3"
    assert one(spark, documents.text_at(doc, "nowhere", "X"), raw=raw) is None
    members = one(spark, documents.members(documents.node_at(doc, "rates")), raw=raw)
    assert members == {"X": "1234567890.123456789012", "Y": None, "1. open": "3"}


@pytest.mark.parametrize("raw", ['{"a": ', '{"a": 1} tail', "[1]", "null"])
def test_only_one_whole_object_is_a_document(spark, raw):
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        assert one(spark, F.when(documents.one_object("raw"), 1).otherwise(F.raise_error(F.lit("malformed"))), raw=raw)


def test_two_objects_are_not_one_document(spark):
    assert one(spark, documents.one_object("raw"), raw='{"a": 1}, {"b": 2}') is False
    assert one(spark, documents.one_object("raw"), raw='{"a": 1}\n') is True


def test_keys(spark):
    assert one(spark, keys.hashed("t"), t="XAU") == hashlib.md5(b"XAU").hexdigest()
    assert one(spark, keys.hashed(F.lit(None).cast("string"))) is None
    joined = hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-7").hexdigest()
    assert one(spark, keys.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(7))) == joined
    assert one(spark, keys.date_key(F.lit(dt.date(2026, 9, 1)))) == 20260901


def test_money(spark):
    product = amounts.exact_product(F.lit("1.2345").cast("decimal(38,4)"), F.lit("2.3456").cast("decimal(38,4)"))
    assert one(spark, product) == Decimal("2.89564320")
    huge = F.lit("123456789012345678").cast("decimal(38,4)")
    with pytest.raises(Exception, match="30 integer digits"):
        one(spark, amounts.exact_product(huge, huge))
    assert one(spark, amounts.exact_product(huge, huge, strict=False)) is None
    wide = F.lit("-123456789012345.6789").cast("decimal(38,4)")
    assert one(spark, amounts.exact_product(wide, F.lit("0.0003").cast("decimal(38,4)"))) == Decimal("-37037036703.70370367")
    assert one(spark, amounts.exact_product(wide, F.lit(None).cast("decimal(38,4)"))) is None
    third = amounts.ratio(F.lit("1").cast("decimal(38,6)"), F.lit("3").cast("decimal(38,6)"))
    assert one(spark, third) == 1 / 3
    change = amounts.relative_change(F.col("now").cast("double"), F.col("before").cast("double"))
    assert one(spark, change, now=3.0, before=2.0) == 0.5
    assert one(spark, change, now=3.0, before=0.0) == 0.0
    assert one(spark, change, now=3.0, before=None) == 0.0
    assert one(spark, amounts.signed_quantity(F.lit("SELL"), F.lit(5))) == -5
    assert one(spark, amounts.signed_quantity(F.lit("GIFT"), F.lit(5))) is None
