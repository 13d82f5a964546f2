from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from siltstone import functions as fn


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_surrogate_key_leaves_null_parts_out(spark):
    full, gap, moved = one(
        spark,
        fn.surrogate_key(F.lit("a"), F.lit(2), F.lit(3)),
        fn.surrogate_key(F.lit("a"), F.lit(None).cast("long"), F.lit(3)),
        fn.surrogate_key(F.lit("a"), F.lit(3), F.lit(None).cast("int")),
    )
    assert full == digest("a:2:3")
    assert gap == moved == digest("a:3")


def test_version_key_reads_any_number_as_double(spark):
    whole, floating, missing = one(
        spark,
        fn.version_key(F.lit("S1"), F.lit(218)),
        fn.version_key(F.lit("S1"), F.lit(218.0)),
        fn.version_key(F.lit("S1"), F.lit(None).cast("double")),
    )
    assert whole == floating == digest("S1:218.0")
    assert missing is None


@pytest.mark.parametrize(
    ("millis", "expected"),
    [
        (1_541_105_830_796, dt.datetime(2018, 11, 1, 20, 57, 10)),
        (999, dt.datetime(1970, 1, 1)),
        (-1500, dt.datetime(1969, 12, 31, 23, 59, 59)),
        (None, None),
    ],
)
def test_epoch_millis_lose_their_fraction(spark, millis, expected):
    value = F.lit(millis).cast("long")
    stamp, day = one(
        spark, fn.timestamp_from_epoch_ms(value).cast("timestamp_ntz"), fn.date_from_epoch_ms(value)
    )
    assert stamp == expected
    assert day == (expected.date() if expected else None)


def test_ids_that_are_no_numbers_become_null(spark):
    assert one(spark, fn.as_long(F.lit("abc")), fn.as_long(F.lit("07")), fn.as_integer(F.lit(""))) == (
        None,
        7,
        None,
    )


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("7", 7),
        ("07", 7),
        ("-12", -12),
        ("+3", 3),
        (" 5\t", 5),
        ("\u00007\n", 7),
        ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", None),
        ("7.0", None),
        ("1e3", None),
        ("", None),
        ("abc", None),
        ("1:2", None),
        (None, None),
    ],
)
def test_ids_from_text_equal_a_plain_try_cast(spark, text, expected):
    value = F.lit(text).cast("string")
    assert one(spark, fn.id_from_text(value), value.try_cast("long")) == (expected, expected)


def test_required_accepts_numbers(spark):
    values = [fn.is_required(F.lit(5)), fn.is_required(F.lit("")), fn.is_required(F.lit("x"))]
    assert one(spark, *values) == (True, False, True)
    assert one(spark, fn.is_required(F.lit(None).cast("long")))[0] is False


def test_share_of_nothing_is_zero(spark):
    null = F.lit(None).cast("long")
    assert one(spark, fn.share(F.lit(1), F.lit(4)), fn.share(null, null), fn.share(F.lit(0), F.lit(0))) == (
        0.25,
        0.0,
        0.0,
    )


def test_translate_has_no_else(spark):
    mapping = {"a": "x", "b": "y"}
    assert one(spark, fn.translate(F.lit("b"), mapping), fn.translate(F.lit("c"), mapping)) == ("y", None)
    with pytest.raises(ValueError, match="at least one"):
        fn.translate(F.lit("a"), {})


def test_sentinel(spark):
    assert one(spark, fn.sentinel_to_null(F.lit(0)), fn.sentinel_to_null(F.lit(1999))) == (None, 1999)


def test_seconds_between(spark):
    start, end = F.lit("2024-01-01 00:00:00"), F.lit("2024-01-01 01:00:01.9")
    assert one(spark, fn.seconds_between(start.cast("timestamp_ntz"), end.cast("timestamp"))) == (3601,)


def test_positive_text_and_numbers(spark):
    from siltstone.functions.predicates import is_positive

    found = one(spark, *(is_positive(F.lit(x)) for x in (1.5, -1, "2.5", "n/a", "", None)))
    assert tuple(bool(x) for x in found) == (True, False, True, False, False, False)


def test_dates_come_as_dates(spark):
    """The oracle compares dates as text; their type is checked here."""
    frame = spark.range(1).select(fn.date_from_epoch_ms(F.lit(0).cast("long")).alias("day"))
    assert frame.dtypes == [("day", "date")]


def test_packed_text_comes_back_and_digests_are_half_as_long(spark):
    digest = "0a" * 32
    texts = [digest, digest.upper(), digest[1:], digest[:-1] + "g", "", "v1", "ab", "AB", "né", "\0", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", fn.packed("t"))
    got = df.select("t", fn.unpacked("p"), F.length("p")).collect()
    assert [r[1] for r in got] == texts
    assert got[0][2] == 33 and got[1][2] == 65 and got[-1][2] is None
    assert df.where("p IS NOT NULL").select("p").distinct().count() == len(texts) - 1
