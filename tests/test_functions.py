"""Column expressions, under settings that could bend them."""

from datetime import date, datetime
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from starmart.functions import (
    blank_to_null,
    date_key,
    date_spine,
    day_of_week,
    days_between,
    month_start,
    surrogate_key,
    to_double,
    to_int,
    to_timestamp,
)
from tests.conftest import failing


def _hex(text):
    return md5(text.encode()).hexdigest()


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], _schema(values)) if values else (
        spark.range(1)
    )
    return row.select(column.alias("result")).first()["result"]


def _schema(values):
    kinds = {str: "string", int: "int", datetime: "timestamp_ntz", date: "date", bool: "boolean",
             type(None): "string", float: "double"}
    return ", ".join(f"{name} {kinds[type(value)]}" for name, value in values.items())


def test_key_of_each_type(spark):
    moment = datetime(2018, 1, 2, 3, 4, 5)
    key = surrogate_key("a", "b", "c", "d")
    got = one(spark, key, a="São", b=7, c=moment, d=True)
    assert got == _hex("São||7||2018-01-02 03:04:05||true")


def test_null_key_has_a_token(spark):
    assert one(spark, surrogate_key("a", "b"), a=None, b="x") == _hex("_null_||x")
    assert one(spark, surrogate_key("a"), a="_null_") == one(spark, surrogate_key("a"), a=None)


def test_separator_is_not_escaped(spark):
    left = one(spark, surrogate_key("a", "b"), a="a||b", b="c")
    assert left == one(spark, surrogate_key("a", "b"), a="a", b="b||c")


def test_key_needs_a_field():
    with pytest.raises(ValueError):
        surrogate_key()


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Pacific/Auckland"])
def test_dates_ignore_the_session_zone(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    # Midnight of 4 November 2018 does not exist in Sao Paulo.
    moment = datetime(2018, 11, 4, 0, 30)
    assert one(spark, date_key(F.col("t")), t=moment) == 20181104
    assert one(spark, month_start(F.col("t")), t=moment) == datetime(2018, 11, 1)
    assert one(spark, day_of_week(F.col("t").cast("date")), t=moment) == 0
    assert one(spark, date_key(F.col("t")), t=None) is None


@pytest.mark.parametrize(
    ("start", "end", "days"),
    [
        (datetime(2018, 1, 1, 23), datetime(2018, 1, 2, 1), 1),
        (datetime(2018, 1, 1, 1), datetime(2018, 1, 1, 23), 0),
        (datetime(2018, 1, 2, 1), datetime(2018, 1, 1, 23), -1),
        (datetime(2018, 1, 1), datetime(2018, 3, 1), 59),
    ],
)
def test_days_are_midnights(spark, start, end, days):
    assert one(spark, days_between(F.col("a"), F.col("b")), a=start, b=end) == days


@pytest.mark.parametrize(
    ("first", "last", "days"),
    [
        ("2018-02-27", "2018-03-02", 4),
        ("2018-02-27", "2018-02-27", 1),
        ("2018-02-28", "2018-02-27", 0),
        (None, "2018-02-27", 0),
        (None, None, 0),
    ],
)
def test_spine(spark, first, last, days):
    bounds = spark.createDataFrame([(first, last)], "a string, b string")
    bounds = bounds.select(F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b"))
    spine = date_spine(bounds, "a", "b", "d")
    assert spine.dtypes == [("d", "date")]
    assert spine.count() == days


def text(spark, value):
    return spark.createDataFrame([(value,)], "x string")


def cast(spark, function, value, **options):
    df = text(spark, value)
    return df.select(function(df, "x", **options)).first()["x"]


@pytest.mark.parametrize("ansi", ["true", "false"])
class TestCasts:
    @pytest.fixture(autouse=True)
    def _ansi(self, settings, ansi):
        settings(spark__sql__ansi__enabled=ansi)

    @pytest.mark.parametrize(
        ("given", "wanted"),
        [("01037", 1037), ("-4", -4), ("12.7", 13), ("12.5", 13), ("-12.5", -13), ("1e3", 1000),
         (None, None)],
    )
    def test_int(self, spark, given, wanted):
        assert cast(spark, to_int, given) == wanted

    @pytest.mark.parametrize("given", ["", "ten", "3000000000", "nan"])
    def test_bad_int(self, spark, given):
        with failing(f"column x: cannot read '{given}' as int"):
            cast(spark, to_int, given)

    def test_double(self, spark):
        assert cast(spark, to_double, "19.90") == 19.9
        assert cast(spark, to_double, None) is None
        with failing("cannot read '1,5' as double"):
            cast(spark, to_double, "1,5")

    def test_timestamp(self, spark):
        assert cast(spark, to_timestamp, "2018-01-02 03:04:05") == datetime(2018, 1, 2, 3, 4, 5)
        assert cast(spark, to_timestamp, "2018-01-02") == datetime(2018, 1, 2)
        assert cast(spark, to_timestamp, "") is None
        assert cast(spark, to_timestamp, None) is None
        with failing("cannot read 'soon' as timestamp"):
            cast(spark, to_timestamp, "soon")
        with failing("cannot read '' as timestamp"):
            cast(spark, to_timestamp, "", blank_is_null=False)

    def test_blank(self, spark):
        assert cast(spark, blank_to_null, "") is None
        assert cast(spark, blank_to_null, " ") == " "


def test_typed_columns_pass_through(spark):
    df = spark.createDataFrame([(1, 2.5, datetime(2018, 1, 1))], "i int, d double, t timestamp_ntz")
    kept = df.select(to_int(df, "i"), to_double(df, "d"), to_timestamp(df, "t"))
    assert kept.first() == df.first()
    assert "raise_error" not in kept._jdf.queryExecution().optimizedPlan().toString()
