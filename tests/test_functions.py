import datetime as dt

from pyspark.sql import functions as F

from arspark.functions import dates as D
from arspark.functions import scalars as S


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0]["x"]


def test_month_boundaries(spark):
    # Jan 31 -> Feb 1 crosses one month boundary (whole months elapsed would be 0)
    assert one(spark, D.months_between_boundaries(F.lit(dt.date(2024, 1, 31)), F.lit(dt.date(2024, 2, 1)))) == 1
    assert one(spark, D.months_between_boundaries(F.lit(dt.date(2024, 2, 1)), F.lit(dt.date(2024, 2, 29)))) == 0
    assert one(spark, D.months_between_boundaries(F.lit(dt.date(2023, 12, 15)), F.lit(dt.date(2024, 1, 1)))) == 1


def test_hour_minute_boundaries(spark):
    a = F.lit(dt.datetime(2024, 1, 1, 0, 59, 59)).cast("timestamp_ntz")
    b = F.lit(dt.datetime(2024, 1, 1, 1, 0, 0)).cast("timestamp_ntz")
    assert one(spark, D.hours_between(a, b)) == 1
    assert one(spark, D.minutes_between(a, b)) == 1


def test_day_diff_month_start_end_dow(spark):
    assert one(spark, D.days_between(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 3, 1)))) == 60
    assert one(spark, D.month_start(F.lit(dt.date(2024, 3, 15)))) == dt.date(2024, 3, 1)
    assert one(spark, D.month_end(F.lit(dt.date(2024, 2, 10)))) == dt.date(2024, 2, 29)
    assert one(spark, D.day_of_week0(F.lit(dt.date(2024, 3, 3)))) == 0  # Sunday


def test_zero_dates_and_bad_text_become_null(spark):
    for s in ["0000-00-00 00:00:00", "0000-00-00", "", "not a date", "2024-13-45"]:
        assert one(spark, D.clean_ts(F.lit(s))) is None
        assert one(spark, D.clean_date(F.lit(s))) is None
    assert one(spark, D.clean_date(F.lit("2024-02-03 10:11:12"))) == dt.date(2024, 2, 3)
    assert one(spark, D.clean_ts(F.lit("2024-02-03T10:11:12"))) == dt.datetime(2024, 2, 3, 10, 11, 12)
    assert one(spark, D.clean_time_of_day(F.lit("2024-02-03 07:08:09"))) == "07:08:09"
    assert one(spark, D.clean_time_of_day(F.lit(""))) is None


def test_guarded_division(spark):
    assert one(spark, S.safe_div(F.lit(1), F.lit(0))) is None
    assert one(spark, S.div_or_zero(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, S.pct(F.lit(1), F.lit(4))) == 25.0
    assert one(spark, S.pct(F.lit(1), F.lit(None).cast("int"))) == 0.0


def test_buckets(spark):
    got = [one(spark, S.age_bucket(F.lit(x))) for x in (0, 30, 31, 61, 91, 121)]
    assert got == ["0-30 Days", "0-30 Days", "31-60 Days", "61-90 Days", "91-120 Days", "120+ Days"]
    assert [one(spark, S.age_bucket_sort(F.lit(x))) for x in (5, 45, 200)] == [1, 2, 5]
    four = S.age_bucket(F.lit(100), S.AGE_BUCKETS_4, S.AGE_BUCKET_4_LAST)
    assert one(spark, four) == "Over 90 Days"


def test_contact_flags(spark):
    assert one(spark, S.bad_phone(F.lit("(206) 555-0101"))) == 0
    assert one(spark, S.bad_phone(F.lit("555-0101"))) == 1
    assert one(spark, S.bad_phone(F.lit(None).cast("string"))) == 1
    assert one(spark, S.bad_email(F.lit("a@b.com"))) == 0
    assert one(spark, S.bad_email(F.lit("ab.com"))) == 1
