"""Column functions on edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions import forms, messages, text, times


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row.r for row in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def test_clock_text(spark):
    assert column(spark, ["0905", "905", "2400", "2430", "2359", "0000", "05", "", None], times.clock_text) == [
        "09:05:00", "9:05:00", "23:59:00", "23:59:00", "23:59:00", "00:00:00", None, None, None]


def test_scheduled_at(spark):
    got = column(spark, ["0905", "905", "2400", "2575", "xx05", "5", None], lambda c: times.scheduled_at(F.lit("2015-12-31"), c))
    nine = dt.datetime(2015, 12, 31, 9, 5)
    assert got == [nine, nine, dt.datetime(2015, 12, 31, 23, 59), None, None, None, None]
    assert column(spark, ["2015-12-31", "2015-13-31", "soon", None],
                  lambda c: times.scheduled_at(c, F.lit("0905"))) == [nine, None, None, None]


def test_overnight_arrival(spark):
    def arrival(hhmm):
        day = F.lit("2015-12-31")
        return times.next_day_if_before(times.scheduled_at(day, hhmm), times.scheduled_at(day, F.lit("2330")))
    assert column(spark, ["0010", "2330", "2331"], arrival) == [
        dt.datetime(2016, 1, 1, 0, 10), dt.datetime(2015, 12, 31, 23, 30), dt.datetime(2015, 12, 31, 23, 31)]


def test_calendar_parts(spark):
    days = ["2016-12-25", "2016-02-29", "2015-12-31"]
    parsed = [dt.date.fromisoformat(day) for day in days]
    assert column(spark, days, lambda c: times.day_of_year(times.iso_day(c))) == [d.timetuple().tm_yday for d in parsed]
    assert column(spark, days, lambda c: times.day_of_month(times.iso_day(c))) == [d.day for d in parsed]
    assert column(spark, days, lambda c: times.day_of_week(times.iso_day(c))) == [d.isoweekday() for d in parsed]
    assert column(spark, days, lambda c: times.day_of_week(times.iso_day(c), "weekday0")) == [d.weekday() for d in parsed]
    with pytest.raises(ValueError):
        times.day_of_week(F.lit(None), "other")


def test_month_day(spark):
    assert column(spark, [12, None], lambda c: times.month_day(c, F.lit(31)), "int") == ["12-31", None]


def test_day_ranges(spark):
    stamps = ["2016-12-24T23:59:59", "2016-12-25", "2016-12-25T10:00:00.5", "2016-12-26", "2016-12-26T00:00:00"]
    assert column(spark, stamps, lambda c: times.within_day_text(c, "2016-12-25")) == [False, True, True, True, False]
    assert column(spark, stamps, lambda c: times.within_day(c.cast("timestamp"), "2016-12-25")) == [
        False, True, True, False, False]


def test_route_and_labels(spark):
    assert column(spark, ["ATL", None], lambda c: text.route(c, F.lit("SFO"))) == ["ATL-SFO", None]
    assert column(spark, ["0", "1.0", "2", "3.0", "4", "x", None], text.class_label) == [
        *text.DELAY_CLASSES.values(), None, None, None]
    assert column(spark, [0.0, 2.0, 3.0], lambda c: text.class_label(c, text.DELAY_CLASSES_3), "double") == [
        text.DELAY_CLASSES_3[0], text.DELAY_CLASSES_3[2], None]


def test_shorten(spark):
    assert column(spark, ["a" * 14, "a" * 15, "", None], text.shorten) == ["a" * 14, "a" * 14 + "...", "", None]


def test_strip_paging(spark):
    urls = ["/f?a=1", "/f?start=0&end=10", "/f?x?start=0&end=1?start=2&end=3", "?start=0&end=10", "/f?start=&end=1", None]
    assert column(spark, urls, text.strip_paging) == [
        "/f?a=1", "/f", "/f?x?start=0&end=1", "?start=0&end=10", "/f?start=&end=1", None]


def test_matches(spark):
    values = ["Boeing 737-800", "AIRBUS", "", None, "NATION_3", "Élan Vital"]
    assert column(spark, values, lambda c: text.matches(c, "boeing airbus")) == [True, True, False, None, False, False]
    assert column(spark, values, lambda c: text.matches(c, "800")) == [True, False, False, None, False, False]
    assert column(spark, values, lambda c: text.matches(c, "nation")) == [False, False, False, None, False, False]
    assert column(spark, values, lambda c: text.matches(c, "élan")) == [False, False, False, None, False, True]
    assert column(spark, values, lambda c: text.matches(c, "--")) == [False] * 6


@pytest.mark.parametrize("value, number, whole", [
    ("5", 5.0, 5), (" 5.5 ", 5.5, None), ("-3", -3.0, -3), ("1e3", 1000.0, None), (".5", 0.5, None), ("abc", None, None),
    ("5d", None, None), ("", None, None), (None, None, None), ("99999999999", 99999999999.0, None), ("inf", float("inf"), None),
])
def test_coercion(spark, value, number, whole):
    assert column(spark, [value], forms.to_decimal) == [number]
    assert column(spark, [value], forms.to_integer) == [whole]


def test_ids(spark):
    pairs = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", None), (None, "a"), ("a", "bc")], "x string, y string")
    ids = [row.id for row in pairs.select(forms.replayable_id(F.col("x"), F.col("y")).alias("id")).collect()]
    assert len(set(ids)) == 4 and ids[0] == ids[4]
    assert len({row.id for row in pairs.select(forms.random_id().alias("id")).collect()}) == 5


def test_request_time(spark):
    now, given = spark.range(1).select(forms.request_time(), forms.request_time("2016-12-20T18:06:45.307114")).first()
    assert abs(dt.datetime.fromisoformat(now) - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)
    assert given == "2016-12-20T18:06:45.307114"


def test_hash_bucket(spark):
    import hashlib

    keys = ["a", "b", "", "é", None]
    expected = [int(hashlib.md5((k or "").encode()).hexdigest()[:8], 16) % 7 for k in keys]
    assert column(spark, keys, lambda c: forms.hash_bucket(c, 7)) == expected


EXAMPLE = (
    '{"UUID":"8e1c0f6e-9b5d-4a53-8b1e-0c5a3f2d7e10","Timestamp":"2017-03-04T09:10:11.123456","Origin":"HNL","Dest":"OGG",'
    '"Carrier":"HA","FlightNum":"212","FlightDate":"2017-03-05","DepDelay":-7.5,"Distance":100.0,"DayOfYear":64,'
    '"DayOfMonth":5,"DayOfWeek":7}'
)


def test_parse_example(spark):
    got = column(spark, [EXAMPLE], lambda c: messages.parse(c.cast("binary"), schemas.STREAM_MESSAGE))[0]
    assert (got.FlightDate, got.DepDelay, got.DayOfWeek) == (dt.date(2017, 3, 5), -7.5, 7)
    assert got.Timestamp == dt.datetime(2017, 3, 4, 9, 10, 11, 123456)
    assert got.Prediction is None and got.Carrier_index is None


def test_parse_malformed(spark):
    for bad in ("{", "", "[]", "nonsense"):
        got = column(spark, [bad], lambda c: messages.parse(c, schemas.STREAM_MESSAGE))[0]
        assert got is None or all(value is None for value in got)


def test_render_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a", 1), (None, None)], "x string, y int")
    assert [row[0] for row in df.select(messages.render("x", "y")).collect()] == ['{"x":"a","y":1}', "{}"]
