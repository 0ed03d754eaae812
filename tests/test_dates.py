import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridclimate.functions.dates import calendar, ensure_date_column, iso_bound, parse_dates

D = dt.datetime


@pytest.mark.parametrize("text, value, error", [
    ("05/03/2023", None, "ambiguous date"), ("31/01/2023", None, "ambiguous date"),
    (" 1/1/23 ", None, "ambiguous date"), ("2023-03-05", D(2023, 3, 5), None), ("20230305", D(2023, 3, 5), None),
    ("2023-05-15 08:30:00", D(2023, 5, 15, 8, 30), None), ("2023-05-15T08:30:00+02:00", D(2023, 5, 15, 6, 30), None),
    ("20231399", None, "unreadable date"), ("soon", None, "unreadable date"),
])
def test_parse_dates(spark, text, value, error):
    row = parse_dates(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert (row["date"], row["date_error"]) == (value, error)


def test_ensure_date(spark):
    df = spark.createDataFrame([("2023-05-15 08:30:00", 1.0), ("20230516", 2.0), (None, 3.0)], "obs_date string, v double")
    out = ensure_date_column(df, candidates=["missing", "obs_date"])
    assert out.columns == ["v", "date"] and [r["date"] for r in out.orderBy("v").collect()] == [
        D(2023, 5, 15, 8, 30), D(2023, 5, 16), None]
    flat = ensure_date_column(df.withColumnRenamed("obs_date", "date"), normalize=True)
    assert flat.columns == ["date", "v"] and flat.orderBy("v").first()["date"] == D(2023, 5, 15)
    with pytest.raises(ValueError, match="no date column"):
        ensure_date_column(df)
    bad = spark.createDataFrame([("soon",)], "date string")
    with pytest.raises(Exception, match="unreadable date"):
        ensure_date_column(bad).collect()


def test_zoned_column(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        df = spark.sql("select timestamp'2023-01-01 00:00:00+02:00' as date")
        out = ensure_date_column(df)
        assert dict(out.dtypes)["date"] == "timestamp_ntz" and out.first()["date"] == D(2022, 12, 31, 22)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_calendar(spark):
    df = spark.createDataFrame([(D(2023, 1, 1), D(2023, 1, 2))], "s timestamp_ntz, e timestamp_ntz")
    assert calendar(df, "s", "e").count() == 2
    assert calendar(df, "s", "e", "hourly").agg(F.count("*")).first()[0] == 25


def test_window_bounds():
    assert iso_bound("20230105") == iso_bound(dt.date(2023, 1, 5)) == iso_bound(" 2023-01-05 ") == "2023-01-05"
    assert iso_bound(D(2023, 1, 5, 3)) == "2023-01-05 03:00:00"
    for bad in ("05/01/2023", "soon", "20231399"):
        with pytest.raises(ValueError):
            iso_bound(bad)
