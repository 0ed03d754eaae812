import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridclimate.functions import coordinates as C
from gridclimate.functions import sqlfuncs
from gridclimate.sources.sites import conform, read_site_csv, sites_from_rows

PARSE = {"dd": C.parse_dd, "ddm": C.parse_ddm, "dms": C.parse_dms, "any": C.parse_any}


def parse(spark, how, text, is_lat):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(PARSE[how]("t", is_lat).alias("v")).first()["v"]


def spelled(value, is_lat, style):
    """A coordinate in one of the three notations, and the exact value of the text."""
    sign, size = value < 0, abs(value)
    letter = ("S" if sign else "N") if is_lat else ("W" if sign else "E")
    deg, minutes = int(size), (size - int(size)) * 60
    if style == "dd":
        return f"{size:.4f}° {letter}", math.copysign(float(f"{size:.4f}"), value)
    if style == "ddm":
        return f"{deg}° {minutes:.2f}' {letter}", math.copysign(deg + float(f"{minutes:.2f}") / 60, value)
    seconds = (minutes - int(minutes)) * 60
    return f"{deg}°{int(minutes)}'{seconds:.1f}\" {letter}", math.copysign(deg + int(minutes) / 60 + float(f"{seconds:.1f}") / 3600, value)


@pytest.mark.parametrize("is_lat", [True, False])
def test_parse(spark, is_lat):
    """Generated spellings, by their own notation and by detection."""
    values = np.random.default_rng(41).uniform(-89 if is_lat else -179, 89 if is_lat else 179, 25)
    for style in ("dd", "ddm", "dms"):
        texts = [spelled(v, is_lat, style) for v in values]
        df = spark.createDataFrame([(t,) for t, _ in texts], "t string")
        for how in (style, "any"):
            got = [r["v"] for r in df.select("t", PARSE[how]("t", is_lat).alias("v")).collect()]
            assert got == pytest.approx([x for _, x in texts], abs=1e-6)


@pytest.mark.parametrize("how, text, is_lat, expected", [
    ("dd", "-71.0625", False, -71.0625),  # sign in place of a letter
    ("any", "-8.5 S", True, -8.5),  # sign and letter agree
    ("dms", "-3°45'0\" E", False, 3.75),  # they do not: the letter decides
    ("ddm", "5° 90.0' N", True, 6.5),  # minutes past sixty count on
    ("any", "-12° 15.0'", True, -12.25),  # minutes with a sign alone
    ("any", "17˚ 6.0′ s", True, -17.1),  # look-alike marks, small letter
])
def test_parse_quirks(spark, how, text, is_lat, expected):
    assert parse(spark, how, text, is_lat) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("how, text, is_lat", [
    ("dms", "7 20 15 N", True), ("ddm", "61° N", True), ("dd", "4.25 N E", True), ("any", "north of town", True), ("any", "8.75° W", True),
    ("any", "8.75° S", False), ("any", "dd|1|0|0|S", True), ("any", "", True), ("any", "7.25° 10' N", True), ("any", None, True)])
def test_parse_refuses(spark, how, text, is_lat):
    assert parse(spark, how, text, is_lat) is None


def test_clean(spark):
    """Every look-alike mark becomes the plain one, and blanks shrink."""
    for ring in "º˚":
        for tick in "’′":
            df = spark.createDataFrame([(f" 7{ring}  8{tick}\t9{tick}{tick} N ",), (f"7{ring} 8{tick} 9” N",), (f"7{ring} 8{tick} 9″ N",)], "t string")
            assert {r["v"] for r in df.select(C.clean_text("t").alias("v")).collect()} == {"7° 8' 9\" N"}


def test_standardise(spark):
    rows = [(1, "12°45'0\" S", "70°9'36\" W"), (2, "-12.75", "-70.16"), (3, "12.75 S", "-70.16"),
            (4, "90.1", "0"), (5, "0", "-180.1"), (6, "90", "180"), (7, "nope", "1"),
            (8, "-6°18'36\" N", "10"), (9, "1e1", "2"), (10, "1e1", "2 E"), (11, "1.5d", "2")]
    df = spark.createDataFrame(rows, "id int, lat string, lon string")
    out = {r["id"]: r for r in C.standardise_sites(df).collect()}
    for i in (1, 2, 3):
        assert (out[i]["lat"], out[i]["lon"]) == (pytest.approx(-12.75), pytest.approx(-70.16))
    assert out[4]["coord_error"] == "latitude outside [-90, 90]" and out[4]["lat"] is None
    assert out[5]["coord_error"] == "longitude outside [-180, 180]"
    assert out[6]["coord_error"] is None and out[6]["coord_format"] == "number"
    assert out[7]["coord_error"] == "cannot read latitude"
    assert out[8]["coord_warning"] and out[8]["lat"] == pytest.approx(6.31, abs=1e-6)
    assert out[9]["lat"] == 10.0
    assert out[10]["coord_error"] and out[11]["coord_error"]
    good, bad = C.split_sites(C.standardise_sites(df))
    assert good.count() + bad.count() == len(rows) and bad.count() == 5


def test_numeric_columns(spark):
    df = spark.createDataFrame([(-23.55, -46.63), (91.0, 0.0)], "lat double, lon double")
    rows = C.standardise_sites(df).collect()
    assert (rows[0]["lat"], rows[0]["lon"]) == (-23.55, -46.63) and rows[1]["coord_error"]


def test_format(spark):
    df = spark.createDataFrame([(-23.55, -46.633333)], "lat double, lon double")
    row = df.select(
        C.format_dd("lat", True), C.format_dd("lon", False), C.format_dd("lat", True, 2), C.format_ddm("lat", True),
        C.format_ddm("lon", False), C.format_dms("lat", True), C.format_dms("lon", False), C.format_dms("lon", False, 2)).first()
    assert list(row) == ["23.55000° S", "46.63333° W", "23.55° S", "23°33.000' S", "46°38.000' W",
                         "23°33'0\" S", "46°37'60\" W", "46°37'60.00\" W"]
    parts = df.select(C.dms_components("lon", False).alias("d"), C.ddm_components("lat", True).alias("m")).first()
    assert (parts["d"]["degrees"], parts["d"]["minutes"], parts["d"]["hemisphere"]) == (46, 37, "W")
    assert parts["d"]["seconds"] == pytest.approx(59.9988, abs=1e-4)
    assert parts["m"]["minutes"] == pytest.approx(33.0)


def test_round_trip(spark):
    values = [(-23.55,), (0.0,), (89.999,), (-0.25,), (45.123456,)]
    df = spark.createDataFrame(values, "v double")
    text = df.select("v", C.format_dd("v", True, 8).alias("a"), C.format_ddm("v", True, 6).alias("b"),
                     C.format_dms("v", True, 4).alias("c"))
    for row in text.select("v", *[C.parse_any(c, True).alias(c) for c in "abc"]).collect():
        for c in "abc":
            assert row[c] == pytest.approx(row["v"], abs=1e-6)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-90, 90, allow_nan=False), min_size=1, max_size=20))
def test_format_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", C.format_dd("v", True).alias("t")).collect():
        assert row["t"] == f"{abs(row['v']):.5f}° {'N' if row['v'] >= 0 else 'S'}"


def test_sql_functions(spark):
    names = sqlfuncs.register(spark)
    assert "gc_parse_coord" in names
    row = spark.sql("""select gc_parse_coord('23°33.0\\' S', true) a, gc_parse_dd('1.5 W', false) b,
        gc_format_dms(-23.55, true) c, gc_cell_lat(90, 'ALLSKY_SFC_SW_DWN') d, gc_cell_lon(180, 'T2M') e,
        gc_gdd(12.5, 10) f, gc_gdd(null, 10) g, gc_parse_dms('x', true) h, gc_clean_coord(' 1º ') i""").first()
    assert list(row) == [pytest.approx(-23.55), -1.5, "23°33'0\" S", 179, 0, 2.5, None, None, "1°"]


def test_site_sources(spark, tmp_path):
    path = tmp_path / "sites.csv"
    path.write_text("lat,lon,name,elevation\n-23.31,-51.16,Londrina,585\n15°47'S,47.93 W,,\n")
    rows = read_site_csv(spark, str(path)).orderBy("site_id").collect()
    assert rows[0]["name"] == "Londrina" and rows[0]["elevation"] == 585.0 and rows[0]["wind_surface"] is None
    assert rows[1]["lat"] == "15°47'S"
    bad = tmp_path / "bad.csv"
    bad.write_text("latitude,lon\n1,2\n")
    with pytest.raises(ValueError, match="lat"):
        read_site_csv(spark, str(bad))
    mixed = sites_from_rows(spark, [{"lat": 1, "lon": 2, "name": "a", "wind_elevation": 50}, (3.0, 4.0), (5.0, 6.0, 7)])
    got = [(r["site_id"], r["lat"], r["lon"], r["name"], r["elevation"], r["wind_elevation"]) for r in mixed.collect()]
    assert got == [(0, "1", "2", "a", None, 50.0), (1, "3.0", "4.0", None, None, None), (2, "5.0", "6.0", None, 7.0, None)]
    with pytest.raises(ValueError):
        sites_from_rows(spark, [{"lat": 1}])
    assert conform(spark.createDataFrame([(1.0, 2.0)], "lat double, lon double")).count() == 1


def test_text_ids_stay_and_odd_numbers_are_named(spark, tmp_path):
    path = tmp_path / "sites.csv"
    path.write_text("site_id,lat,lon,elevation,wind_elevation\nfarm_A,1,2,high,50\n007,3,4,12.5,\n,5,6,,x\n")
    rows = [(r["site_id"], r["elevation"], r["wind_elevation"], r["site_warning"]) for r in read_site_csv(spark, str(path)).orderBy("lat").collect()]
    assert rows == [("farm_A", None, 50.0, "unreadable elevation"), ("007", 12.5, None, None), (None, None, None, "unreadable wind_elevation")]


def test_round_half_even(spark):
    from gridclimate.functions.text import format_bytes, round_half_even
    values = [1.00375, 2.67495, -0.00001, 12.34565, 0.00005, -7.12345]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", round_half_even(F.col("v"), 4).alias("r")).collect():
        assert row["r"] == round(np.float64(row["v"]), 4) and math.copysign(1, row["r"]) == (1 if row["r"] >= 0 else -1)
    sizes = [(0, "0.00 B"), (1023, "1023.00 B"), (1536, "1.50 KiB"), (5 * 1024**2, "5.00 MiB"),
             (3 * 1024**3, "3.00 GiB"), (7 * 1024**4, "7.00 TiB"), (2000 * 1024**4, "2000.00 TiB")]
    df = spark.createDataFrame(sizes, "n long, t string")
    assert all(r["t"] == r["s"] for r in df.select("t", format_bytes(F.col("n")).alias("s")).collect())
