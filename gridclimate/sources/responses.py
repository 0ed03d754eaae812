"""Landed JSON answers: read, split good from bad, flatten to observations, export.

A response table has `response_id`, `body` and, if known, `http_status`; other
columns ride along. Parsing is one `from_json` per body and two map explodes,
so the work is spread by response and nothing is grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclimate.functions.dates import date_key, date_key_timestamp
from gridclimate.functions.grid import with_cell

# --- Fixed values: wire format ------------------------------------------------------
FILL_CODE = -999.0
REJECTED_STATUS = [400, 422]
# --- end of fixed values --------------------------------------------------------------

SERIES = "parameter: MAP<STRING, MAP<STRING, STRING>>"
POINT_JSON = (f"properties STRUCT<{SERIES}>, geometry STRUCT<coordinates: ARRAY<DOUBLE>>,"
              " error STRING, messages STRING, _bad STRING")
REGION_JSON = ("features ARRAY<STRUCT<geometry: STRUCT<coordinates: ARRAY<DOUBLE>>,"
               f" properties: STRUCT<{SERIES}>>>, error STRING, messages STRING, _bad STRING")
JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowNonNumericNumbers": "true"}


def read_responses(spark: SparkSession, path: str, layout: str = "file") -> DataFrame:
    """Landed bodies: one JSON document per file, or one per line (`layout='lines'`), each with an id of its own."""
    if layout not in ("file", "lines"):
        raise ValueError("layout must be 'file' or 'lines'")
    text = spark.read.text(path, wholetext=layout == "file")
    name = F.col("_metadata.file_path")
    if layout == "lines":  # a line is named by its content, which a replay does not change
        name = F.concat(name, F.lit("#"), F.hex(F.xxhash64("value")))
    return text.select(name.alias("response_id"), F.col("value").alias("body"))


def clean_value(raw: Column) -> Column:
    """Wire text to a number: unreadable text, NaN and the fill code become NULL."""
    number = raw.try_cast("double")
    return F.when(~F.isnan(number) & (number != FILL_CODE), number)


def fill_to_null(value: Column) -> Column:
    """Exact fill code to NULL."""
    return F.nullif(value, F.lit(FILL_CODE))


def _parsed(df: DataFrame, schema: str) -> DataFrame:
    """Add `_doc` and, if absent, `http_status`.

    The parse sits behind `inline`, which filters are not pushed through;
    otherwise the optimizer copies it into every condition on the document.
    """
    doc = F.inline(F.array(F.struct(F.from_json("body", schema, JSON_OPTIONS).alias("_doc"))))
    parsed = df.select("*", doc)
    return parsed if "http_status" in df.columns else parsed.withColumn("http_status", F.lit(None).cast("int"))


def _failure_reason(kind: str = "point") -> Column:
    """NULL for a usable body, else why it is not. Messages without data are a refusal, whatever the status."""
    status = F.col("http_status")
    status_text = F.concat(F.lit("HTTP "), status.cast("string"))
    listed = F.from_json("_doc.messages", "ARRAY<STRING>")
    messages = F.coalesce(F.array_join(listed, "; "), F.col("_doc.messages"))
    return (F.when(status.isin(REJECTED_STATUS) & messages.isNotNull(), F.concat(status_text, F.lit(": "), messages))
            .when(status >= 400, status_text)
            .when(F.col("_doc._bad").isNotNull() | F.col("_doc").isNull(), F.lit("not JSON"))
            .when(F.col("_doc.error").isNotNull(), F.col("_doc.error"))
            .when(F.col("_doc.properties" if kind == "point" else "_doc.features").isNull() & messages.isNotNull(), messages))


def _place_reason(spot: Column) -> Column:
    """NULL for a `[lon, lat]` pair on the globe, else what is wrong with it."""
    lat, lon = F.get(spot, F.lit(1)), F.get(spot, F.lit(0))
    on_globe = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    return (F.when(lat.isNull() | lon.isNull(), F.lit("no coordinates"))
            .when(~F.coalesce(on_globe, F.lit(False)), F.lit("coordinates out of range")))


def response_errors(df: DataFrame, kind: str = "point", place: bool = False) -> DataFrame:
    """Responses that hold no data, with a `reason`.

    With `place`, a point body without coordinates on the globe is an error too.
    """
    parsed = _parsed(df, POINT_JSON if kind == "point" else REGION_JSON)
    reason = _failure_reason(kind)
    if place:
        reason = F.coalesce(reason, _place_reason(F.col("_doc.geometry.coordinates")))
    return parsed.withColumn("reason", reason).where("reason is not null").drop("_doc", "body")


def quarantine(df: DataFrame, place: bool = False) -> DataFrame:
    """Everything point ingest leaves out: `response_id, param, date_key, reason`."""
    whole = response_errors(df, place=place).select("response_id", "reason")
    keys = bad_date_keys(df, place).select("response_id", "param", "date_key", "reason")
    return keys.unionByName(whole, allowMissingColumns=True)


def _date_columns(key: Column) -> dict[str, Column]:
    return {
        "temporal": F.when(F.length(key) == 8, F.lit("daily")).when(F.length(key) == 10, F.lit("hourly")),
        "obs_ts": date_key_timestamp(key),
    }


def point_values(df: DataFrame, place: bool = False) -> DataFrame:
    """Every value of every point response, bad date keys included.

    Adds `param, date_key, temporal, obs_ts, value`; `obs_ts` is NULL for a bad key.
    `place` also adds `lat` and `lon` from the body and leaves out bodies without them.
    """
    keep = [c for c in df.columns if c not in ("body", "http_status")]
    good = _parsed(df, POINT_JSON).where(_failure_reason().isNull())
    if place:
        spot = F.col("_doc.geometry.coordinates")
        good = good.where(_place_reason(spot).isNull()).withColumns({"lat": spot[1], "lon": spot[0]})
        keep += ["lat", "lon"]
    series = good.select(*keep, F.explode("_doc.properties.parameter").alias("param", "_series"))
    return (series.select(*keep, "param", F.explode("_series").alias("date_key", "_raw"))
            .withColumns(_date_columns(F.col("date_key")))
            .withColumn("value", clean_value(F.col("_raw"))).drop("_raw"))


def ingest_point(df: DataFrame, place: bool = False) -> DataFrame:
    """Long observations: carried columns, `param, temporal, obs_ts, value`."""
    return point_values(df, place).where("obs_ts is not null").drop("date_key")


def bad_date_keys(df: DataFrame, place: bool = False) -> DataFrame:
    """Values whose date key is neither `YYYYMMDD` nor `YYYYMMDDHH`, or is no real date.

    With `place`, of bodies that have a usable place: the others are listed whole.
    """
    return (point_values(df, place).where("obs_ts is null")
            .withColumn("reason", F.when(F.col("temporal").isNull(), F.lit("unrecognised date key"))
                        .otherwise(F.lit("unreadable date key")))
            .drop("obs_ts"))


def point_outcomes(df: DataFrame, place: bool = False) -> DataFrame:
    """Every value of every point response and every body without any, from one parse.

    Carries the other columns and adds `param, date_key, temporal, obs_ts, value` (with `place`
    also `lat, lon`) and `reason`, which is NULL for a row to keep. Where `df` has a
    `resolution`, as a request manifest does, keys of the other one are refused.
    """
    keep = [c for c in df.columns if c not in ("body", "http_status", "resolution")]
    spot = F.col("_doc.geometry.coordinates")
    reason = F.coalesce(_failure_reason(), _place_reason(spot)) if place else _failure_reason()
    asked = F.col("resolution") if "resolution" in df.columns else F.lit(None).cast("string")
    judged = _parsed(df, POINT_JSON).withColumns({"reason": reason, "_asked": asked})
    if place:
        judged = judged.withColumns({"lat": F.get(spot, F.lit(1)), "lon": F.get(spot, F.lit(0))})
        keep += ["lat", "lon"]
    keep += ["reason", "_asked"]
    series = judged.select(*keep, F.explode_outer(F.when(F.col("reason").isNull(), F.col("_doc.properties.parameter"))).alias("param", "_series"))
    values = series.select(*keep, "param", F.explode_outer("_series").alias("date_key", "_raw")).where("reason is not null or date_key is not null")
    dated = values.withColumns({**_date_columns(F.col("date_key")), "value": clean_value(F.col("_raw"))})
    other = F.col("_asked").isNotNull() & (F.col("_asked") != F.col("temporal"))
    wrong = (F.when(F.col("temporal").isNull(), F.lit("unrecognised date key")).when(F.col("obs_ts").isNull(), F.lit("unreadable date key"))
             .when(other, F.lit("date key of another resolution")))
    return dated.withColumn("reason", F.coalesce("reason", F.when(F.col("date_key").isNotNull(), wrong))).drop("_raw", "_asked")


def _features(df: DataFrame) -> tuple[DataFrame, list[str]]:
    keep = [c for c in df.columns if c not in ("body", "http_status")]
    good = _parsed(df, REGION_JSON).where(_failure_reason("region").isNull())
    return good.select(*keep, F.explode("_doc.features").alias("_f")), keep


def _region_values(df: DataFrame) -> DataFrame:
    """Every value of every placed feature; `obs_ts` is NULL for a key that is no daily date."""
    feature, keep = _features(df)
    place = F.col("_f.geometry.coordinates")
    series = (feature.where(_place_reason(place).isNull())
              .select(*keep, place[1].alias("lat"), place[0].alias("lon"),
                      F.get(place, F.lit(2)).alias("elevation"),
                      F.explode("_f.properties.parameter").alias("param", "_series")))
    return (series.select(*keep, "lat", "lon", "elevation", "param", F.explode("_series").alias("date_key", "_raw"))
            .withColumns({"obs_ts": F.when(F.length("date_key") == 8, date_key_timestamp(F.col("date_key"))),
                          "value": clean_value(F.col("_raw"))}).drop("_raw"))


def ingest_region(df: DataFrame) -> DataFrame:
    """Long observations of regional answers: `lat, lon, elevation, param, obs_ts, value`.

    Only daily keys exist here. What is left out is listed by `region_quarantine`.
    """
    return _region_values(df).where("obs_ts is not null").drop("date_key")


def region_quarantine(df: DataFrame) -> DataFrame:
    """Everything regional ingest leaves out: `response_id, param, date_key, reason`."""
    whole = response_errors(df, "region").select("response_id", "reason")
    feature, _ = _features(df)
    reason = _place_reason(F.col("_f.geometry.coordinates"))
    places = feature.select("response_id", reason.alias("reason")).where("reason is not null")
    keys = _region_values(df).where("obs_ts is null").select(
        "response_id", "param", "date_key", F.lit("no daily date key").alias("reason"))
    return keys.unionByName(places.unionByName(whole), allowMissingColumns=True)


def region_store_rows(df: DataFrame) -> DataFrame:
    """Regional answers as store rows under the base variant, for `ObservationStore.append(order='response_id')`."""
    placed = with_cell(ingest_region(df))
    return placed.select(F.lit("daily").alias("temporal"), "param", "cell_lat", "cell_lon", F.lit("base").alias("variant"),
                         "obs_ts", "value", "response_id")


def export_responses(obs: DataFrame, keys: list[str], temporal: str = "daily") -> DataFrame:
    """Observations back to wire documents: `keys..., year, body`.

    NULL is written as the fill code. One document holds one key and one year,
    so a document is at most 8,784 stamps per parameter however long the history.
    Rows must be unique per key, parameter and stamp.
    """
    stamp = date_key(F.col("obs_ts"), temporal == "hourly")
    wire = F.struct(stamp.alias("k"), F.coalesce("value", F.lit(FILL_CODE)).alias("v"))
    group = [*keys, "year"]
    # Partitioning on the document key once serves both groupings.
    series = (obs.withColumn("year", F.year("obs_ts")).repartition(*group)
              .groupBy(*group, "param").agg(F.map_from_entries(F.array_sort(F.collect_list(wire))).alias("_s")))
    return (series.groupBy(*group)
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("param", F.to_json("_s").alias("j"))))).alias("_p"))
            .select(*group, F.concat(
                F.lit('{"properties":{"parameter":{'),
                F.array_join(F.transform(F.map_entries("_p"),
                                         lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ","),
                F.lit("}}}")).alias("body")))
