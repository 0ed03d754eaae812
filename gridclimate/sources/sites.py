"""Site lists from CSV files or Python rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SITE_SCHEMA = T.StructType([
    T.StructField("site_id", T.LongType()),
    T.StructField("lat", T.StringType()),
    T.StructField("lon", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("wind_elevation", T.DoubleType()),
    T.StructField("wind_surface", T.StringType()),
])


def conform(df: DataFrame) -> DataFrame:
    """Cast to the site schema, adding absent optional columns as NULL.

    Ids keep the type they came with, so text ids stay text; rows without the column are numbered.
    A number that cannot be read becomes NULL and is named in `site_warning`.
    """
    missing = [c for c in ("lat", "lon") if c not in df.columns]
    if missing:
        raise ValueError(f"site list lacks column(s): {', '.join(missing)}")
    base = df if "site_id" in df.columns else df.withColumn("site_id", F.monotonically_increasing_id())
    columns, odd = [F.col("site_id")], []
    for field in SITE_SCHEMA.fields[1:]:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        read = F.col(field.name).try_cast(field.dataType)
        columns.append(read.alias(field.name))
        if isinstance(field.dataType, T.DoubleType):
            given = F.coalesce(F.trim(F.col(field.name).cast("string")), F.lit("")) != ""
            odd.append(F.when(given & read.isNull(), F.lit(f"unreadable {field.name}")))
    warning = F.concat_ws("; ", *odd) if odd else F.lit("")
    return base.select(*columns, F.nullif(warning, F.lit("")).alias("site_warning"))


def read_site_csv(spark: SparkSession, path: str) -> DataFrame:
    """Site list with a header row; `lat` and `lon` are required, as text or numbers."""
    # Every column is read as text, so no inference pass over the files is needed.
    return conform(spark.read.option("header", True).option("inferSchema", False).csv(path))


def sites_from_rows(spark: SparkSession, rows: Iterable[dict | tuple]) -> DataFrame:
    """Site list from dicts or `(lat, lon[, elevation])` tuples; site_id is the position."""
    names = [f.name for f in SITE_SCHEMA][1:]
    data = []
    for i, row in enumerate(rows):
        if not isinstance(row, dict):
            row = dict(zip(("lat", "lon", "elevation"), row))
        if "lat" not in row or "lon" not in row:
            raise ValueError(f"site {i} lacks lat or lon")
        values = {n: row.get(n) for n in names}
        for n in ("lat", "lon", "name", "wind_surface"):
            values[n] = None if values[n] is None else str(values[n])
        for n in ("elevation", "wind_elevation"):
            values[n] = None if values[n] is None else float(values[n])
        data.append((i, *values.values()))
    return spark.createDataFrame(data, SITE_SCHEMA)
