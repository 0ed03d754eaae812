"""Inputs derived from the driver's tables.

`SQL` holds views whose text runs in Spark and DuckDB alike; `{name}` marks a
table or another view. They only shape input, the operators work on top.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclimate.functions.grid import variant_of, with_cell
from gridclimate.operators.merge import keep_first
from gridclimate.sources.catalog import catalog_rows
from gridclimate.sources.responses import fill_to_null

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SQL = {
    "v_points": """
        select c_custkey as site_id,
               cast((c_custkey * 7919) % 17801 - 8900 as double) / 100 as lat,
               cast((c_custkey * 10473) % 35901 - 17950 as double) / 100 as lon,
               c_name as name,
               case when c_custkey % 5 = 0 then null else c_acctbal end as elevation
        from {customer}""",
    "v_obs_raw": """
        select user_id as site_id,
               case event_type when 'view' then 'T2M' when 'click' then 'RH2M'
                    when 'purchase' then 'PRECTOTCORR' when 'signup' then 'WS10M'
                    else 'ALLSKY_SFC_SW_DWN' end as param,
               cast(ts as date) as obs_date, ts, event_id as seq,
               case when event_id % 13 = 0 then cast(-999 as double) else value end as raw_value
        from {events}""",
    "v_requests": """
        select o_orderkey as request_id, o_custkey as site_id, cast(o_orderdate as date) as order_date,
               date '2023-12-20' + cast(o_orderkey % 45 as int) as start_date,
               date '2023-12-20' + cast(o_orderkey % 45 + o_orderkey % 17 - 1 as int) as end_date,
               case when o_orderkey % 4 = 0 then 'hourly' else 'daily' end as temporal,
               case o_orderkey % 6 when 0 then 'T2M' when 1 then 'T2M,RH2M' when 2 then 'GWETTOP,T2M'
                    when 3 then 'FOO,T2M' when 4 then '' else 'ALLSKY_SFC_SW_DWN,T2M' end as params_csv,
               case o_orderkey % 7 when 0 then cast(5 as double) when 1 then cast(50 as double) else null end as wind_elevation,
               case o_orderkey % 10 when 0 then 'HTTP 500' when 1 then 'HTTP 422' else 'ok' end as fetch_status
        from {orders}""",
    "v_coord_text": """
        select k as site_id, style,
               case style
                 when 0 then deg || '.25' || chr(176) || ' ' || hem
                 when 1 then '-' || deg || '.5'
                 when 2 then deg || chr(176) || mi || '.5' || chr(39) || ' ' || hem
                 when 3 then deg || chr(176) || ' ' || mi || chr(39) || ' ' || sec || chr(34) || ' ' || hem
                 when 4 then '  ' || deg || 'º ' || mi || '’  ' || sec || '” ' || hem
                 when 5 then deg || chr(176) || mi || chr(39) || sec || chr(39) || chr(39) || lower(hem)
                 when 6 then '-' || deg || chr(176) || mi || chr(39) || sec || chr(34) || hem
                 else 'not a coordinate' end as lat_text,
               cast(k % 180 as string) || '.5' as lon_text,
               cast(k % 180 as double) + 0.5e0 as lon_expected,
               case style when 0 then sgn * (deg_n + 0.25e0) when 1 then -(deg_n + 0.5e0)
                 when 2 then sgn * (deg_n + (mi_n + 0.5e0) / 60e0) when 7 then null
                 else sgn * (deg_n + mi_n / 60e0 + sec_n / 3600e0) end as lat_expected
        from (select c_custkey as k, c_custkey % 8 as style,
                     cast(c_custkey % 89 as string) as deg, cast(c_custkey * 7 % 60 as string) as mi,
                     cast(c_custkey * 11 % 60 as string) as sec,
                     cast(c_custkey % 89 as double) as deg_n, cast(c_custkey * 7 % 60 as double) as mi_n,
                     cast(c_custkey * 11 % 60 as double) as sec_n,
                     case when c_custkey % 3 = 0 then 'S' else 'N' end as hem,
                     case when c_custkey % 3 = 0 then cast(-1 as double) else cast(1 as double) end as sgn
              from {customer}) t""",
    "v_regions": """
        select site_id as region_id,
               case when site_id % 2 = 0 then 'T2M' else 'ALLSKY_SFC_SW_DWN' end as param,
               lat_min,
               lat_min + case site_id % 6 when 0 then cast(-1 as double) when 1 then cast(5 as double)
                              else cast(3.5 as double) end as lat_max,
               lon_min,
               lon_min + case site_id % 5 when 0 then cast(6 as double) else cast(4 as double) end as lon_max
        from (select site_id, lat - 1.75e0 as lat_min, lon - 2e0 as lon_min from {v_points}) t""",
    "v_transects": """
        select s_suppkey as transect_id, a.lat as lat1, a.lon as lon1, b.lat as lat2, b.lon as lon2,
               case when s_suppkey % 2 = 0 then cast(5 + s_suppkey % 20 as int) end as num_points,
               case when s_suppkey % 2 = 1 then cast(50 * (1 + s_suppkey % 7) as double) end as spacing_km,
               case when s_suppkey % 3 = 0 then 'ALLSKY_SFC_SW_DWN' else 'T2M,RH2M' end as params_csv
        from {supplier} join {v_points} a on a.site_id = s_suppkey join {v_points} b on b.site_id = s_suppkey + 1""",
}

# Twin-only views: the same facts as the DataFrame builders below, written as SQL.
TWIN_SQL = {
    **SQL,
    "v_obs": """
        select site_id, param, obs_date, seq, nullif(raw_value, cast(-999 as double)) as value
        from (select *, row_number() over (partition by site_id, param, obs_date order by seq) as rn
              from {v_obs_raw}) t where rn = 1""",
    "v_held": """
        select * from {v_obs} where obs_date between date '2024-01-05' and date '2024-01-20'""",
    "v_hourly": """
        select site_id, param, hr, nullif(raw_value, cast(-999 as double)) as value
        from (select *, date_trunc('hour', ts) as hr, row_number() over (partition by site_id, param, date_trunc('hour', ts) order by seq) as rn
              from {v_obs_raw}) t where rn = 1""",
    "v_store_hourly": """
        select param, cell_lat, cell_lon, hr, value from (
          select s.param, s.cell_lat, s.cell_lon, date_trunc('hour', o.ts) as hr, nullif(o.raw_value, cast(-999 as double)) as value,
                 row_number() over (partition by s.param, s.cell_lat, s.cell_lon, date_trunc('hour', o.ts) order by o.seq) as rn
          from {v_obs_raw} o join {v_site_cells} s on s.site_id = o.site_id and s.param = o.param) t
        where rn = 1""",
    "v_site_cells": """
        select p.*, c.param,
               cast(case when c.param like 'ALLSKY%' then least(floor(lat + 90), 179)
                         else floor((lat + 90) / 0.5e0 + 0.5e0) end as int) as cell_lat,
               cast(case when c.param like 'ALLSKY%' then cast(floor(lon + 180) as bigint) % 360
                         else cast(floor((lon + 180) / 0.625e0 + 0.5e0) as bigint) % 576 end as int) as cell_lon
        from {v_points} p cross join (select param from {v_catalog}) c""",
    "v_store": """
        select param, cell_lat, cell_lon, obs_date, value from (
          select o.param, s.cell_lat, s.cell_lon, o.obs_date, o.value,
                 row_number() over (partition by o.param, s.cell_lat, s.cell_lon, o.obs_date order by o.seq) as rn
          from {v_obs} o join {v_site_cells} s on s.site_id = o.site_id and s.param = o.param) t
        where rn = 1""",
    "v_store_adjusted": """
        select param, cell_lat, cell_lon, elevation, obs_date, value from (
          select o.param, s.cell_lat, s.cell_lon, s.elevation, o.obs_date, o.value,
                 row_number() over (partition by o.param, s.cell_lat, s.cell_lon, s.elevation, o.obs_date order by o.seq) as rn
          from {v_obs} o join {v_site_cells} s on s.site_id = o.site_id and s.param = o.param) t
        where rn = 1""",
}


def _catalog_values() -> str:
    def q(v) -> str:
        return "null" if v is None else "'" + v + "'"
    rows = ", ".join(
        f"({q(r[0])}, {q(r[1])}, {q(r[2])}, {q(r[4][0])}, {q(r[4][1])}, {q(r[5])}, {r[6][0]}e0, {r[6][1]}e0,"
        f" {str(r[11]).lower()})" for r in catalog_rows())
    return ("select * from (values " + rows + ") t(param, label, short_name, unit_daily, unit_hourly,"
            " source_family, lat_step, lon_step, in_default)")


TWIN_SQL["v_catalog"] = _catalog_values()


def twin(sql: str) -> str:
    """Prefix a twin with the views it uses, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in TWIN_SQL and name not in order:
                need(TWIN_SQL[name])
                if name not in order:
                    order.append(name)

    need(sql)
    heads = []
    for name in order:
        body = re.sub(r"\{(\w+)\}", r"\1", TWIN_SQL[name])
        heads.append(f"{name} as ({body})")
    own = sql.strip()
    if own.startswith("with "):
        return "with " + ",\n".join([*heads, own[5:]])
    return ("with " + ",\n".join(heads) + "\n" if heads else "") + own


# --- DataFrame builders -------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared view, built over the tables of one folder."""
    text = SQL[name]
    parts = {n: view(spark, sf_dir, n) if n in SQL else table(spark, sf_dir, n)
             for n in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **parts)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site observations, first delivery per site, parameter and day, fill code as NULL."""
    raw = view(spark, sf_dir, "v_obs_raw").select("site_id", "param", "obs_date", "seq", "raw_value")
    first = keep_first(raw, ["site_id", "param", "obs_date"], "seq")
    return first.select("site_id", "param", F.col("obs_date").cast("timestamp_ntz").alias("obs_ts"), "seq",
                        fill_to_null(F.col("raw_value")).alias("value"))


def hourly_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site observations of the hour, first delivery per site, parameter and hour."""
    raw = view(spark, sf_dir, "v_obs_raw").select(
        "site_id", "param", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("obs_ts"), "seq", "raw_value")
    first = keep_first(raw, ["site_id", "param", "obs_ts"], "seq")
    return first.select("site_id", "param", "obs_ts", "seq", fill_to_null(F.col("raw_value")).alias("value"))


def hourly_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly content of the store, keyed by cell."""
    sites = view(spark, sf_dir, "v_points").select("site_id", "lat", "lon")
    rows = with_cell(hourly_observations(spark, sf_dir).join(sites, "site_id")).select(
        F.lit("hourly").alias("temporal"), "param", "cell_lat", "cell_lon", F.lit("base").alias("variant"),
        "obs_ts", "value", F.col("seq").alias("ingest_seq"))
    return keep_first(rows, ["temporal", "param", "cell_lat", "cell_lon", "variant", "obs_ts"], "ingest_seq")


def store(spark: SparkSession, sf_dir: str, adjusted: bool = False) -> DataFrame:
    """Observation store content keyed by cell; `adjusted` also keys by site elevation."""
    sites = view(spark, sf_dir, "v_points").select("site_id", "lat", "lon", "elevation")
    # Observations are reduced per site first, so a busy site is small before the join.
    placed = with_cell(observations(spark, sf_dir).join(sites, "site_id"))
    none = F.lit(None).cast("string")
    variant = variant_of(F.col("elevation"), none, none) if adjusted else F.lit("base")
    rows = placed.select(F.lit("daily").alias("temporal"), "param", "cell_lat", "cell_lon",
                         variant.alias("variant"), "obs_ts", "value", F.col("seq").alias("ingest_seq"))
    return keep_first(rows, ["temporal", "param", "cell_lat", "cell_lon", "variant", "obs_ts"], "ingest_seq")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request table with `params` as an array."""
    return view(spark, sf_dir, "v_requests").withColumn(
        "params", F.filter(F.split("params_csv", ","), lambda p: p != ""))


def transects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_transects").withColumn("params", F.split("params_csv", ","))
