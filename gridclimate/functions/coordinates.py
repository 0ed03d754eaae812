"""Coordinate text: clean-up, parsing and formatting, all as SQL expressions.

One notation check is one regular expression that rewrites a match to
`tag|degrees|minutes|seconds|hemisphere`. The three checks are disjoint (the
minute and second marks tell them apart), so chaining them is auto-detection.
The pieces are split once and bound to a name before any arithmetic; otherwise
the optimizer would copy the regular expressions into every use. Shared parts may be computed ahead of their guard,
so array access and casts are the forgiving kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: sign variants and the three notations -----------------------
SIGN_VARIANTS = "º˚’′＇”″“"
SIGN_PLAIN = "°°'''\"\"\""
DMS = r"^(-?\d+)\s*°\s*(\d+)\s*'\s*(\d+(?:\.\d+)?)\s*\"?\s*([NnSsEeWw])?$"
DDM = r"^(-?\d+)\s*°\s*(\d+(?:\.\d+)?)\s*'\s*([NnSsEeWw])?$"
DD = r"^(-?\d+(?:\.\d+)?)\s*°?\s*([NnSsEeWw])?$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# --- end of fixed values --------------------------------------------------------

REWRITES = {"dms": (DMS, "dms|$1|$2|$3|$4"), "ddm": (DDM, "ddm|$1|$2|0|$3"), "dd": (DD, "dd|$1|0|0|$2")}
ANY_NOTATION = ("dms", "ddm", "dd")


def _quoted(text: str) -> str:
    """SQL string literal; backslashes doubled, quotes escaped."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def clean_sql(text: str) -> str:
    """Plain degree, minute and second signs, single spaces, no padding."""
    plain = f"replace(translate({text}, {_quoted(SIGN_VARIANTS)}, {_quoted(SIGN_PLAIN)}), {_quoted(chr(39) * 2)}, '\"')"
    return f"trim(regexp_replace({plain}, {_quoted('(?U)' + chr(92) + 's+')}, ' '))"


def pieces_sql(text: str, notations: tuple[str, ...] = ANY_NOTATION) -> str:
    """Array `[tag, degrees, minutes, seconds, hemisphere]`, or NULL when nothing matches."""
    # A bar in the input could pass for a rewritten match, so it is replaced first.
    chain = f"replace({clean_sql(text)}, '|', '?')"
    for tag in notations:
        pattern, rewrite = REWRITES[tag]
        chain = f"regexp_replace({chain}, {_quoted(pattern)}, {_quoted(rewrite)})"
    return f"split({chain}, {_quoted(chr(92) + '|')})"


def tag_sql(p: str) -> str:
    return f"case when size({p}) = 5 then get({p}, 0) end"


def axis_ok_sql(p: str, is_lat: str) -> str:
    """The hemisphere letter, if any, belongs to the axis."""
    return f"(case when {is_lat} then upper(get({p}, 4)) in ('', 'N', 'S') else upper(get({p}, 4)) in ('', 'E', 'W') end)"


def value_sql(p: str, is_lat: str) -> str:
    """Signed degrees from the pieces; a hemisphere letter beats the minus sign."""
    size = (f"(abs(try_cast(get({p}, 1) as double)) + try_cast(get({p}, 2) as double) / 60e0"
            f" + try_cast(get({p}, 3) as double) / 3600e0)")
    negative = (f"(case when get({p}, 4) = '' then left(get({p}, 1), 1) = '-'"
                f" else upper(get({p}, 4)) in ('S', 'W') end)")
    return (f"case when size({p}) = 5 and {axis_ok_sql(p, is_lat)}"
            f" then case when {negative} then -{size} else {size} end end")


def sign_clash_sql(p: str) -> str:
    """Minutes notation with both a minus sign and a hemisphere letter."""
    return (f"coalesce(size({p}) = 5 and get({p}, 0) in ('dms', 'ddm')"
            f" and get({p}, 4) <> '' and try_cast(get({p}, 1) as double) < 0, false)")


def parse_sql(text: str, is_lat: str, notations: tuple[str, ...] = ANY_NOTATION) -> str:
    """Self-contained expression: text to signed degrees, NULL when invalid."""
    bound = value_sql("p", is_lat)
    return f"element_at(transform(array({pieces_sql(text, notations)}), p -> {bound}), 1)"


def is_number_sql(text: str) -> str:
    return f"coalesce(trim({text}) rlike {_quoted(NUMBER)}, false)"


# --- formatting -----------------------------------------------------------------

def _pattern(digits: int) -> str:
    return "'0." + "0" * digits + "'" if digits else "'0'"


def _hemisphere_sql(v: str, is_lat: str) -> str:
    return (f"case when {v} >= 0 then (case when {is_lat} then 'N' else 'E' end)"
            f" else (case when {is_lat} then 'S' else 'W' end) end")


def degrees_sql(v: str) -> str:
    return f"floor(abs({v}))"


def minutes_sql(v: str) -> str:
    """Decimal minutes after the whole degrees."""
    return f"((abs({v}) - floor(abs({v}))) * 60e0)"


def seconds_sql(v: str) -> str:
    """Decimal seconds after the whole minutes."""
    return f"(({minutes_sql(v)} - floor({minutes_sql(v)})) * 60e0)"


def format_dd_sql(v: str, is_lat: str, digits: int = 5) -> str:
    """`23.55000° S`; rounding is half-even on the exact value."""
    return f"concat(format_number(abs({v}), {_pattern(digits)}), '° ', {_hemisphere_sql(v, is_lat)})"


def format_ddm_sql(v: str, is_lat: str, digits: int = 3) -> str:
    """`23°33.000' S`; degrees are cut, not rounded."""
    return (f"concat(cast({degrees_sql(v)} as string), '°', format_number({minutes_sql(v)}, {_pattern(digits)}),"
            f" '\\' ', {_hemisphere_sql(v, is_lat)})")


def format_dms_sql(v: str, is_lat: str, digits: int = 0) -> str:
    """`23°33'0" S`; seconds may print as 60."""
    return (f"concat(cast({degrees_sql(v)} as string), '°', cast(floor({minutes_sql(v)}) as string), '\\'',"
            f" format_number({seconds_sql(v)}, {_pattern(digits)}), '\" ', {_hemisphere_sql(v, is_lat)})")


# --- column and DataFrame API -----------------------------------------------------

def _axis(is_lat: bool) -> str:
    return "true" if is_lat else "false"


def parse_dd(column: str, is_lat: bool) -> Column:
    return F.expr(parse_sql(f"`{column}`", _axis(is_lat), ("dd",)))


def parse_ddm(column: str, is_lat: bool) -> Column:
    return F.expr(parse_sql(f"`{column}`", _axis(is_lat), ("ddm",)))


def parse_dms(column: str, is_lat: bool) -> Column:
    return F.expr(parse_sql(f"`{column}`", _axis(is_lat), ("dms",)))


def parse_any(column: str, is_lat: bool) -> Column:
    return F.expr(parse_sql(f"`{column}`", _axis(is_lat)))


def clean_text(column: str) -> Column:
    return F.expr(clean_sql(f"`{column}`"))


def format_dd(column: str, is_lat: bool, digits: int = 5) -> Column:
    return F.expr(format_dd_sql(f"`{column}`", _axis(is_lat), digits))


def format_ddm(column: str, is_lat: bool, digits: int = 3) -> Column:
    return F.expr(format_ddm_sql(f"`{column}`", _axis(is_lat), digits))


def format_dms(column: str, is_lat: bool, digits: int = 0) -> Column:
    return F.expr(format_dms_sql(f"`{column}`", _axis(is_lat), digits))


def ddm_components(column: str, is_lat: bool) -> Column:
    """Struct of degrees, decimal minutes and hemisphere."""
    v = f"`{column}`"
    return F.expr(f"named_struct('degrees', {degrees_sql(v)}, 'minutes', {minutes_sql(v)},"
                  f" 'hemisphere', {_hemisphere_sql(v, _axis(is_lat))})")


def dms_components(column: str, is_lat: bool) -> Column:
    """Struct of degrees, whole minutes, decimal seconds and hemisphere."""
    v = f"`{column}`"
    return F.expr(f"named_struct('degrees', {degrees_sql(v)}, 'minutes', floor({minutes_sql(v)}),"
                  f" 'seconds', {seconds_sql(v)}, 'hemisphere', {_hemisphere_sql(v, _axis(is_lat))})")


def parse_column(df: DataFrame, column: str, is_lat: bool, out: str,
                 notations: tuple[str, ...] = ANY_NOTATION) -> DataFrame:
    """Add `out`, `out_format` and `out_clash` parsed from a text column.

    `inline` keeps the split pieces as one materialised column, so the regular
    expressions run once per row and the arithmetic stays in generated code.
    """
    pieces = f"inline(array(struct({pieces_sql(f'`{column}`', notations)} as _pieces)))"
    axis = _axis(is_lat)
    return (df.selectExpr("*", pieces)
            .selectExpr(*[f"`{c}`" for c in df.columns],
                        f"{value_sql('_pieces', axis)} as `{out}`",
                        f"{tag_sql('_pieces')} as `{out}_format`",
                        f"{sign_clash_sql('_pieces')} as `{out}_clash`"))


def standardise_sites(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Turn coordinate columns of any form into checked decimal degrees.

    Replaces `lat` and `lon` by doubles and adds `coord_format`,
    `coord_warning` and `coord_error`. Rows with an error keep NULL coordinates;
    `split_sites` parts them. A pair counts as plain numbers only when both
    halves do; otherwise both are read as coordinate text.
    """
    text = (df.withColumnRenamed(lat, "_lat_in").withColumnRenamed(lon, "_lon_in")
            .withColumns({"_lat_text": F.col("_lat_in").cast("string"),
                          "_lon_text": F.col("_lon_in").cast("string")})
            .withColumn("_plain", F.expr(f"{is_number_sql('_lat_text')} and {is_number_sql('_lon_text')}")))
    parsed = parse_column(parse_column(text, "_lat_text", True, "_plat"), "_lon_text", False, "_plon")
    plain = F.col("_plain")
    value = parsed.withColumns({
        "_lat": F.when(plain, F.expr("try_cast(_lat_text as double)")).otherwise(F.col("_plat")),
        "_lon": F.when(plain, F.expr("try_cast(_lon_text as double)")).otherwise(F.col("_plon")),
    })
    lat_bad = F.col("_lat").isNull() | F.col("_lon").isNull()
    error = (F.when(F.col("_lat").isNull(), F.lit("cannot read latitude"))
             .when(F.col("_lon").isNull(), F.lit("cannot read longitude"))
             .when(~F.col("_lat").between(-90.0, 90.0), F.lit("latitude outside [-90, 90]"))
             .when(~F.col("_lon").between(-180.0, 180.0), F.lit("longitude outside [-180, 180]")))
    keep = [c for c in text.columns if not c.startswith("_")]
    return (value.withColumn("coord_error", error)
            .select(*keep,
                    F.when(F.col("coord_error").isNull(), F.col("_lat")).alias(lat),
                    F.when(F.col("coord_error").isNull(), F.col("_lon")).alias(lon),
                    F.when(plain, F.lit("number"))
                    .when(~lat_bad, F.concat_ws(",", "_plat_format", "_plon_format")).alias("coord_format"),
                    F.when(~plain & (F.col("_plat_clash") | F.col("_plon_clash")),
                           F.lit("minus sign ignored, hemisphere letter used")).alias("coord_warning"),
                    "coord_error"))


def split_sites(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable sites and the quarantine."""
    return df.where("coord_error is null"), df.where("coord_error is not null")
