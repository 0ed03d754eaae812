"""Result writer for CSV, JSON lines and Parquet."""

from __future__ import annotations

import warnings
from pathlib import PurePosixPath

from pyspark.sql import DataFrame

# Formats and the extensions that imply them.
FORMATS = ["csv", "json", "parquet"]
EXTENSIONS = {".csv": "csv", ".json": "json", ".parquet": "parquet", ".pq": "parquet"}


def resolve_format(path: str, fmt: str | None = None) -> str:
    """Known extension first, then the explicit format, then CSV."""
    asked = fmt.lower() if fmt else None
    if asked and asked not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; expected one of {', '.join(FORMATS)}")
    implied = EXTENSIONS.get(PurePosixPath(path).suffix.lower())
    if implied and asked and implied != asked:
        warnings.warn(f"the path implies {implied}; format {asked} is ignored", UserWarning, stacklevel=2)
    return implied or asked or "csv"


def write_result(df: DataFrame, path: str, fmt: str | None = None, mode: str = "errorifexists",
                 order_by: list[str] | None = None) -> str:
    """Write a result as a directory of part files; returns the format used.

    `order_by` sorts here, at the very end: the part files follow one another.
    """
    resolved = resolve_format(path, fmt)
    if order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode(mode)
    if resolved == "csv":
        writer.option("header", True).csv(path)
    elif resolved == "json":
        # ISO stamps, and NULL fields kept so every record has every column.
        writer.option("ignoreNullFields", False).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS").json(path)
    else:
        writer.parquet(path)
    return resolved
