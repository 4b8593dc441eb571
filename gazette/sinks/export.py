"""Exported files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from gazette.schemas import EXPORT_FORMATS


def check_format(file_format: str) -> str:
    """Refuse an unknown format before any data is read."""
    if file_format not in EXPORT_FORMATS:
        raise ValueError(f"unsupported file format {file_format!r}, expected one of {EXPORT_FORMATS}")
    return file_format


def write_csv(df: DataFrame, path: str) -> None:
    """Header, quotes doubled, line breaks and outer spaces kept; arrays as JSON."""
    flat = [
        F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name)
        for f in df.schema.fields
    ]
    (
        df.select(*flat).write.mode("overwrite")
        .option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    """One object per line, missing values as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_export(df: DataFrame, path: str, file_format: str) -> None:
    """The frame in one of the export formats."""
    {"csv": write_csv, "json": write_json}[check_format(file_format)](df, path)
