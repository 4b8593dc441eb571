"""Small helpers shared by the file readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame


def none_if_missing(load: Callable[[], DataFrame]) -> DataFrame | None:
    """The loaded frame, or None where the path does not exist."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def require_columns(df: DataFrame, required: list[str], what: str) -> DataFrame:
    """All missing columns named in one error."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns: {', '.join(missing)}")
    return df
