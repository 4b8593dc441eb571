"""A value used more than once in one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]
