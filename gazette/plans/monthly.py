"""Monthly preparation of exported articles (B2)."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette.functions.text import na_strings_to_null
from gazette.operators.counts import head
from gazette.operators.filters import with_content, with_title
from gazette.operators.merge import concatenated
from gazette.operators.profile import describe, null_share
from gazette.schemas import ARTICLE_CSV
from gazette.sources.objects import read_exports


@dataclass
class Month:
    """What preparing a month gives; the summary is worked out when it is asked for."""

    clean: DataFrame
    null_before: DataFrame
    null_after: DataFrame

    @cached_property
    def summary(self) -> DataFrame:
        """Summary statistics of the clean rows (A10)."""
        return describe(self.clean)

    @property
    def head(self) -> DataFrame:
        """Its first five rows by article."""
        by = "article_id" if "article_id" in self.clean.columns else self.clean.columns[0]
        return head(self.clean, [F.asc(by)])


def profiles(df: DataFrame) -> tuple[list[str], DataFrame, DataFrame]:
    """Columns that hold a value, and null shares before and after rows without content go.

    Three steps of the preparation (F8, A9, F6 with A9) out of one pass.
    """
    has_content = F.col("content").isNotNull()
    row = df.agg(*[
        F.struct(
            F.count(F.col(f"`{c}`")).alias("n"),
            null_share(F.col(f"`{c}`").isNull()).alias("before"),
            null_share(F.when(has_content, F.col(f"`{c}`").isNull())).alias("after"),
        ).alias(c)
        for c in df.columns
    ])
    seen = row.first()
    kept = [c for c in df.columns if seen[c]["n"]]
    spark = df.sparkSession
    shares = [
        spark.createDataFrame(
            [(c, seen[c][part]) for c in kept], "column_name string, null_percent double"
        )
        for part in ("before", "after")
    ]
    return kept, *shares


def prepare_month(df: DataFrame) -> Month:
    """Drop empty columns, profile, drop rows without content and title (B2)."""
    df = na_strings_to_null(df)
    kept, before, after = profiles(df)
    narrow = df.select(*[F.col(f"`{c}`") for c in kept])
    for column, drop in (("content", with_content), ("title", with_title)):
        # A column that is null throughout was dropped, and every row with it.
        narrow = drop(narrow) if column in kept else narrow.limit(0)
    return Month(narrow, before, after)


def prepare_exports(spark: SparkSession, slices: list[str], out: str, schema: str = ARTICLE_CSV) -> Month:
    """Concatenate the exported slices that exist, store them, prepare and store the result.

    Both tables are written (U1, K13) to new folders below `out`: the concatenated
    slices, read back for the passes of the preparation, and the clean month.
    """
    frames = read_exports(spark, slices, schema)
    if not frames:
        raise FileNotFoundError(f"no slices to aggregate among {slices}")
    concatenated(spark, frames, schema).write.mode("errorifexists").parquet(f"{out}/aggregated")
    month = prepare_month(spark.read.parquet(f"{out}/aggregated"))
    month.clean.write.mode("errorifexists").parquet(f"{out}/clean")
    return replace(month, clean=spark.read.schema(month.clean.schema).parquet(f"{out}/clean"))
