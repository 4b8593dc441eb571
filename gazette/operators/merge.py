"""Object metadata over object bodies (C7, J5) and concatenation by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gazette.schemas import ARTICLE


def merged_metadata(
    df: DataFrame, metadata: str = "metadata", new_keys: list[str] | None = None
) -> DataFrame:
    """Metadata entries override body columns of the same name, even when empty.

    Names are matched without regard to case and values take the column's type.
    Keys in `new_keys` become columns of their own.
    """
    def entry(name: str) -> Column:
        same = F.filter(F.map_entries(metadata), lambda e: F.lower(e["key"]) == name.lower())
        return F.try_element_at(same, F.lit(-1))

    def merged(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.col(field.name)
        found = entry(field.name)
        value = found["value"].try_cast(field.dataType)
        return F.when(found.isNotNull(), value).otherwise(F.col(field.name)).alias(field.name)

    fields = [f for f in df.schema.fields if f.name != metadata]
    known = {f.name.lower() for f in fields}
    added = [entry(k)["value"].alias(k) for k in new_keys or [] if k.lower() not in known]
    return df.select(*[merged(f) for f in fields], *added)


def joined_metadata(bodies: DataFrame, listing: DataFrame, key: str = "Key") -> DataFrame:
    """Bodies with the metadata of a separate listing, one to one by object."""
    return merged_metadata(bodies.join(listing.select(key, "metadata"), key, "left"))


def concatenated(spark: SparkSession, frames: list[DataFrame], schema: str = ARTICLE) -> DataFrame:
    """All rows of all frames, columns matched by name, gaps null.

    Without any frame the result is empty and has the article columns.
    """
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
