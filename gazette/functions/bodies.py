"""JSON message and object bodies (C11-C13) and object metadata (K7)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from gazette.functions.binding import bound
from gazette.functions.text import text_or_empty
from gazette.schemas import MESSAGE, METADATA_KEYS


def message_body(url: Column, cursor: Column) -> Column:
    """Feed message as JSON, a missing cursor as an explicit null (C11)."""
    return F.to_json(
        F.struct(url.alias("u"), cursor.cast("long").alias("dt")), {"ignoreNullFields": "false"}
    )


def decoded(body: Column, schema: str = MESSAGE) -> Column:
    """A JSON object as a struct; null where the body is not such an object.

    A truncated object would otherwise come back with the fields read so far.
    """
    names = T.StructType.fromDDL(schema).names
    read = F.from_json(body, f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    return F.when(
        body.rlike(r"^\s*\{"),
        bound(read, lambda m: F.when(m["_broken"].isNull(), F.struct(*[m[n].alias(n) for n in names]))),
    )


def body_rows(body: Column, schema: str) -> Column:
    """Rows of a body: an object is one, a list of objects many.

    Anything else, a bare scalar or a list holding a non-object included, has
    none: the result is null.
    """
    rows = F.from_json(body, T.ArrayType(T.StructType.fromDDL(schema)))
    return F.when(
        body.rlike(r"^\s*[\[{]"),
        bound(rows, lambda found: F.when(~F.exists(found, lambda r: r.isNull()), found)),
    )


def object_metadata(columns: list[str] | None = None) -> Column:
    """String map stored with an article object, `""` for a missing entry (K7)."""
    keys = columns or METADATA_KEYS
    return F.map_from_arrays(
        F.array(*[F.lit(k) for k in keys]), F.array(*[text_or_empty(F.col(k)) for k in keys])
    )
