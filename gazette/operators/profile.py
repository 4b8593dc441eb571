"""Null profile and summary statistics."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from gazette.functions.text import key_of
from gazette.operators.filters import missing
from gazette.session import stored

SUMMARY = (
    "column_name string, `count` bigint, `unique` bigint, top string, freq bigint, mean double, "
    "std double, `min` double, p25 double, p50 double, p75 double, `max` double"
)
QUARTILES = (0.25, 0.5, 0.75)

# A quartile is looked up directly once this many values are left to choose from.
MAX_CANDIDATES = 100_000
# Accuracy of the estimates that bracket a quartile, and how far from it they aim.
_ACCURACY = 10_000
_MARGIN = 3.0 / _ACCURACY
# Most frequent texts up to this number are compared on the driver's list of keys.
_MAX_TOP_KEYS = 1_000


def null_share(is_null: Column) -> Column:
    """Percentage of nulls, rounded to four places before it is made a percentage."""
    return F.round(F.round(F.avg(is_null.cast("int")), 4) * 100, 2)


def unpivoted(row: DataFrame, names: list[str], value: str) -> DataFrame:
    """One row of values as `column_name`, `value` rows."""
    pairs = [F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias(value)) for n in names]
    return row.select(F.inline(F.array(*pairs)))


def null_profile(df: DataFrame) -> DataFrame:
    """Percentage of nulls, NaN among them, in every column (A9), all in one pass."""
    row = df.agg(*[null_share(missing(df, c)).alias(c) for c in df.columns])
    return unpivoted(row, df.columns, "null_percent")


def describe(df: DataFrame) -> DataFrame:
    """Summary statistics, one row per column (A10).

    Text and boolean columns have count, unique, top and freq; numeric ones count, mean,
    sample standard deviation, minimum, quartiles (interpolated, exact) and
    maximum. Other cells are null, as are array and map columns' but the count.
    The most frequent text is the smallest one of those most frequent.
    """
    spark = df.sparkSession
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in flags}) if flags else df
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    rows = _describe_numbers(df, numeric) if numeric else {}
    rows |= _describe_texts(df, texts) if texts else {}
    others = [c for c in df.columns if c not in rows]
    if others:
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in others]).first()
        rows |= {c: {"count": counts[c]} for c in others}
    return _summary(spark, [{"column_name": c, **rows[c]} for c in df.columns])


def _summary(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = [f.name for f in T.StructType.fromDDL(SUMMARY).fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SUMMARY)


# --- text columns ---------------------------------------------------------


def _describe_texts(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    """Texts of all columns are counted in one pass, by their hash: no text is shuffled.

    The counts are stored in the shared folder, as they are asked three things.
    """
    cells = [
        F.struct(F.lit(i).alias("column"), F.unhex(key_of(F.col(f"`{c}`"), 64)).alias("key"))
        for i, c in enumerate(columns)
    ]
    per_key = stored(
        df.select(F.inline(F.array(*cells)))
        .filter("key IS NOT NULL")
        .groupBy("column", "key")
        .agg(F.count(F.lit(1)).alias("n")),
        "text-counts",
    )
    totals = per_key.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq")
    )
    out = {c: {"count": 0, "unique": 0} for c in columns}
    out |= {columns[r["column"]]: {k: r[k] for k in ("count", "unique", "freq")} for r in totals.collect()}
    return _with_top(df, per_key, columns, out)


def _with_top(df: DataFrame, per_key: DataFrame, columns: list[str], out: dict[str, dict]) -> dict:
    """The smallest of the most frequent texts of each column.

    Where no text repeats that is the smallest of all. Else the most frequent
    keys are looked up: a few by a list, many by a join.
    """
    repeated = [i for i, c in enumerate(columns) if out[c].get("freq", 1) > 1]
    candidates = {c: df.select(F.col(f"`{c}`").alias("text")) for i, c in enumerate(columns) if i not in repeated}
    if repeated:
        most = per_key.filter(reduce(or_, [
            (F.col("column") == i) & (F.col("n") == out[columns[i]]["freq"]) for i in repeated
        ]))
        first_keys = most.groupBy("column").agg(F.count(F.lit(1)).alias("ties"))
        ties = {r["column"]: r["ties"] for r in first_keys.collect()}
        few = [i for i in repeated if ties[i] <= _MAX_TOP_KEYS]
        listed = most.filter(F.col("column").isin(few)).select("column", "key").collect() if few else []
        for i in repeated:
            text = F.col(f"`{columns[i]}`").alias("text")
            keyed = df.select(text, F.unhex(key_of(text, 64)).alias("key"))
            if i in few:
                keys = [bytes(r["key"]) for r in listed if r["column"] == i]
                candidates[columns[i]] = keyed.filter(F.col("key").isin(keys)).select("text")
            else:
                wanted = most.filter(F.col("column") == i).select("key")
                candidates[columns[i]] = keyed.join(wanted, "key", "left_semi").select("text")
    tops = [
        texts.agg(F.min("text").alias("top")).select(F.lit(c).alias("name"), "top")
        for c, texts in candidates.items()
    ]
    for r in reduce(DataFrame.unionByName, tops).collect():
        out[r["name"]]["top"] = r["top"]
    return out


# --- numeric columns ------------------------------------------------------


def _describe_numbers(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    """Moments in one pass; quartiles by narrowing a bracket around each of them."""
    values = df.select(*[_number(F.col(f"`{c}`")).alias(c) for c in columns])
    aims = [min(max(q + side * _MARGIN, 0.0), 1.0) for q in QUARTILES for side in (-1, 1)]
    first = values.agg(*[
        F.struct(
            F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"), F.max(c).alias("max"),
            F.percentile_approx(c, aims, _ACCURACY).alias("near"),
        ).alias(c)
        for c in (f"`{c}`" for c in columns)
    ]).first()
    out, targets = {}, {}
    for column, stats in zip(columns, first):
        out[column] = {k: stats[k] for k in ("count", "mean", "std", "min", "max")}
        for i, q in enumerate(QUARTILES if stats["count"] else ()):
            low = int((stats["count"] - 1) * q)
            ranks = [low, min(low + 1, stats["count"] - 1)]
            targets[column, i] = (ranks, stats["near"][2 * i], stats["near"][2 * i + 1])
    for (column, i), (a, b) in _values_at(values, targets, out).items():
        position = (out[column]["count"] - 1) * QUARTILES[i]
        out[column][("p25", "p50", "p75")[i]] = a + (b - a) * (position - int(position))
    return out


def _number(value: Column) -> Column:
    """As a double; NaN counts as missing."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def _values_at(
    values: DataFrame, targets: dict[tuple, tuple[list[int], float, float]], stats: dict[str, dict]
) -> dict[tuple, list[float]]:
    """The values at given ranks (from 0) in sorted order, exactly.

    A target is a column, ranks that lie side by side and a guess `low..high` of
    where they are. One pass counts what is below, at and between the two ends.
    A rank on an end is found; ranks between them are narrowed again with fresh
    estimates, until few values are left between. Repeated values gather on an
    end, so they cannot keep a bracket wide. `floor..ceiling` is what is certain;
    it shrinks with every pass, also when an estimate was off. All passes are plain
    aggregates with one row of result.
    """
    found: dict[tuple, dict[int, float]] = {t: {} for t in targets}
    open_ = {
        t: (ranks, low, high, stats[t[0]]["min"], stats[t[0]]["max"])
        for t, (ranks, low, high) in targets.items()
    }
    small: list[tuple] = []
    while open_:
        row = values.agg(*[
            _bracket_counts(F.col(f"`{target[0]}`"), low, high).alias(str(i))
            for i, (target, (_, low, high, _, _)) in enumerate(open_.items())
        ]).first()
        again = {}
        for (target, (ranks, low, high, floor, ceiling)), counts in zip(open_.items(), row):
            inside = {}
            start = counts["below"] + counts["at_low"]
            end = start + counts["between"]
            for rank in ranks:
                if counts["below"] <= rank < start:
                    found[target][rank] = low
                elif end <= rank < end + counts["at_high"]:
                    found[target][rank] = high
                elif start <= rank < end:
                    inside[rank] = rank - start
                elif rank < counts["below"]:
                    again[*target, rank] = ([rank], floor, low, floor, low)
                else:
                    again[*target, rank] = ([rank], high, ceiling, high, ceiling)
            if inside and counts["between"] <= MAX_CANDIDATES:
                small += [(target, rank, at, low, high) for rank, at in inside.items()]
            elif inside:
                shares = [at / counts["between"] for at in inside.values()]
                bracket = _inner_bracket(values, target[0], low, high, shares)
                again[target] = (list(inside), *bracket, low, high)
        for target in again:
            found.setdefault(target, {})
        open_ = again
    for target, rank, value in _pick(values, small) if small else ():
        found[target][rank] = value
    merged: dict[tuple, dict[int, float]] = {t: {} for t in targets}
    for target, hits in found.items():
        merged[target[:2]] |= hits
    return {t: [merged[t][rank] for rank in ranks] for t, (ranks, _, _) in targets.items()}


def _bracket_counts(value: Column, low: float, high: float) -> Column:
    return F.struct(
        F.count_if(value < low).alias("below"),
        F.count_if(value == low).alias("at_low"),
        F.count_if((value > low) & (value < high)).alias("between"),
        F.count_if((value == high) & F.lit(high != low)).alias("at_high"),
    )


def _inner_bracket(
    values: DataFrame, column: str, low: float, high: float, shares: list[float]
) -> tuple[float, float]:
    """A narrower bracket around the given shares of the values between two ends."""
    name = f"`{column}`"
    inside = values.filter((F.col(name) > low) & (F.col(name) < high))
    near = [max(min(shares) - _MARGIN, 0.0), min(max(shares) + _MARGIN, 1.0)]
    return tuple(inside.agg(F.percentile_approx(name, near, _ACCURACY)).first()[0])


def _pick(values: DataFrame, small: list[tuple]) -> list[tuple[tuple, int, float]]:
    """Look ranks up among at most `MAX_CANDIDATES` values each, all in one pass.

    Candidates are counted by value, sorted, and walked to the one holding the rank.
    """
    columns = [F.col(f"`{target[0]}`") for target, *_ in small]
    inside = [(c > low) & (c < high) for c, (_, _, _, low, high) in zip(columns, small)]
    asked = F.array(*[
        F.struct(F.lit(i).alias("asked"), F.when(inside[i], c).alias("value")) for i, c in enumerate(columns)
    ])
    counted = (
        values.filter(reduce(or_, inside))
        .select(F.inline(asked))
        .filter("value IS NOT NULL")
        .groupBy("asked", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    before = Window.partitionBy("asked").orderBy("value")
    at = F.element_at(F.array(*[F.lit(at).cast("long") for _, _, at, _, _ in small]), F.col("asked") + 1)
    hits = (
        counted.withColumn("seen", F.sum("n").over(before))
        .filter((F.col("seen") > at) & (F.col("seen") - F.col("n") <= at))
        .select("asked", "value")
    )
    return [(small[r["asked"]][0], small[r["asked"]][1], r["value"]) for r in hits.collect()]
