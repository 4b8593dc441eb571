"""Profiles that add up: states by day folder, merged for any range, exact quartiles.

A state is one row for each numeric column of a day: rows and missing ones, sum and squared
deviations, extremes, and a quantile sketch. States merge, so the profile of a month reads
its days' states and not its rows. A quartile is then exact with one look at the rows: the
merged sketch gives two values that it must lie between, the rows below the lower one are
counted and those between are counted by value, a few in a hundred of all. If a sketch
should have missed, the column is looked at again between its extremes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from gazette.session import stored

QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
# Size of a quantile sketch, and how far from a rank its answer may lie: several times its usual error.
SKETCH, MARGIN = 400, 0.03
# Steps into which the values between two bounds are counted before those of a few steps are ordered.
STEPS = 1024

STATE = (
    "column_name string, rows bigint, n bigint, total double, squares double, least double, most double, sketch binary, "
    "year int, month int, day int"
)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _value(name: str) -> Column:
    """A column as a double; not-a-number is missing."""
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


def day_states(df: DataFrame, ts: str, columns: list[str] | None = None) -> DataFrame:
    """One state for each day and numeric column; one pass, combined before it is shuffled."""
    columns = columns or numeric_columns(df)
    day = F.to_date(F.col(ts).cast("timestamp"))
    values = df.select(
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        *[_value(c).alias(f"c{i}") for i, c in enumerate(columns)])
    parts = []
    for i in range(len(columns)):
        x = f"c{i}"
        parts += [
            F.count(x).alias(f"n{i}"), F.sum(x).alias(f"t{i}"), (F.var_pop(x) * F.count(x)).alias(f"s{i}"),
            F.min(x).alias(f"a{i}"), F.max(x).alias(f"z{i}"), F.kll_sketch_agg_double(x, F.lit(SKETCH)).alias(f"k{i}")]
    wide = values.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("rows"), *parts)
    each = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col("rows"), F.col(f"n{i}").alias("n"), F.col(f"t{i}").alias("total"),
            F.col(f"s{i}").alias("squares"), F.col(f"a{i}").alias("least"), F.col(f"z{i}").alias("most"),
            F.col(f"k{i}").alias("sketch"))
        for i, c in enumerate(columns)])
    return wide.select("year", "month", "day", F.inline(each)).select(
        "column_name", "rows", "n", "total", "squares", "least", "most", "sketch", "year", "month", "day")


def write_states(states: DataFrame, path: str) -> None:
    """States below `year/month/day`; a day written again replaces its own."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month", "day").parquet(path)


def read_states(spark: SparkSession, path: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """The states of a month, of a year or of all; other folders are not read."""
    states = spark.read.schema(STATE).parquet(path)
    for name, wanted in (("year", year), ("month", month)):
        if wanted is not None:
            states = states.filter(F.col(name) == wanted)
    return states


def merged(states: DataFrame) -> DataFrame:
    """One row a column: `rows`, `n`, `mean`, `std`, `least`, `most`, `null_percent` and the merged `sketch`."""
    full = states.filter("n > 0")
    sums = full.groupBy("column_name").agg(
        F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean"), F.min("least").alias("least"),
        F.max("most").alias("most"), F.kll_merge_agg_double("sketch").alias("sketch"))
    # deviations from a day's own mean, and of the days' means from the common one
    spread = full.join(sums.select("column_name", "mean"), "column_name").groupBy("column_name").agg(
        F.sum(F.col("squares") + F.col("n") * F.pow(F.col("total") / F.col("n") - F.col("mean"), 2)).alias("squares"))
    rows = states.groupBy("column_name").agg(F.sum("rows").alias("rows"), F.sum("n").alias("known"))
    return rows.join(sums, "column_name", "left").join(spread, "column_name", "left").select(
        "column_name", "rows", F.coalesce("n", F.lit(0)).alias("n"), "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("std"), "least", "most",
        (F.round(1 - F.try_divide(F.col("known"), F.col("rows")), 4) * 100).alias("null_percent"), "sketch")


def _bounds(profile: DataFrame) -> list[dict]:
    """For each column and quartile the ranks asked for and two values between which they lie; one row a column."""
    asked = [
        c for name, q in QUARTILES.items() for c in (
            F.kll_sketch_get_quantile_double("sketch", F.lit(max(0.0, q - MARGIN))).alias(f"low {name}"),
            F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, q + MARGIN))).alias(f"high {name}"))]
    out = []
    for r in profile.filter("n > 0").select("column_name", "n", "least", "most", *asked).collect():
        for name, q in QUARTILES.items():
            rank = (r["n"] - 1) * q
            out.append({"column": r["column_name"], "quartile": name, "rank": rank, "n": r["n"],
                        "low": r[f"low {name}"], "high": r[f"high {name}"], "least": r["least"], "most": r["most"]})
    return out


def _between(df: DataFrame, bounds: list[dict]) -> DataFrame:
    """`i`, `value`, `n`: the values between the bounds number `i`, counted."""
    found = F.array(*[
        F.when(_value(b["column"]).between(b["low"], b["high"]), F.struct(F.lit(i).alias("i"), _value(b["column"]).alias("value")))
        for i, b in enumerate(bounds)])
    rows = df.select(F.inline(F.filter(found, lambda x: x.isNotNull())))
    return rows.groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))


def _picked(inside: DataFrame, bounds: list[dict], below: list[int]) -> dict[int, float | None]:
    """The interpolated value at each bound's rank; None where the bounds do not hold it."""
    step = F.lit(0)
    for i, b in enumerate(bounds):
        width = (b["high"] - b["low"]) or 1.0
        step = F.when(F.col("i") == i, F.least(F.floor((F.col("value") - b["low"]) / width * STEPS), F.lit(STEPS - 1))).otherwise(step)
    stepped = inside.withColumn("step", step)
    # at most STEPS counts a bound
    counts: dict[int, list[tuple[int, int]]] = {}
    for r in stepped.groupBy("i", "step").agg(F.sum("n").alias("n")).orderBy("i", "step").collect():
        counts.setdefault(r["i"], []).append((r["step"], r["n"]))
    wanted, before, out = F.lit(False), {}, {}
    for i, b in enumerate(bounds):
        low, high, upto, steps = math.floor(b["rank"]), math.ceil(b["rank"]), below[i], []
        for at, n in counts.get(i, []):
            if upto <= high and low < upto + n:
                before.setdefault(i, upto)
                steps.append(at)
            upto += n
        out[i] = None
        if steps and before[i] <= low and high < upto:
            wanted = wanted | ((F.col("i") == i) & F.col("step").between(steps[0], steps[-1]))
    order = Window.partitionBy("i").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = stepped.filter(wanted).withColumn("upto", F.sum("n").over(order))
    # the first value whose count reaches a rank
    some: dict[tuple[int, int], float] = {}
    tests = [
        (F.col("i") == i) & (F.col("upto") - F.col("n") <= rank - before[i]) & (F.col("upto") > rank - before[i])
        for i, b in enumerate(bounds) if i in before for rank in {math.floor(b["rank"]), math.ceil(b["rank"])}]
    if not tests:
        return out
    hit = tests[0]
    for t in tests[1:]:
        hit = hit | t
    for r in ranked.filter(hit).collect():
        i = r["i"]
        for rank in {math.floor(bounds[i]["rank"]), math.ceil(bounds[i]["rank"])}:
            if r["upto"] - r["n"] + before[i] <= rank < r["upto"] + before[i]:
                some[i, rank] = r["value"]
    for i, b in enumerate(bounds):
        low, high = some.get((i, math.floor(b["rank"]))), some.get((i, math.ceil(b["rank"])))
        if low is not None and high is not None:
            out[i] = low + (b["rank"] - math.floor(b["rank"])) * (high - low)
    return out


def quartiles(df: DataFrame, profile: DataFrame) -> DataFrame:
    """`column_name` and the exact quartiles of the rows whose merged profile is given; two passes over them."""
    bounds = _bounds(profile)
    found: dict[tuple[str, str], float] = {}
    while bounds:
        counts = df.agg(*[F.count_if(_value(b["column"]) < b["low"]).alias(f"b{i}") for i, b in enumerate(bounds)]).first()
        inside = stored(_between(df, bounds), "between")
        values = _picked(inside, bounds, list(counts))
        found |= {(bounds[i]["column"], bounds[i]["quartile"]): x for i, x in values.items() if x is not None}
        bounds = [b | {"low": b["least"], "high": b["most"]} for i, b in enumerate(bounds) if values[i] is None]
    names = sorted({c for c, _ in found})
    schema = "column_name string, " + ", ".join(f"`{q}` double" for q in QUARTILES)
    return df.sparkSession.createDataFrame([(c, *(found[c, q] for q in QUARTILES)) for c in names], schema)


def profile_of(df: DataFrame, states: DataFrame) -> DataFrame:
    """The profile of `df` from its days' states: counts, moments, extremes, quartiles and missing values."""
    profile = stored(merged(states), "profile")
    return profile.join(quartiles(df, profile), "column_name", "left").select(
        "column_name", "rows", "n", "mean", "std", F.col("least").alias("min"), *[f"`{q}`" for q in QUARTILES],
        F.col("most").alias("max"), "null_percent")
