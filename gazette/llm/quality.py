"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Counts come from the whole text without user functions: words, characters in words,
symbols, stop words, lines, and words inside three-word windows that occur again. A
rule passes if numerator / denominator lies within its bounds; an empty denominator
passes. A document stays if it does not fail the base and passes every rule.

Rows: one for each document. Null text counts as empty and fails the base (too few
words). Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import WORD_GAP, pick

# Symbols, and common words of the four languages.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the be to of and that have with in is a on "
    "der die das und von zu mit ist ein im "
    "le la les de des et un une que est "
    "el los las en y que un una por con"
).split()


class Rule(NamedTuple):
    """least <= numerator / denominator <= most."""

    name: str
    numerator: str
    denominator: str | None
    least: float
    most: float


RULES = (
    Rule("words", "n_words", None, 50, 1e7),
    Rule("word_length", "word_chars", "n_words", 2, 20),
    Rule("symbols_a_word", "n_symbols", "n_words", 0, 0.1),
    Rule("stop_words", "n_stop_words", "n_words", 0.005, 1),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0, 0.3),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", 0, 0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", 0, 0.9),
)


def compiled(rules: tuple[Rule, ...]) -> Column:
    """The names of the rules that a row fails, from columns of counts."""
    def fails(rule: Rule) -> Column:
        value = F.col(rule.numerator).cast("double")
        if rule.denominator:
            value = value / F.nullif(F.col(rule.denominator).cast("double"), F.lit(0.0))
        return F.when(~value.between(rule.least, rule.most), F.lit(rule.name))

    return F.array_compact(F.array(*[fails(rule) for rule in rules]))


def _counts(rows: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    split = rows.select(
        "doc_id",
        F.filter(F.split(text, WORD_GAP), lambda w: w != "").alias("ws"),
        F.filter(F.split(text, "\n", -1), has_word).alias("ls"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    windows = F.when(F.size("ws") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("ws") - 3),
        lambda i: F.xxhash64(F.get("ws", i), F.get("ws", i + 1), F.get("ws", i + 2))))
    counted = split.select(
        "doc_id", "word_chars", "n_symbols",
        F.size("ws").cast("long").alias("n_words"),
        F.size("ls").cast("long").alias("n_lines"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("ws", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("ls", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("ls", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[•*‣-]"))).cast("long").alias("n_bullet_lines"),
        windows.alias("hs"))
    # only a text whose windows are not all different has its windows sorted with their places
    again = F.size(F.array_distinct("hs")) < F.size("hs")
    placed = counted.withColumn("hs", F.when(again, F.sort_array(F.transform(
        "hs", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    twice = F.filter("hs", lambda x, k: (F.get("hs", k - 1)["h"] == x["h"]) | (F.get("hs", k + 1)["h"] == x["h"]))
    starts = F.sort_array(F.transform(twice, lambda x: x["at"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"])
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("hs")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, all counts, base_failed, failed_rules and kept, for each document."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        _counts(pick(docs, doc_id="long", text="string"))
        .withColumn("base_failed", base).withColumn("failed_rules", compiled(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))
