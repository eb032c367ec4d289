"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwatch.llm.tables import SPACE, SPACE_CHARS, text_or_empty, words_of

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that was for on as with by at an be this it are or from have not you "
    "der die das und den von zu mit auf ist ein eine nicht des dem im sich für es als "
    "le la les et est une du un que pour dans en qui sur pas au par ce il plus "
    "el los las y por con del se no su al lo como más pero sus si"
).split()
SYMBOLS = "#*$%&|<>"
FEW_REPEATS = 24
BULLET, ELLIPSIS = r"^[\x20\x09]*[-*•‣]", r"(\.\.\.|…)[\x20\x09-\x0D]*$"


class Rule(NamedTuple):
    """A text fails where the metric is below ``low`` or above ``high``; a limit of None is no limit."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


# Share of words for symbols and stop words, share of the lines that hold a word for the lines.
RULES = (
    Rule("few_words", "n_words", low=50),
    Rule("word_length", "mean_word_chars", low=2, high=15),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_word_ratio", low=0.02),
    Rule("repeated_lines", "dup_line_ratio", high=0.4),
    Rule("bullet_lines", "bullet_line_ratio", high=0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", high=0.3),
    Rule("repeated_words", "repeat_word_ratio", high=0.5),
)


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _places(repeated: Column) -> Column:
    """Where the windows of ``_windows`` stand that are listed in ``repeated``."""
    found = F.transform("_windows", lambda h, i: F.when(F.array_contains(repeated, h), i))
    return F.filter(found, lambda i: i.isNotNull())


def _places_by_sorting() -> Column:
    """Where the windows stand that occur twice or more, from ``_sorted``: (window, place) pairs in order."""
    pair = lambda i: F.get("_sorted", i)
    same = lambda p, j: F.coalesce(p["h"] == pair(j)["h"], F.lit(False))
    found = F.transform("_sorted", lambda p, i: F.when(same(p, i - 1) | same(p, i + 1), p["i"]))
    return F.sort_array(F.filter(found, lambda i: i.isNotNull()))


def _covered(places: Column) -> Column:
    """Words in the windows at these places, each counted once: a place adds the words up to the next, three at most."""
    step = lambda held, i: F.struct(
        (held["n"] + F.least(F.lit(3), i - held["last"])).alias("n"), i.alias("last")
    )
    return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), step, lambda held: held["n"])


def text_metrics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and every count and ratio that a rule may use; one row per input row.

    NULL text counts as empty: no words, all counts and ratios 0. Other columns of ``docs`` are not looked at,
    so their names can't clash. Windows of three words are compared by a 64-bit hash.
    """
    kept = [F.col(c) for c in keep]
    parts = docs.select(*kept, text_or_empty(text).alias("_text"))
    parts = parts.select(
        *kept,
        "_text",
        words_of(F.col("_text")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: F.length(F.translate(line, SPACE_CHARS, "")) > 0).alias("_lines"),
    )
    last = F.size("_words") - 3
    parts = parts.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        (F.length("_text") - F.regexp_count("_text", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_lines", lambda line: line.rlike(BULLET))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("_lines", lambda line: line.rlike(ELLIPSIS))).cast("long").alias("n_ellipsis_lines"),
        F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_windows"),
    )
    counts = [c for c in parts.columns if c != "_windows"]
    again = F.size("_windows") - F.size(F.array_distinct("_windows"))
    parts = parts.select(*counts, "_windows", again.alias("_again"))
    # Both ways give the same places. Few repeated windows are looked up in their list; many are found by sorting
    # windows with their places, as the list would be long.
    few, many = F.col("_again").between(1, FEW_REPEATS), F.col("_again") > FEW_REPEATS
    parts = parts.select(
        *counts,
        "_windows",
        "_again",
        F.when(few, F.sort_array("_windows")).otherwise(F.array().cast("array<bigint>")).alias("_ordered"),
        F.when(many, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        .alias("_sorted"),
    )
    parts = parts.select(
        *counts,
        "_windows",
        "_sorted",
        F.filter("_ordered", lambda h, i: h == F.get("_ordered", i + 1)).alias("_repeated"),
    )
    # A list that a lambda reads must be a column that is read elsewhere too, or it is worked out for every element.
    places = (
        F.when(F.size("_repeated") > 0, _places(F.col("_repeated")))
        .when(F.size("_sorted") > 0, _places_by_sorting())
        .otherwise(F.array().cast("array<int>"))
    )
    return parts.select(*counts, places.alias("_places")).select(*counts, _covered(F.col("_places")).cast("long").alias("n_repeat_words")).select(
        "*",
        _ratio("word_chars", "n_words").alias("mean_word_chars"),
        _ratio("n_symbols", "n_words").alias("symbol_ratio"),
        _ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        _ratio("n_bullet_lines", "n_lines").alias("bullet_line_ratio"),
        _ratio("n_ellipsis_lines", "n_lines").alias("ellipsis_line_ratio"),
        _ratio("n_repeat_words", "n_words").alias("repeat_word_ratio"),
    ).select(F.inline(F.array(F.struct("*"))))  # else a filter would move below the projections and repeat all their work


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a row of ``text_metrics`` fails, in the table's order."""
    tests = []
    for rule in rules:
        fails = F.lit(False)
        if rule.low is not None:
            fails = fails | (F.col(rule.metric) < rule.low)
        if rule.high is not None:
            fails = fails | (F.col(rule.metric) > rule.high)
        tests.append(F.when(fails, F.lit(rule.name)))
    return F.array_compact(F.array(*tests))


def quality_verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, all metrics, ``failed`` (rule names) and ``kept``, one row per input row, without a shuffle.

    NULL and empty texts fail; repeated rows get the same verdict each; an empty table gives no rows.
    """
    metrics = text_metrics(docs, [key], text)
    return metrics.withColumn("failed", failed_rules(rules)).withColumn("kept", F.size("failed") == 0)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes every rule, with all their columns as they are."""
    whole = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_body"))
    return text_metrics(whole, ["_row"], "_body").where(F.size(failed_rules(rules)) == 0).select("_row.*")
