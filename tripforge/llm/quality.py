"""Quality rules with thresholds that follow each language and source, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

#: Sketch buckets keep this many leading bits of a value, so their width is at most 1/32 of it.
BITS = 6


@dataclass(frozen=True)
class Rule:
    """A measure of a text, and how far beyond the quartiles of its group a value may lie.

    The fence is ``spreads`` interquartile ranges beyond the quartile, and at
    least ``margin``, so that a group of nearly equal texts doesn't reject its
    own.
    """

    name: str
    value: str
    margin: int
    below: bool = False


RULES = (
    Rule("symbol_rate", "1000 * n_symbols div greatest(word_chars, 1)", 100),
    Rule("dup_line_rate", "1000 * n_dup_lines div greatest(n_lines, 1)", 300),
    Rule("repeat_rate", "1000 * n_repeat_words div greatest(n_words, 1)", 200),
    Rule("word_length", "100 * word_chars div greatest(n_words, 1)", 200, below=True),
)
SPREADS = 4
#: A group's own sketch decides from so many texts on; smaller ones use their language's, then the whole table's.
MIN_TEXTS = 100

_SPACE = r"[\\x20\\x09-\\x0D]+"
_LINE_WITH_WORD = r"[^\\x20\\x09-\\x0D]"


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, ``n_lines``, and ``base_failed``. A null text has none of anything.

    Window fingerprints are 64-bit hashes of eight words. Only texts with a
    repeated one sort theirs; the repeated positions, in order, then cover words
    as far as they reach.
    """
    own = [c for c in docs.columns if c not in _COUNTS]
    step = docs.select(
        *own,
        F.expr(f"array_remove(split(coalesce(text, ''), '{_SPACE}'), '')").alias("_words"),
        F.expr(f"filter(split(coalesce(text, ''), '\\n'), x -> x rlike '{_LINE_WITH_WORD}')").alias("_lines"),
        F.expr("CAST(regexp_count(coalesce(text, ''), '[#*$%&|<>]') AS BIGINT)").alias("n_symbols"),
    )
    step = step.select(
        *own,
        "n_symbols",
        F.expr("CAST(size(_words) AS BIGINT)").alias("n_words"),
        F.expr("CAST(length(array_join(_words, '')) AS BIGINT)").alias("word_chars"),
        F.expr("CAST(size(_lines) AS BIGINT)").alias("n_lines"),
        F.expr("CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT)").alias("n_dup_lines"),
        F.expr(
            f"CASE WHEN size(_words) < {WINDOW} THEN array() ELSE transform(sequence(1, size(_words) - {WINDOW - 1}), "
            f"i -> xxhash64(slice(_words, i, {WINDOW}))) END"
        ).alias("_windows"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines"]
    step = step.select(
        *own,
        *counts,
        F.expr(
            "CASE WHEN size(array_distinct(_windows)) < size(_windows) "
            "THEN array_sort(transform(_windows, (h, i) -> struct(h AS h, i AS i))) END"
        ).alias("_sorted"),
    )
    step = step.select(
        *own,
        *counts,
        F.expr(
            "array_sort(transform(filter(transform(_sorted, (w, k) -> struct(w.i AS i, "
            "coalesce(w.h = get(_sorted, k - 1).h, false) OR coalesce(w.h = get(_sorted, k + 1).h, false) AS twice)), "
            "w -> w.twice), w -> w.i))"
        ).alias("_repeated"),
    )
    covered = (
        f"aggregate(_repeated, struct(0L AS n, -{WINDOW} AS last), "
        f"(a, i) -> struct(a.n + least({WINDOW}, i - a.last) AS n, i AS last), a -> a.n)"
    )
    # Out of a generator, so that no filter on a count is moved below it and into the lambdas.
    values = F.array(F.struct(*counts, F.expr(f"coalesce({covered}, 0L)").alias("n_repeat_words")))
    step = step.select(*own, F.inline(values))
    return step.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "base_failed", "kept")


def sketches(texts: DataFrame) -> DataFrame:
    """Quantile sketches of the rules' values per language and source: counts of log-linear buckets.

    Sketches of several tables merge by adding counts of equal buckets, and so
    do those of sources into one of their language. Size depends on the range
    of values only.
    """
    pairs = ", ".join(f"'{rule.name}', {rule.value}" for rule in RULES)
    values = texts.where("NOT base_failed").select("lang", "source", F.expr(f"stack({len(RULES)}, {pairs}) AS (rule, value)"))
    shift = f"greatest(length(bin(value)) - {BITS}, 0)"
    bucket = F.expr(f"shiftleft(shiftright(value, {shift}), {shift})").alias("bucket")
    return values.select("lang", "source", "rule", bucket).groupBy("lang", "source", "rule", "bucket").agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """Merge ``sketch`` to ``keys`` and read the quartiles and the number of texts."""
    by = ", ".join(["rule", *keys])
    merged = sketch.groupBy("rule", *keys, "bucket").agg(F.sum("n").alias("n"))
    ranked = merged.select(
        "rule",
        *keys,
        "bucket",
        F.expr(f"sum(n) OVER (PARTITION BY {by} ORDER BY bucket)").alias("upto"),
        F.expr(f"sum(n) OVER (PARTITION BY {by})").alias("total"),
    )
    return ranked.groupBy("rule", *keys).agg(
        F.max("total").alias("total"),
        F.expr("min(bucket) FILTER (WHERE 4 * upto >= total)").alias("q1"),
        F.expr("min(bucket) FILTER (WHERE 4 * upto >= 3 * total)").alias("q3"),
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """Per language and source, one column per rule with its upper fence, and a lower one where the rule has it."""
    level = F.struct("total", "q1", "q3")
    own = _quartiles(sketch, "lang", "source").select("rule", "lang", "source", level.alias("own"))
    language = _quartiles(sketch, "lang").select(F.col("rule").alias("_rule"), F.col("lang").alias("_lang"), level.alias("language"))
    whole = _quartiles(sketch).select("rule", level.alias("whole"))
    levels = own.join(language, (F.col("rule") == F.col("_rule")) & F.col("lang").eqNullSafe(F.col("_lang"))).join(whole, "rule")
    chosen = levels.select(
        "rule",
        "lang",
        "source",
        F.when(F.col("own.total") >= MIN_TEXTS, F.col("own")).when(F.col("language.total") >= MIN_TEXTS, F.col("language")).otherwise(F.col("whole")).alias("q"),
    )
    fences = []
    for rule in RULES:
        reach = f"greatest({SPREADS} * (q.q3 - q.q1), {rule.margin})"
        fences.append(F.expr(f"max(q.q3 + {reach}) FILTER (WHERE rule = '{rule.name}')").alias(f"max_{rule.name}"))
        if rule.below:
            fences.append(F.expr(f"max(q.q1 - {reach}) FILTER (WHERE rule = '{rule.name}')").alias(f"min_{rule.name}"))
    return chosen.groupBy("lang", "source").agg(*fences)


def judged(texts: DataFrame, limits: DataFrame) -> DataFrame:
    """``texts`` joined with the thresholds of their language and source, and ``kept``.

    A text passes if the base rules do and no value lies beyond a fence. Null
    languages and sources are groups of their own.
    """
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = texts.join(
        limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    inside = " AND ".join(
        f"{rule.value} <= max_{rule.name}" + f" AND {rule.value} >= min_{rule.name}" * rule.below for rule in RULES
    )
    return joined.select(*texts.columns, F.expr(f"NOT base_failed AND coalesce({inside}, true)").alias("kept"))


def quality(texts: DataFrame) -> DataFrame:
    """Judge measured texts by thresholds learned from these same texts.

    ``texts`` comes from ``measured`` and is read twice, so store it first.
    """
    return judged(texts, thresholds(sketches(texts)))
