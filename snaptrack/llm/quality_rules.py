"""Quality rules: a threshold table compiled into one projection.

Each rule is a named ratio with a lower and an upper bound. The table is turned into one select
of built-in expressions over whole texts, with no shuffle and no user function.

Defined results: a null or empty text has no words and fails the base rules; every input row
gives one row, so repeated rows repeat; columns beyond ``text`` pass through or clash with
nothing, as the operator reads ``text`` alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snaptrack.llm.tables import has_word, lines_of, once, table, words_of

WINDOW = 8
SYMBOLS = "#*$%&|<>"

# Function words of the four languages, lower case.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not are this at from have or",
    "fr": "de la le et les des en un du une que est pour qui dans au sur par pas avec ne se il",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als er",
    "es": "de la que el en y los se del las por un con una no para su es al lo como más pero",
}


class Rule(NamedTuple):
    """``low <= value <= high``; ``value`` is an SQL expression over the base columns."""

    name: str
    value: str
    low: float
    high: float


RULES = (
    Rule("mean word length", "word_chars / n_words", 2, 14),
    Rule("symbols per word", "n_symbols / n_words", 0, 0.1),
    Rule("share of stop words", "n_stop_words / n_words", 0.06, 1),
    Rule("share of words like the one before", "n_same_words / n_words", 0, 0.3),
    Rule("share of repeated lines", "n_dup_lines / n_lines", 0, 0.5),
)
BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"


def stop_words() -> list[str]:
    plain = sorted({word for words in STOP_WORDS.values() for word in words.split()})
    return plain + [word.capitalize() for word in plain]


def verdict_sql(rules: Sequence[Rule] = RULES) -> str:
    """The rules as one SQL condition; the same text runs in Spark and in DuckDB."""
    checks = [f"{r.value} >= {r.low} and {r.value} <= {r.high}" for r in rules]
    return f"case when {BASE_FAILED} then false else coalesce({' and '.join(checks)}, false) end"


def base_columns(df: DataFrame) -> DataFrame:
    """The row with its counts: ``n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, n_stop_words, n_same_words``.

    A word counts as repeated if it lies in an 8-word window found twice or more in the text.
    Windows are compared by 64-bit hash; texts without a repeated window skip the sort. Arrays
    used inside a lambda are referenced outside it too, which keeps them computed once per row.
    """
    text = F.coalesce("text", F.lit(""))
    wordy = F.filter(lines_of(F.col("text")), has_word)
    first = df.withColumns({"_words": words_of(F.col("text")), "_lines": wordy})
    hashed = first.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_stop_words": F.size(
                F.filter("_words", lambda word: word.isin(stop_words()))
            ).cast("long"),
            "_hashes": F.transform("_words", lambda word: F.xxhash64(word)),
        }
    )
    windows = F.when(
        F.size("_hashes") >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)),
        ),
    )
    in_order = F.when(
        F.size("_windows") > F.size(F.array_distinct("_windows")),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )

    def again(x: Column, i: Column) -> Column:
        before, after = F.get("_sorted", i - 1)["h"], F.get("_sorted", i + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

    found = F.when(
        F.size("_sorted") > 0,
        F.sort_array(F.transform(F.filter("_sorted", again), lambda x: x["i"])),
    )
    covered = F.aggregate(
        F.transform(
            "_found",
            lambda p, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get("_found", k + 1) - p, F.lit(WINDOW))
            ).cast("long"),
        ),
        F.lit(0).cast("long"),
        lambda total, step: total + step,
    )
    same = F.filter(
        "_hashes", lambda h, i: F.coalesce(h == F.get("_hashes", i - 1), F.lit(False))
    )
    return (
        hashed.withColumns({"_windows": windows, "n_same_words": F.size(same).cast("long")})
        .withColumn("_sorted", in_order)
        .withColumn("_found", found)
        .withColumn("n_repeat_words", F.when(F.size("_found") > 0, covered).otherwise(F.lit(0)))
        .drop("_words", "_lines", "_hashes", "_windows", "_sorted", "_found")
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_stop_words", "n_same_words")


def apply_rules(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ``doc_id`` and ``text`` rows with their counts, ``base_failed`` and ``kept``."""
    return base_columns(df.select("doc_id", "text")).withColumns(
        {"base_failed": F.expr(BASE_FAILED), "kept": F.expr(verdict_sql(rules))}
    )


def passing(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``df`` that every rule keeps, with the columns of ``df`` alone."""
    whole = df.select(F.struct("*").alias("_row"), "text")
    return once(base_columns(whole), "_kept", F.expr(verdict_sql(rules))).filter("_kept").select(
        "_row.*"
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", *COUNTS, "base_failed", "kept", *EXTRA
    )


def oracle() -> str:
    listed = ", ".join("'" + word + "'" for word in stop_words())
    return f"""
with base as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls
  from documents),
windows as (
  select r, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') as g
  from (select r, w, unnest(range(1, len(w) - 6)) as i from base where len(w) >= 8)),
twice as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (
  select r, count(distinct p) as n
  from (select r, unnest(range(i, i + 8)) as p from twice) group by r),
counts as (
  select doc_id, len(w)::bigint as n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         (length(t) - length(translate(t, '{SYMBOLS}', '')))::bigint as n_symbols,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
         coalesce(covered.n, 0)::bigint as n_repeat_words,
         len(ls)::bigint as n_lines,
         len(list_filter(w, lambda x: x in ({listed})))::bigint as n_stop_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::bigint as n_same_words
  from base left join covered using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {BASE_FAILED} as base_failed, {verdict_sql()} as kept, n_lines, n_stop_words,
       n_same_words
from counts"""
