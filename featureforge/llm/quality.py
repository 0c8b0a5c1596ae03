"""Quality rules: a threshold table compiled into one Spark projection.

Only built-in functions are used: words and lines are arrays, repeated 3-word
windows are found by sorting (hash, position) pairs inside the row, and the
rules of ``RULES`` become one boolean expression.  There is no shuffle, and a
row's work is O(n log n) in its own words.

Defined cases: a null or empty text has no words and fails the base rules;
lines without a word are not lines; extra columns are ignored (the result
holds only the listed columns), so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = " \t\n\x0b\x0c\r"
SEPARATOR_CLASS = "[ \\t-\\r]"
SYMBOLS = "#*$%&|<>"

# Frequent function words of the languages the corpus is meant to
# hold (English, French, German, Spanish).
STOP_WORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be",
    "this", "by", "are", "at", "from",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans",
    "sur", "au", "par", "pas", "avec",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "für", "ist", "im", "nicht",
    "dem", "ein", "eine", "als",
    "el", "y", "los", "se", "del", "las", "por", "con", "no", "una", "para", "su", "es", "al", "lo",
]


@dataclass(frozen=True)
class Rule:
    """Keep rows whose ``num / den`` lies within [low, high]; a zero
    denominator fails the rule when it has a lower bound."""

    name: str
    num: str
    den: str | None
    low: float | None = None
    high: float | None = None

    def ok(self) -> Column:
        den = F.lit(1.0) if self.den is None else F.col(self.den).cast("double")
        num = F.col(self.num).cast("double")
        parts = []
        if self.low is not None:
            parts.append((den > 0) & (num >= den * F.lit(self.low)))
        if self.high is not None:
            parts.append(num <= den * F.lit(self.high))
        return parts[0] if len(parts) == 1 else parts[0] & parts[1]

    def sql(self) -> str:
        den = "1.0e0" if self.den is None else f"CAST({self.den} AS DOUBLE)"
        parts = []
        if self.low is not None:
            parts.append(f"({den} > 0 AND {self.num} >= {den} * {self.low!r}e0)")
        if self.high is not None:
            parts.append(f"{self.num} <= {den} * {self.high!r}e0")
        return "(" + " AND ".join(parts) + ")"


#: The method's thresholds (after the base rules).
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.25),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.02, None),
    Rule("upper_word_ratio", "n_upper_words", "n_words", None, 0.5),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def quality_signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with every count the rules use."""
    base = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    split = base.select(
        id_col, "t",
        F.array_remove(F.split("t", SEPARATOR_CLASS + "+"), "").alias("words"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.btrim(x, F.lit(SEPARATORS))) > 0).alias("lines"))
    grams = split.select(
        id_col, "t", "words", "lines", F.size("words").alias("n"),
        F.when(F.size("words") >= 4, F.sort_array(F.transform(
            F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
            lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("h"),
                                  i.alias("i")))))
        .alias("grams"))
    repeated = grams.select(
        id_col, "t", "words", "lines", "n",
        F.flatten(F.filter(F.zip_with(
            F.slice("grams", F.lit(1), F.greatest(F.col("n") - 3, F.lit(0))),
            F.slice("grams", F.lit(2), F.greatest(F.col("n") - 3, F.lit(0))),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2,
                                                          b["i"], b["i"] + 1, b["i"] + 2))),
            lambda x: x.isNotNull())).alias("at"))
    return repeated.select(
        id_col,
        F.col("n").cast("long").alias("n_words"),
        F.length(_without(F.col("t"), SEPARATORS)).cast("long").alias("word_chars"),
        (F.length("t") - F.length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.size(F.array_distinct("at")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: (w == F.upper(w)) & (w != F.lower(w)))).cast("long").alias("n_upper_words"))


def quality_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES,
                   min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """The signals with ``base_failed``, the names of the rules each document
    breaks (``failed_rules``) and ``kept``."""
    signals = quality_signals(docs, id_col, text_col)
    base_failed = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    kept = ~base_failed
    for r in rules:
        kept = kept & r.ok()
    failed = F.filter(F.array(*[F.when(~r.ok(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return signals.select("*", base_failed.alias("base_failed"), kept.alias("kept"),
                          F.concat_ws(",", failed).alias("failed_rules"))


def oracle_sql() -> str:
    """DuckDB SQL for the contract columns and the verdict."""
    sep = "[ \\t\\n\\x0B\\f\\r]+"
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    rules = " AND ".join(r.sql() for r in RULES)
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{sep}'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS ls FROM t),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM h WHERE c >= 2) GROUP BY doc_id),
s AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '{sep}', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(ls) AS BIGINT) AS n_lines,
        len(list_filter(ws, lambda x: lower(x) IN ({stops}))) AS n_stop_words,
        len(list_filter(ws, lambda x: x = upper(x) AND x <> lower(x))) AS n_upper_words
      FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {rules} AS kept
FROM b
"""
