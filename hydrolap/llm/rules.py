"""Quality rules: a threshold table compiled into one projection of length, symbol, stop-word and line ratios.

Every measure is a Spark expression over the row, so the whole operator is one scan without a shuffle.
Windows of a text are compared by their 64-bit hash, and positions of repeated windows come from a sort inside
the row; a text of n words costs n log n, and the sort runs only where some window repeats.

Edge cases: a null or empty text has no words and fails the base rule; repeated rows are judged each for itself;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE_CLASS

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Function words of our own choice for the four languages.
STOP_WORDS = (
    "the of and to in a is that it for was on with be as by this are at an from or he "
    "de la que el en y los se del las un por con no una su para es al lo como "
    "le et les des du une est pour qui dans par plus pas au sur "
    "der die und den von zu das mit sich auf ist im dem nicht ein eine für").split()


@dataclass(frozen=True)
class Rule:
    """A measure must lie in [low, high]; texts under ``min_words`` words are too short to be judged by it."""

    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


RULES = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbols_per_word", high=0.1),
    Rule("exclamations_per_word", high=0.25),
    Rule("capitals_per_char", high=0.4),
    Rule("stop_word_ratio", low=0.05, min_words=50),
    Rule("duplicate_line_ratio", high=0.5),
)


def stop_word_forms() -> list[str]:
    """Stop words as they stand in a text: lower, capitalised and upper case, bare or before a mark."""
    return sorted({form + mark for w in STOP_WORDS for form in (w, w.capitalize(), w.upper()) for mark in ("", ",", ".", "!!")})


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; ``hashes`` has one value per window."""
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(a: Column) -> Column:
        n = F.size(a)
        twice = F.filter(a, lambda x, k: ((k > 0) & (F.get(a, k - 1)["h"] == x["h"])) | ((k < n - 1) & (F.get(a, k + 1)["h"] == x["h"])))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct((acc["words"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("words"), i.alias("last")),
            lambda acc: acc["words"])

    return F.get(F.transform(F.array(ordered), covered), F.lit(0))


def measure(docs: DataFrame) -> DataFrame:
    """One row per document with the counts and ratios that the rules speak of, and ``source``, the row as it came."""
    words = F.array_remove(F.split("text", SPACE_CLASS), "")
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.struct("*").alias("source"))
    split = given.select("doc_id", "text", "source", words.alias("words"), lines.alias("lines"))
    windows = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    counted = split.select(
        "doc_id", "source", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length("text").alias("chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^!]+", "")).alias("exclamations"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).alias("capitals"),
        F.size(F.filter("words", lambda w: w.isin(stop_word_forms()))).alias("stop_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"))
    repeated = F.when(F.size("windows") > F.size(F.array_distinct("windows")), _repeated_words(F.col("windows"))).otherwise(F.lit(0))
    n = F.greatest(F.col("n_words"), F.lit(1))
    return counted.select(
        "doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated.cast("long").alias("n_repeat_words"),
        (F.col("word_chars") / n).alias("mean_word_chars"), (F.col("n_symbols") / n).alias("symbols_per_word"),
        (F.col("exclamations") / n).alias("exclamations_per_word"),
        (F.col("capitals") / F.greatest(F.col("chars"), F.lit(1))).alias("capitals_per_char"),
        (F.col("stop_words") / n).alias("stop_word_ratio"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("duplicate_line_ratio"))


def passes(rules: tuple[Rule, ...]) -> Column:
    """The table as one boolean expression."""
    def one(rule: Rule) -> Column:
        value = F.col(rule.measure)
        inside = [value >= rule.low] * (rule.low is not None) + [value <= rule.high] * (rule.high is not None)
        return reduce(lambda a, b: a & b, inside, F.lit(True)) | (F.col("n_words") < rule.min_words)

    return reduce(lambda a, b: a & b, map(one, rules), F.lit(True))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures of every document, ``base_failed`` and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    measured = measure(docs)
    return measured.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & passes(rules))


def judge_sql(rules: tuple[Rule, ...] = RULES, table: str = "documents") -> str:
    """DuckDB SQL for ``judge``."""
    checks = " AND ".join(
        "(" + " AND ".join([f"{r.measure} >= {r.low}"] * (r.low is not None) + [f"{r.measure} <= {r.high}"] * (r.high is not None))
        + f" OR n_words < {r.min_words})" for r in rules)
    stop = ", ".join(f"'{w}'" for w in stop_word_forms())
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {table}),
s AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
w AS (SELECT r, i, list_slice(words, i, i + {WINDOW - 1}) AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM s WHERE len(words) >= {WINDOW})),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM w) WHERE n > 1),
p AS (SELECT r, sum(least({WINDOW}, i - coalesce(last, i - {WINDOW}))) AS repeated
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS last FROM t) GROUP BY r),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(list_aggregate(list_concat([''], words), 'string_agg', '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated, 0) AS BIGINT) AS n_repeat_words,
  length(regexp_replace(text, '[^!]+', '', 'g')) AS exclamations, length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g')) AS capitals,
  length(text) AS chars, len(list_filter(words, lambda x: x IN ({stop}))) AS stop_words, len(lines) AS n_lines
  FROM s LEFT JOIN p USING (r)),
q AS (SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbols_per_word,
  exclamations / greatest(n_words, 1) AS exclamations_per_word, capitals / greatest(chars, 1) AS capitals_per_char,
  stop_words / greatest(n_words, 1) AS stop_word_ratio, n_dup_lines / greatest(n_lines, 1) AS duplicate_line_ratio,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {checks} AS kept FROM q"""
