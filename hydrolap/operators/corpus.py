"""Text columns: clean, tokens, n-grams, frequencies, lexicon sentiment, topics, mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import count_if, percentage

# Patterns.
URL = r"https?://\S+|www\.\S+"
WORD = r"\p{L}+"

# Stop words of our own for the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to in a is that it for was on with be as by this are at an from or he".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como".split(),
    "fr": "le de la et les des en un du une que est pour qui dans par plus pas au sur".split(),
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als".split(),
}

# Sentiment lexicon of our own.
POSITIVE = (
    "best good great nice happy clean safe excellent thanks useful bueno buena mejor excelente gracias limpio feliz "
    "bon bonne meilleur merci propre heureux gut beste danke sauber").split()
NEGATIVE = (
    "worthless stupid idiot bad worst dirty unsafe awful hate useless malo mala peor sucio odio horrible inutil "
    "mauvais pire sale idiote schlecht dumm schmutzig nutzlos").split()


def clean_text(c: Column | str) -> Column:
    """Lower case without web addresses."""
    return F.regexp_replace(F.lower(F.col(c) if isinstance(c, str) else c), URL, "")


def tokens(c: Column | str) -> Column:
    """Runs of letters of the cleaned text."""
    return F.regexp_extract_all(clean_text(c), F.lit(WORD), F.lit(0))


def with_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("tokens", tokens(text))


def token_rows(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    return df.select(key, F.posexplode(tokens(text)).alias("pos", "token"))


def without_stop_words(rows: DataFrame, languages: list[str] | None = None) -> DataFrame:
    words = sorted({w for lang in (languages or STOP_WORDS) for w in STOP_WORDS[lang]})
    return rows.where(~F.col("token").isin(words))


def document_frequency(rows: DataFrame, key: str) -> DataFrame:
    """Documents per token; copies inside a document are merged first."""
    return rows.groupBy("token", key).agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(
        F.count(F.lit(1)).alias("documentos"), F.sum("n").alias("n"))


def by_document_frequency(rows: DataFrame, key: str, documents: DataFrame, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Keep tokens found in a share of documents between ``low`` and ``high``."""
    total = documents.agg(F.count(F.lit(1)).alias("_d"))  # one row
    kept = document_frequency(rows, key).join(F.broadcast(total)).where(
        (F.col("documentos") >= low * F.col("_d")) & (F.col("documentos") <= high * F.col("_d"))).select("token")
    return rows.join(kept, "token", "left_semi")


def ngrams(c: Column, n: int = 2) -> Column:
    """Neighbouring tokens joined by a blank: n shifted copies of the row's own array, zipped."""
    width = F.greatest(F.size(c) - n + 1, F.lit(0))
    out = F.slice(c, 1, width)
    for i in range(2, n + 1):
        out = F.zip_with(out, F.slice(c, i, width), lambda a, b: F.concat_ws(" ", a, b))
    return out


def term_counts(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Frequencies, most frequent first; ties by term."""
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "token").limit(limit) if limit else counts


def sentiment(c: Column, positive: list[str] = POSITIVE, negative: list[str] = NEGATIVE) -> Column:
    """(positive - negative) / tokens of a token column; 0 for an empty text."""
    good = F.size(F.filter(c, lambda w: w.isin(positive)))
    bad = F.size(F.filter(c, lambda w: w.isin(negative)))
    return F.coalesce((good - bad).cast("double") / F.nullif(F.size(c).cast("double"), F.lit(0.0)), F.lit(0.0))


def sentiment_bin(score: Column) -> Column:
    return F.when(score < 0, "negativo").when(score > 0, "positivo").otherwise("neutro")


def topic_counts(df: DataFrame, topics: dict[str, list[str]], by: list[str] = ()) -> DataFrame:
    """Documents with at least one keyword of each topic, from one scan over a token column."""
    hits = df.groupBy(*by).agg(*[
        count_if(F.arrays_overlap("tokens", F.array(*[F.lit(w) for w in words]))).alias(name) for name, words in topics.items()])
    return hits.unpivot(list(by), list(topics), "tema", "documentos")


def whole_word(name: str) -> str:
    """Pattern of a name between non-letters; `\\b` differs between regex engines on accented letters."""
    return rf"(^|[^\p{{L}}]){name}([^\p{{L}}]|$)"


def mention_counts(df: DataFrame, text: str, names: list[str], by: list[str] = ()) -> DataFrame:
    """Documents that mention each name as a whole word, in any case."""
    found = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_t"), *[count_if(F.lower(text).rlike(whole_word(n.lower()))).alias(n) for n in names])
    return found.unpivot([*by, "_t"], names, "nombre", "documentos").withColumn(
        "pct", F.round(percentage(F.col("documentos"), F.col("_t")), 6)).drop("_t")
