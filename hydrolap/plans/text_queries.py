"""Text mining over the documents and conversations."""

from pyspark.sql import functions as F

from ..operators import corpus as tx
from .registry import query
from .views import Tables

_CLEAN = r"regexp_replace(lower(text), 'https?://\S+|www\.\S+', '', 'g')"
_TOK = rf"regexp_extract_all({_CLEAN}, '\p{{L}}+')"
_STOP = "(" + ", ".join(f"'{w}'" for w in sorted({w for ws in tx.STOP_WORDS.values() for w in ws})) + ")"
_ROWS = f"SELECT doc_id, unnest(generate_series(0, len(k) - 1)) AS pos, unnest(k) AS token FROM (SELECT doc_id, {_TOK} AS k FROM documents) d"
TOPICS = {"insultos": ["idiot", "stupid", "worthless"], "licencias": ["license", "copyright"], "elogios": ["best", "good"]}


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query("text_clean", views=None, sql=f"SELECT doc_id, {_CLEAN} AS texto FROM documents")
def text_clean(t: Tables):
    return t["documents"].select("doc_id", tx.clean_text("text").alias("texto"))


@query("tokens", views=None, sql=f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM ({_ROWS}) r")
def tokens(t: Tables):
    return tx.token_rows(t["documents"], "doc_id")


@query("tokens_filtered", views=None, sql=f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM ({_ROWS}) r WHERE token NOT IN {_STOP}")
def tokens_filtered(t: Tables):
    return tx.without_stop_words(tx.token_rows(t["documents"], "doc_id"))


@query("tokens_by_frequency", views=None, sql=f"""
WITH r AS ({_ROWS}), f AS (SELECT token, count(DISTINCT doc_id) AS d FROM r GROUP BY token)
SELECT token, count(*) AS n FROM r WHERE token IN (SELECT token FROM f WHERE d >= 0.1::DOUBLE * (SELECT count(*) FROM documents) AND d <= 0.9::DOUBLE * (SELECT count(*) FROM documents))
GROUP BY token""")
def tokens_by_frequency(t: Tables):
    return tx.term_counts(tx.by_document_frequency(tx.token_rows(t["documents"], "doc_id"), "doc_id", t["documents"]))


@query("bigrams", views=None, sql=f"""
SELECT a || ' ' || b AS token, count(*) AS n FROM (SELECT unnest(k[1:len(k) - 1]) AS a, unnest(k[2:len(k)]) AS b FROM (SELECT {_TOK} AS k FROM documents) d WHERE len(k) >= 2) x GROUP BY 1""")
def bigrams(t: Tables):
    pairs = tx.with_tokens(t["documents"].select("text")).select(F.explode(tx.ngrams(F.col("tokens"))).alias("token"))
    return tx.term_counts(pairs)


@query("term_counts", views=None, sql=f"SELECT token, count(*) AS n FROM ({_ROWS}) r WHERE token NOT IN {_STOP} GROUP BY token ORDER BY n DESC, token LIMIT 100")
def term_counts(t: Tables):
    return tx.term_counts(tx.without_stop_words(tx.token_rows(t["documents"], "doc_id")), 100)


_SENT = f"""SELECT doc_id, lang, coalesce(round((len(list_filter(k, lambda x: x IN ({_list(tx.POSITIVE)[1:-1]}))) - len(list_filter(k, lambda x: x IN ({_list(tx.NEGATIVE)[1:-1]}))))::DOUBLE
 / nullif(len(k), 0), 8), 0) AS sentimiento FROM (SELECT doc_id, lang, {_TOK} AS k FROM documents) d"""


def _sentiment(t: Tables):
    return tx.with_tokens(t["documents"].select("doc_id", "lang", "text")).select(
        "doc_id", "lang", F.round(tx.sentiment(F.col("tokens")), 8).alias("sentimiento"))


@query("sentiment_lexicon", views=None, sql=_SENT)
def sentiment_lexicon(t: Tables):
    return _sentiment(t)


@query("sentiment_bins", views=None, sql=f"""
SELECT lang, CASE WHEN sentimiento < 0 THEN 'negativo' WHEN sentimiento > 0 THEN 'positivo' ELSE 'neutro' END AS grupo, count(*) AS n FROM ({_SENT}) s GROUP BY ALL""")
def sentiment_bins(t: Tables):
    return _sentiment(t).groupBy("lang", tx.sentiment_bin(F.col("sentimiento")).alias("grupo")).agg(F.count(F.lit(1)).alias("n"))


@query("topic_counts", views=None, sql=" UNION ALL ".join(
    f"SELECT lang, '{name}' AS tema, count(*) FILTER (WHERE list_has_any({_TOK}, {_list(words)})) AS documentos FROM documents GROUP BY lang" for name, words in TOPICS.items()))
def topic_counts(t: Tables):
    return tx.topic_counts(tx.with_tokens(t["documents"].select("lang", "text")), TOPICS, ["lang"])


@query("mention_counts", views=None, sql=" UNION ALL ".join(
    f"SELECT role, '{name}' AS nombre, count(*) FILTER (WHERE regexp_matches(lower(text), '(^|[^\\p{{L}}]){name}([^\\p{{L}}]|$)')) AS documentos, "
    f"round(1e2 * count(*) FILTER (WHERE regexp_matches(lower(text), '(^|[^\\p{{L}}]){name}([^\\p{{L}}]|$)')) / count(*), 6) AS pct FROM conversations GROUP BY role"
    for name in ("the", "que", "und", "best")))
def mention_counts(t: Tables):
    return tx.mention_counts(t["conversations"], "text", ["the", "que", "und", "best"], ["role"])
