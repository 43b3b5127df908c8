"""Queries for the text operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelflow.operators import monthly, text, tfidf
from panelflow.plans import bindings as B
from panelflow.plans import oracle as O
from panelflow.plans.registry import query, select
from panelflow.session import materialize

LEXICONS = {"categories": B.CATEGORIES, "positive": B.POSITIVE, "negative": B.NEGATIVE}
_PAGE_TEXT = select("page_id:i text:s", "SELECT * FROM page_text", O.chain(O.PAGE_TEXT))


@query("clean_html", _PAGE_TEXT)
def clean_html(spark, sf):
    return text.clean_html(B.texts(spark, sf, "pages")).select("page_id", "text")


@query("clean_html_auto", _PAGE_TEXT)
def clean_html_auto(spark, sf):
    return text.clean_html(B.texts(spark, sf, "pages"), mode="auto").select("page_id", "text")


@query("clean_html_native", _PAGE_TEXT)
def clean_html_native(spark, sf):
    return text.clean_html(B.texts(spark, sf, "pages"), mode="native").select("page_id", "text")


@query("min_text_filter", select("doc_id:i", "SELECT doc_id FROM documents WHERE length(text) >= 100"))
def min_text_filter(spark, sf):
    return text.min_text_filter(B.table(spark, sf, "documents")).select("doc_id")


@query(
    "normalize_text",
    select("doc_id:i normalized:s", f"SELECT doc_id, {O.normalized('text')} AS normalized FROM marked", O.chain(O.MARKED)),
)
def normalize_text(spark, sf):
    return text.normalize_text(B.marked_texts(spark, sf)).select("doc_id", "normalized")


_MARKED_WORDS = {
    **O.MARKED,
    "w": f"SELECT doc_id, {O.words(O.normalized('text'))} AS words FROM marked",
}


@query("tokenize", select("doc_id:i words:a", "SELECT * FROM w", O.chain(_MARKED_WORDS)))
def tokenize(spark, sf):
    return text.tokenize(text.normalize_text(B.marked_texts(spark, sf))).select("doc_id", "words")


@query(
    "filter_tokens",
    select("doc_id:i tokens:a", f"SELECT doc_id, {O.tokens('words')} AS tokens FROM w", O.chain(_MARKED_WORDS)),
)
def filter_tokens(spark, sf):
    words = text.tokenize(text.normalize_text(B.marked_texts(spark, sf)))
    return text.filter_tokens(words).select("doc_id", "tokens")


@query(
    "min_token_filter",
    select(
        "doc_id:i n:i", "SELECT doc_id, len(tokens) AS n FROM article_tokens", O.chain(O.ARTICLE_TOKENS)
    ),
)
def min_token_filter(spark, sf):
    return text.article_tokens(B.articles(spark, sf), html=None).select("doc_id", F.size("tokens").alias("n"))


@query("lemmatize", select("doc_id:i lemmas:a", "SELECT * FROM lemmas", O.chain(O.ARTICLE_LEMMAS)))
def lemmatize(spark, sf):
    articles = text.article_tokens(B.articles(spark, sf), html=None)
    return text.lemmatize(articles.select("doc_id", "tokens"), "doc_id").select("doc_id", "lemmas")


def _words(spark, sf):
    """Unlemmatized article tokens under the lemma column."""
    articles = text.article_tokens(B.articles(spark, sf), html=None)
    return articles.select("doc_id", F.col("tokens").alias("lemmas"))


_KEYWORDS = " ".join(f"keyword_{c}:i" for c in B.CATEGORIES)


@query(
    "keyword_counts",
    select(
        "doc_id:i " + _KEYWORDS,
        f"SELECT doc_id, {O.keyword_columns('tokens')} FROM article_tokens",
        O.chain(O.ARTICLE_TOKENS),
    ),
)
def keyword_counts(spark, sf):
    return text.keyword_counts(_words(spark, sf), categories=B.CATEGORIES).drop("lemmas")


def _builtin_counts() -> str:
    from panelflow.config import ECONOMIC_KEYWORDS

    return ", ".join(f"{O.present('tokens', w)} AS keyword_{c}" for c, w in ECONOMIC_KEYWORDS.items())


@query(
    "keyword_counts_builtin",
    select(
        "doc_id:i " + _KEYWORDS, f"SELECT doc_id, {_builtin_counts()} FROM article_tokens", O.chain(O.ARTICLE_TOKENS)
    ),
)
def keyword_counts_builtin(spark, sf):
    """The built-in lists, which the given texts hardly meet."""
    return text.keyword_counts(_words(spark, sf)).drop("lemmas")


@query(
    "sentiment_score",
    select(
        "doc_id:i sentiment_score:f",
        f"SELECT doc_id, {O.present('tokens', B.POSITIVE)} AS p, {O.present('tokens', B.NEGATIVE)} AS n, "
        "CASE WHEN p + n = 0 THEN 0.0 ELSE (p - n) / (p + n) END AS sentiment_score FROM article_tokens",
        O.chain(O.ARTICLE_TOKENS),
    ),
)
def sentiment_score(spark, sf):
    scored = text.sentiment_score(_words(spark, sf), positive=B.POSITIVE, negative=B.NEGATIVE)
    return scored.select("doc_id", "sentiment_score")


_STATS = "text_length:i token_count:i unique_words:i vocabulary_richness:f sentiment_score:f clean_text:s"


def _articles(spark, sf):
    return text.article_features(B.articles(spark, sf), key="doc_id", html=None, **LEXICONS)


@query(
    "text_stats", select("doc_id:i " + _STATS, "SELECT * FROM features", O.chain(O.ARTICLE_FEATURES))
)
def text_stats(spark, sf):
    articles = text.article_tokens(B.articles(spark, sf), html=None).select("doc_id", "text", "tokens")
    lemmas = text.lemmatize(articles, "doc_id")
    scored = text.sentiment_score(lemmas, positive=B.POSITIVE, negative=B.NEGATIVE)
    return text.text_stats(scored).drop("text", "tokens", "lemmas")


@query(
    "article_features",
    select(
        "html_path:s source:s url:s published:s title:s " + _STATS + " " + _KEYWORDS,
        "SELECT * FROM features",
        O.chain(O.PAGE_FEATURES),
    ),
)
def article_features(spark, sf):
    """Raw HTML pages to feature rows."""
    return text.article_features(B.raw_pages(spark, sf), **LEXICONS)


def _corpus(spark, sf):
    docs = _articles(spark, sf).select("doc_id", "token_count", "clean_text")
    return materialize(tfidf.eligible(docs))


@query(
    "tfidf_vocabulary",
    select("term:s df:i total:i idf:f", "SELECT * FROM vocabulary", O.chain(O.TERMS)),
)
def tfidf_vocabulary(spark, sf):
    return tfidf.tfidf_vocabulary(_corpus(spark, sf), "doc_id")


@query(
    "tfidf_weights",
    select(
        "doc_id:i term:s tf:i weight:f",
        "SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw_weights",
        O.chain(O.TERMS),
    ),
)
def tfidf_weights(spark, sf):
    corpus = _corpus(spark, sf)
    vocabulary = materialize(tfidf.tfidf_vocabulary(corpus, "doc_id"))
    return tfidf.tfidf_weights(corpus, vocabulary, "doc_id")


@query(
    "tfidf_mean", select("doc_id:i tfidf_mean:f", "SELECT * FROM complete", O.chain(O.TERMS))
)
def tfidf_mean(spark, sf):
    docs = _articles(spark, sf).select("doc_id", "token_count", "clean_text")
    return tfidf.corpus_features(docs, "doc_id").select("doc_id", "tfidf_mean")


# More terms than stand in a plan, so that the joined way is taken.
LONG_VOCABULARY = 20_000
_LONG_TERMS = O.chain({**O.TERMS, "vocabulary": O.TERMS["vocabulary"].replace("LIMIT 1000", f"LIMIT {LONG_VOCABULARY}")})


@query(
    "tfidf_weights_long",
    select(
        "doc_id:i term:s tf:i weight:f",
        "SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw_weights",
        _LONG_TERMS,
    ),
)
def tfidf_weights_long(spark, sf):
    corpus = _corpus(spark, sf)
    vocabulary = materialize(tfidf.tfidf_vocabulary(corpus, "doc_id", max_features=LONG_VOCABULARY))
    return tfidf.tfidf_weights(corpus, vocabulary, "doc_id")


@query("tfidf_mean_long", select("doc_id:i tfidf_mean:f", "SELECT * FROM complete", _LONG_TERMS))
def tfidf_mean_long(spark, sf):
    docs = materialize(_articles(spark, sf).select("doc_id", "token_count", "clean_text"))
    return tfidf.tfidf_mean(docs, "doc_id", max_features=LONG_VOCABULARY).select("doc_id", "tfidf_mean")


@query(
    "parse_published",
    select(
        "doc_id:i published_at:t year_month:s",
        "SELECT doc_id, try_cast(published AS TIMESTAMP) AS published_at, "
        "strftime(try_cast(published AS TIMESTAMP), '%Y-%m') AS year_month FROM articles "
        "WHERE try_cast(published AS TIMESTAMP) IS NOT NULL",
        O.chain(O.ARTICLES),
    ),
)
def parse_published(spark, sf):
    return monthly.parse_published(B.articles(spark, sf)).select("doc_id", "published_at", "year_month")


def scored_articles(spark, sf):
    return tfidf.corpus_features(_articles(spark, sf), "doc_id").drop("clean_text")


def monthly_features(spark, sf):
    return monthly.monthly_text_features(monthly.parse_published(scored_articles(spark, sf)))


MONTHLY_OUT = (
    "text_sentiment_score:f text_tfidf_mean:f text_vocabulary_richness:f "
    + " ".join(f"text_keyword_{c}:i" for c in B.CATEGORIES)
    + " text_article_count:i"
)


@query(
    "monthly_text_features",
    select("year_month:s " + MONTHLY_OUT, "SELECT * FROM monthly", O.chain(O.MONTHLY)),
)
def monthly_text_features(spark, sf):
    return monthly_features(spark, sf)


_TOTALS = ", ".join(f"sum(keyword_{c}) AS {c}_total" for c in B.CATEGORIES)


@query(
    "text_summary",
    select(
        "articles:i total_tokens:i avg_tokens:f avg_sentiment:f months:i avg_articles_per_month:f keyword_totals:s",
        "SELECT articles, total_tokens, avg_tokens, avg_sentiment, months, per_month AS avg_articles_per_month, "
        + " || ' ' || ".join(f"'keyword_{c}=' || {c}_total" for c in B.CATEGORIES)
        + " AS keyword_totals FROM (SELECT count(*) AS articles, sum(token_count) AS total_tokens, "
        f"avg(token_count) AS avg_tokens, {O.exact_mean('sentiment_score')} AS avg_sentiment, {_TOTALS} FROM complete), "
        "(SELECT count(*) AS months, avg(text_article_count) AS per_month FROM monthly)",
        O.chain(O.MONTHLY),
    ),
)
def text_summary(spark, sf):
    articles = scored_articles(spark, sf)
    dated = monthly.parse_published(articles)
    summary = monthly.text_summary(articles, monthly.monthly_text_features(dated))
    printed = F.transform(
        "keyword_totals", lambda k: F.concat_ws("=", k["keyword"], k["total"].cast("string"))
    )
    return summary.withColumn("keyword_totals", printed)
