"""Text operators: page tables to per-article features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelflow import config
from panelflow.functions import html as H
from panelflow.functions import text as T
from panelflow.functions.lookup import looked_up, lookup_table
from panelflow.functions.markup import visible_text
from panelflow.functions.numbers import half_even
from panelflow.functions.once import with_computed
from panelflow.session import materialize, numbered, rows_up_to

# Noun endings and what replaces them.
NOUN_ENDINGS = [
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]

# Dictionaries up to this many forms (a few megabytes) are looked up in place.
DICTIONARY_LIMIT = 100_000


def clean_html(df: DataFrame, html: str = "html", out: str = "text", mode: str = "scan") -> DataFrame:
    """Visible text of a page, without a Python worker.

    ``scan``, the default, reads any markup: nested, unclosed or crossing dropped elements, quoted ``>``,
    every character reference.  ``native`` is a shorter chain of regular expressions for pages
    known to be regular (``functions.html.is_irregular`` tells); ``auto`` tests each page and takes the
    chain or the scan, with the same result as ``scan`` and no gain on the pages measured.
    """
    if mode not in ("scan", "native", "auto"):
        raise ValueError(f"unknown mode: {mode}")
    columns = [c for c in df.columns if c != out]
    if mode == "scan":
        return with_computed(df, **{out: visible_text(html)}).select(*columns, out)
    staged = (
        df.withColumn("_lexed", H.without_scripts(F.col(html)))
        .withColumn("_stripped", H.without_subtrees(F.col("_lexed")))
        .withColumn("_untagged", H.without_tags(F.col("_stripped")))
    )
    text = H.native_text(F.col("_untagged"))
    if mode == "auto":
        irregular = H.is_irregular(*[F.col(c) for c in (html, "_lexed", "_stripped", "_untagged")])
        text = F.when(irregular, visible_text(html)).otherwise(text)
    return with_computed(staged, **{out: text}).select(*columns, out)


def min_text_filter(df: DataFrame, text: str = "text", n: int = config.MIN_TEXT_CHARS) -> DataFrame:
    return df.filter(F.char_length(text) >= n)


def normalize_text(
    df: DataFrame, text: str = "text", out: str = "normalized", fold_accents: bool = False
) -> DataFrame:
    return df.withColumn(out, T.normalized(F.col(text), fold_accents))


def tokenize(df: DataFrame, text: str = "normalized", out: str = "words") -> DataFrame:
    return df.withColumn(out, T.word_tokens(F.col(text)))


def filter_tokens(
    df: DataFrame,
    words: str = "words",
    out: str = "tokens",
    stop_words: Sequence[str] | None = None,
    min_length: int = 3,
) -> DataFrame:
    return df.withColumn(out, T.content_tokens(F.col(words), stop_words, min_length))


def min_token_filter(df: DataFrame, tokens: str = "tokens", n: int = config.MIN_TOKENS) -> DataFrame:
    return df.filter(F.size(tokens) >= n)


def base_forms(word: Column) -> Column:
    """Candidate base forms of a word by the noun endings."""
    candidates = [
        F.when(
            F.endswith(word, F.lit(ending)),
            F.concat(F.substring(word, F.lit(1), F.length(word) - len(ending)), F.lit(repl)),
        )
        for ending, repl in NOUN_ENDINGS
    ]
    return F.filter(F.array(*candidates), lambda c: c.isNotNull() & (c != ""))


def may_change(word: Column) -> Column:
    """Whether any noun ending applies; all other words are their own lemma."""
    return F.endswith(word, F.lit("s")) | F.endswith(word, F.lit("men"))


def corpus_words(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Distinct words of a corpus, reduced per task before the shuffle."""
    return df.select(F.explode(tokens).alias("word")).distinct()


def lemma_dictionary(words: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """``(form, lemma)`` for the words whose lemma differs from the word.

    A base form counts only if the lexicon holds it; so does the word itself.  The
    shortest accepted form wins, then the alphabetically first.  The default lexicon is
    the set of words itself.
    """
    known = (words if lexicon is None else lexicon).select(F.col("word").alias("candidate"))
    forms = words.filter(may_change(F.col("word"))).select(F.col("word").alias("form"))
    candidates = forms.select(
        "form",
        F.explode(F.array_distinct(F.array_append(base_forms(F.col("form")), F.col("form")))).alias(
            "candidate"
        ),
    )
    return (
        candidates.join(known.distinct() if lexicon is not None else known, "candidate", "left_semi")
        .groupBy("form")
        .agg(F.min(F.struct(F.length("candidate").alias("n"), F.col("candidate"))).alias("best"))
        .select("form", F.col("best.candidate").alias("lemma"))
        .filter("form <> lemma")
    )


def _lemmas_by_table(df: DataFrame, dictionary: DataFrame, tokens: str, out: str, size: int) -> DataFrame:
    buckets = max(size, 1)
    table = F.col("_table")
    return (
        df.withColumn("_table", lookup_table(dictionary, "form", "lemma", buckets))
        .withColumn(out, F.transform(tokens, lambda t: F.coalesce(looked_up(table, t, buckets), t)))
        .drop("_table")
    )


def _lemmas_by_join(df: DataFrame, dictionary: DataFrame, tokens: str, out: str, limit: int) -> DataFrame:
    """Frequent words are looked up in place and only rare ones are joined.

    The ``limit`` most frequent words of the texts, listed in the dictionary or not, form
    the table, so no word left for the join fills more than a ``limit``-th of the tokens.
    Rows that need no join get a key of their own and are spread evenly.  Tokens are then
    gathered per row, by a number written with it, so rows that share a key stay apart; all
    other columns ride on the first token.
    """
    df, row = numbered(df), "_row"
    frequent = (
        df.select(F.explode(tokens).alias("form"))
        .groupBy("form")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "form")
        .limit(limit)
    )
    hot = materialize(
        frequent.join(dictionary, "form", "left").select("form", F.coalesce("lemma", "form").alias("lemma"))
    )
    buckets = max(limit, 1)
    rest = [c for c in df.columns if c not in (row, out)]
    first = F.col("_pos").isNull() | (F.col("_pos") == 0)
    # Starts with a space, so it equals no token.
    alone = F.concat(F.lit(" "), F.xxhash64(row, "_pos").cast("string"))
    spread = (
        df.select(row, F.struct(*rest).alias("_rest"), F.posexplode_outer(tokens).alias("_pos", "_token"))
        .select(
            row,
            "_pos",
            "_token",
            F.when(first, F.col("_rest")).alias("_rest"),
            looked_up(lookup_table(hot, "form", "lemma", buckets), F.col("_token"), buckets).alias("_hot"),
        )
        .withColumn("_form", F.coalesce(F.when(F.col("_hot").isNull(), F.col("_token")), alone))
    )
    joined = spread.join(dictionary, spread["_form"] == dictionary["form"], "left")
    word = F.struct("_pos", F.coalesce("_hot", "lemma", "_token").alias("w"))
    return (
        joined.groupBy(row)
        .agg(
            F.first("_rest", ignorenulls=True).alias("_rest"),
            F.sort_array(F.collect_list(F.when(F.col("_token").isNotNull(), word))).alias("_l"),
        )
        .select("_rest.*", F.col("_l.w").alias(out))
    )


def apply_lemmas(
    df: DataFrame,
    dictionary: DataFrame,
    key: str,
    tokens: str = "tokens",
    out: str = "lemmas",
    limit: int = DICTIONARY_LIMIT,
) -> DataFrame:
    """Replace tokens by their lemma, keeping order, repeats and rows, also of repeated or null keys.

    The dictionary is counted first.  Up to ``limit`` forms it is looked up in place, and
    documents are not shuffled; beyond that rare words are looked up by a join.
    """
    dictionary = dictionary.groupBy("form").agg(F.min("lemma").alias("lemma"))
    size = rows_up_to(dictionary, limit)
    if size is not None:
        return _lemmas_by_table(df, dictionary, tokens, out, size)
    return _lemmas_by_join(df, dictionary, tokens, out, limit)


def lemmatize(
    df: DataFrame,
    key: str,
    tokens: str = "tokens",
    out: str = "lemmas",
    lexicon: DataFrame | None = None,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Noun lemmas per token.

    Give a ``dictionary(form, lemma)`` to use it as it is, or a ``lexicon(word)`` to
    derive one; with neither, the corpus' own words are the lexicon.  To derive one,
    ``df`` and its words are written first, so that tokens are made once though read twice or more;
    the dictionary is written too, then counted and read from there.
    """
    if dictionary is None:
        df = materialize(df)
        dictionary = materialize(lemma_dictionary(materialize(corpus_words(df, tokens)), lexicon))
    return apply_lemmas(df, dictionary, key, tokens, out)


def lemmatized(words: Sequence[str], dictionary: DataFrame) -> list[str]:
    """A word list in lemmas; reads back at most one row per listed word."""
    listed = dictionary.filter(F.col("form").isin(list(words))).groupBy("form").agg(F.min("lemma"))
    known = {form: lemma for form, lemma in listed.collect()}
    return list(dict.fromkeys(known.get(w, w) for w in words))


def keyword_counts(
    df: DataFrame,
    lemmas: str = "lemmas",
    categories: Mapping[str, Sequence[str]] | None = None,
    count: str = "presence",
    phrases: bool = False,
) -> DataFrame:
    """``keyword_<category>``: distinct listed words present (or ``count="occurrences"``).

    With ``phrases`` two-word entries are matched against adjacent tokens too.
    """
    categories = config.ECONOMIC_KEYWORDS if categories is None else categories
    measure = {"presence": T.words_present, "occurrences": T.words_counted}[count]
    words = F.col(lemmas)
    if phrases:
        words = F.concat(words, T.adjacent_pairs(words))
    return df.withColumns({f"keyword_{c}": measure(words, listed) for c, listed in categories.items()})


def sentiment_score(
    df: DataFrame,
    lemmas: str = "lemmas",
    positive: Sequence[str] = config.POSITIVE_WORDS,
    negative: Sequence[str] = config.NEGATIVE_WORDS,
    out: str = "sentiment_score",
) -> DataFrame:
    words = F.col(lemmas)
    return (
        df.withColumn("_p", T.words_present(words, positive))
        .withColumn("_n", T.words_present(words, negative))
        .withColumn(out, T.polarity(F.col("_p"), F.col("_n")))
        .drop("_p", "_n")
    )


def text_stats(
    df: DataFrame, text: str | None = "text", tokens: str = "tokens", lemmas: str = "lemmas"
) -> DataFrame:
    """Length, counts, richness, rounded sentiment and the lemma text.

    With ``text=None`` the table already has ``text_length``.
    """
    n = F.size(tokens)
    if text is not None:
        df = df.withColumn("text_length", F.char_length(text))
    return (
        df.withColumn("token_count", n)
        .withColumn("unique_words", F.size(F.array_distinct(lemmas)))
        .withColumn(
            "vocabulary_richness",
            F.when(n > 0, half_even(F.col("unique_words") / n)).otherwise(F.lit(0.0)),
        )
        .withColumn("sentiment_score", half_even(F.col("sentiment_score")))
        .withColumn("clean_text", F.array_join(lemmas, " "))
    )


def article_tokens(
    pages: DataFrame,
    html: str | None = "html",
    mode: str = "scan",
    stop_words: Sequence[str] | None = None,
    fold_accents: bool = False,
) -> DataFrame:
    """Clean, gate, normalise and tokenize: the narrow half of the article pipeline.

    With ``html=None`` the table already has clean ``text``.
    """
    df = pages if html is None else clean_html(pages, html, mode=mode).drop(html)
    words = T.word_tokens(T.normalized(F.col("text"), fold_accents))
    tokens = T.content_tokens(words, stop_words)
    return min_token_filter(with_computed(min_text_filter(df), tokens=tokens))


def article_features(
    pages: DataFrame,
    key: str = "html_path",
    html: str | None = "html",
    mode: str = "scan",
    stop_words: Sequence[str] | None = None,
    categories: Mapping[str, Sequence[str]] | None = None,
    positive: Sequence[str] = config.POSITIVE_WORDS,
    negative: Sequence[str] = config.NEGATIVE_WORDS,
    lexicon: DataFrame | None = None,
    dictionary: DataFrame | None = None,
    fold_accents: bool = False,
    count: str = "presence",
    phrases: bool = False,
    lemmatize_lexicon: bool = False,
) -> DataFrame:
    """One feature row per page that passes the length and token gates.

    Without a dictionary the tokens are written once, so pages are parsed only once
    although the corpus words and the features are two passes.  ``lemmatize_lexicon``
    also puts the listed words into their lemma, so that plural entries can match.
    """
    labels = ("url", "published", "title")
    categories = config.ECONOMIC_KEYWORDS if categories is None else categories
    df = article_tokens(pages, html, mode, stop_words, fold_accents)
    df = df.select(
        key,
        F.coalesce("source", F.lit("unknown")).alias("source"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in labels],
        F.char_length("text").alias("text_length"),
        "tokens",
    )
    if dictionary is None:
        df = materialize(df)
        dictionary = materialize(lemma_dictionary(materialize(corpus_words(df)), lexicon))
    if lemmatize_lexicon:
        positive, negative = (lemmatized(w, dictionary) for w in (positive, negative))
        categories = {c: lemmatized(w, dictionary) for c, w in categories.items()}
    df = apply_lemmas(df, dictionary, key)
    df = keyword_counts(df, categories=categories, count=count, phrases=phrases)
    df = sentiment_score(df, positive=positive, negative=negative)
    df = text_stats(df, text=None)
    return df.select(
        key,
        "source",
        *labels,
        "text_length",
        "token_count",
        "unique_words",
        "vocabulary_richness",
        "sentiment_score",
        "clean_text",
        *[f"keyword_{c}" for c in categories],
    )
