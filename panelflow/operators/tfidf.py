"""TF-IDF over a corpus as long tables; nothing is densified."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflow import config
from panelflow.functions.lookup import looked_up, lookup_table
from panelflow.functions.numbers import one_row
from panelflow.functions.text import adjacent_pairs
from panelflow.session import materialize, numbered

# Up to this many terms may stand in a plan as literals (looked up as a hash set).
LITERAL_WORDS = 5_000
# Bits of the filter that tells words which may be frequent, 512 KB whatever it holds, and bits per word.
FILTER_BITS, FILTER_HASHES = 1 << 22, 3
# Terms of a long vocabulary that are looked up in every task, the most widespread ones; others are joined.
HOT_TERMS, HOT_CHARS = 50_000, 200


def document_words(text: Column) -> Column:
    """Words of two or more characters."""
    return F.filter(F.split(text, r"\W+"), lambda t: F.length(t) >= 2)


def document_terms(words: Column, ngram: tuple[int, int] = (1, 2)) -> Column:
    """Unigrams, pairs of neighbours, or both.  ``words`` should be a plain column: it is
    used often."""
    if ngram == (1, 1):
        return words
    if ngram == (2, 2):
        return adjacent_pairs(words)
    if ngram == (1, 2):
        return F.concat(words, adjacent_pairs(words))
    raise ValueError("ngram must be (1, 1), (2, 2) or (1, 2)")


def _with_sorted_terms(
    docs: DataFrame,
    text: str,
    ngram: tuple[int, int],
    only_terms: Sequence[str] | None = None,
) -> DataFrame:
    """Adds ``_s``, the sorted terms of each document, repeats included; ``only_terms`` keeps listed ones."""
    df = docs.withColumn("_words", document_words(F.col(text)))
    terms = document_terms(F.col("_words"), ngram)
    if only_terms is not None:
        terms = F.filter(terms, lambda t: t.isin(list(only_terms)))
    return df.withColumn("_s", F.sort_array(terms)).drop("_words")


def _shifted() -> Column:
    """The sorted terms moved one place, so that each is opposite its successor."""
    return F.concat(F.array(F.lit("")), F.col("_s"))


def _with_frequencies(sorted_terms: DataFrame) -> DataFrame:
    """Turns ``_s`` into ``_runs``, an array of ``(term, tf)``.

    A document is one row, so its terms are counted in place: find where runs of equal
    terms start, and take the distance between starts.
    """
    heads = F.zip_with("_s", _shifted(), lambda term, before: F.when(term != before, term))
    starts = F.filter(
        F.transform(
            heads, lambda t, i: F.when(t.isNotNull(), F.struct(i.alias("at"), t.alias("term")))
        ),
        lambda run: run.isNotNull(),
    )
    ends = F.concat(F.slice("_starts.at", F.lit(2), F.size("_starts")), F.array(F.size("_s")))
    runs = F.zip_with(
        "_starts",
        ends,
        lambda run, end: F.struct(run["term"].alias("term"), (end - run["at"]).alias("tf")),
    )
    return (
        sorted_terms.withColumn("_starts", starts)
        .withColumn("_runs", F.filter(runs, lambda run: run["term"].isNotNull()))
        .drop("_s", "_starts")
    )


def term_frequencies(
    docs: DataFrame,
    key: str,
    text: str = "clean_text",
    ngram: tuple[int, int] = (1, 2),
) -> DataFrame:
    """``(key, term, tf)`` without a shuffle."""
    counted = _with_frequencies(_with_sorted_terms(docs.select(key, text), text, ngram))
    # Not inline(): Spark would test its array for emptiness below, and compute it there once more.
    return counted.select(key, F.inline_outer("_runs")).filter("term IS NOT NULL")


def _places(word: Column) -> list[Column]:
    """The bits of a word."""
    return [F.pmod(F.xxhash64(F.lit(k), word), F.lit(FILTER_BITS)) for k in range(FILTER_HASHES)]


def _word_filter(words: DataFrame) -> Column:
    """A Bloom filter over column ``term``: one array of longs, a subquery of the plan that uses it.

    Its size does not depend on the words; with more of them more others pass.
    """
    place = F.col("place")
    found = words.select(F.explode(F.array(*_places(F.col("term")))).alias("place"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    longs = found.groupBy(F.floor(place / 64).alias("slot")).agg(F.bit_or(one).alias("bits"))
    slots = words.sparkSession.range(FILTER_BITS // 64).withColumnRenamed("id", "slot").join(longs, "slot", "left")
    dense = F.sort_array(F.collect_list(F.struct("slot", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return slots.agg(dense.alias("all")).select(F.col("all.bits")).scalar()


def _may_hold(bits: Column, word: Column) -> Column:
    """False only for words that are not in the filter."""
    tests = [F.getbit(F.get(bits, F.floor(p / 64).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1 for p in _places(word)]
    return reduce(and_, tests)


def term_totals(
    docs: DataFrame,
    text: str = "clean_text",
    ngram: tuple[int, int] = (1, 2),
    frequent: DataFrame | None = None,
) -> DataFrame:
    """``(term, df, total)``; counts are combined per task before the shuffle by term.

    In sorted order a term differs from the one before it once per document.  Of pairs, only those of two
    words in ``frequent`` (column ``term``) need be right; a few others are counted too.
    """
    terms = (
        _with_sorted_terms(docs.select(text), text, ngram)
        .select(F.inline_outer(F.arrays_zip(F.col("_s"), _shifted())).alias("term", "before"))
        .filter(F.col("term").isNotNull())
    )
    if frequent is not None:
        bits = _word_filter(frequent)
        terms = terms.filter(_may_hold(bits, F.substring_index("term", " ", 1)) & _may_hold(bits, F.substring_index("term", " ", -1)))
    return (
        terms
        .groupBy("term")
        .agg(
            F.count_if(F.col("term") != F.col("before")).alias("df"),
            F.count(F.lit(1)).alias("total"),
        )
    )


def eligible(docs: DataFrame, min_tokens: int = config.MIN_TFIDF_TOKENS) -> DataFrame:
    """Documents long enough to be part of the corpus."""
    return docs.filter(F.col("token_count") >= min_tokens)


def tfidf_vocabulary(
    docs: DataFrame,
    key: str,
    text: str = "clean_text",
    max_features: int = config.MAX_TERMS,
    min_df: int = 1,
    max_df: float = config.MAX_DOCUMENT_SHARE,
    ngram: tuple[int, int] = (1, 2),
) -> DataFrame:
    """``(term, df, total, idf)`` of the kept terms, ties by term.

    With pairs, single words are counted first.  A pair is no more frequent than either
    of its words, so once ``max_features`` words qualify, only pairs of words that reach
    the last one's total can enter the vocabulary: far fewer rows than all pairs.  Those words are
    told by a filter of fixed size that knows all of them and few others, and the pairs that
    pass are counted exactly.  No word comes to the driver.
    """
    documents = one_row(docs, F.count(F.lit(1)).alias("n"))["n"]
    qualifies = (F.col("df") >= min_df) & (F.col("df") <= documents * F.lit(max_df))
    largest_first = [F.desc("total"), F.col("term")]
    if ngram == (1, 2):
        words = materialize(term_totals(docs, text, (1, 1)))
        reach = words.filter(qualifies).orderBy(*largest_first).limit(max_features).agg(
            F.when(F.count(F.lit(1)) == max_features, F.min("total")).alias("reach")
        )
        frequent = words.filter(F.col("total") >= F.coalesce(reach.scalar(), F.lit(0)))
        pairs = term_totals(docs, text, (2, 2), frequent)
        totals = words.unionByName(pairs)
    else:
        totals = term_totals(docs, text, ngram)
    return (
        totals.filter(qualifies)
        .orderBy(*largest_first)
        .limit(max_features)
        .withColumn("idf", F.log((F.lit(1.0) + documents) / (F.lit(1.0) + F.col("df"))) + 1.0)
    )


def _listed_terms(vocabulary: DataFrame) -> list[str] | None:
    """The terms of a short vocabulary, ``None`` for one beyond ``LITERAL_WORDS``."""
    rows = vocabulary.select("term").limit(LITERAL_WORDS + 1).collect()
    return [r["term"] for r in rows] if len(rows) <= LITERAL_WORDS else None


def _with_weights(
    docs: DataFrame, vocabulary: DataFrame, terms: Sequence[str], text: str, ngram: tuple[int, int]
) -> DataFrame:
    """Adds ``_weights``, an array of ``(term, tf, w)``, and its sum and length.

    All in place: a document keeps its row, so nothing is exploded, joined or shuffled.
    """
    buckets = max(len(terms), 1)

    def weight(run: Column) -> Column:
        idf = looked_up(F.col("_table"), run["term"], buckets)
        return F.struct(
            run["term"].alias("term"), run["tf"].alias("tf"), (run["tf"] * idf).alias("w")
        )

    sums = F.aggregate(
        "_weights",
        F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
        lambda acc, r: F.struct(
            (acc["s"] + r["w"]).alias("s"), (acc["q"] + r["w"] * r["w"]).alias("q")
        ),
    )
    return (
        _with_frequencies(_with_sorted_terms(docs, text, ngram, only_terms=terms))
        .withColumn("_table", lookup_table(vocabulary, "term", "idf", buckets))
        .withColumn("_weights", F.transform("_runs", weight))
        .drop("_runs", "_table")
        .withColumn("_sums", sums)
        .withColumn("_sum", F.col("_sums.s"))
        .withColumn("_norm", F.sqrt("_sums.q"))
        .drop("_sums")
    )


def _joined_weights(
    docs: DataFrame, vocabulary: DataFrame, key: str, text: str, ngram: tuple[int, int]
) -> DataFrame:
    """``(key, term, tf, w)`` for vocabularies too long to stand in a plan.

    A term that a large share of the documents holds is among the ``HOT_TERMS`` most widespread,
    which are looked up where the documents are; only rows of other terms are dealt by term, and
    no document is read for them if there are none.
    """
    entries = vocabulary.select("term", "idf", "df")
    short = entries.filter(F.length("term") <= HOT_CHARS)
    hot = F.broadcast(short.orderBy(F.desc("df"), "term").limit(HOT_TERMS))
    rare = entries.join(hot, "term", "left_anti").filter("term IS NOT NULL")
    frequencies = term_frequencies(docs, key, text, ngram)
    found = frequencies.join(hot, "term")
    if not rare.isEmpty():
        found = found.unionByName(frequencies.join(hot, "term", "left_anti").join(rare, "term"))
    return found.select(key, "term", "tf", (F.col("tf") * F.col("idf")).alias("w"))


def tfidf_weights(
    docs: DataFrame,
    vocabulary: DataFrame,
    key: str,
    text: str = "clean_text",
    ngram: tuple[int, int] = (1, 2),
) -> DataFrame:
    """``(key, term, tf, weight)`` with unit Euclidean length per document.

    A short vocabulary needs no shuffle.  A long one is joined; the window then holds one
    document's terms.
    """
    terms = _listed_terms(vocabulary)
    if terms is None:
        rows = numbered(docs.select(key, text))
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("_row")))
        both = rows.select(F.struct("_row", key).alias("_keys"), text)
        raw = _joined_weights(both, vocabulary, "_keys", text, ngram).withColumn("_row", F.col("_keys._row"))
        return raw.select(F.col(f"_keys.{key}").alias(key), "term", "tf", (F.col("w") / norm).alias("weight"))
    weighted = _with_weights(docs.select(key, text), vocabulary, terms, text, ngram)
    # inline_outer() as in term_frequencies(): all of the above would run once more in a filter.
    rows = weighted.select(key, "_norm", F.inline_outer("_weights")).filter("term IS NOT NULL")
    return rows.select(key, "term", "tf", (F.col("w") / F.col("_norm")).alias("weight"))


def tfidf_mean(
    docs: DataFrame,
    key: str,
    text: str = "clean_text",
    vocabulary: DataFrame | None = None,
    max_features: int = config.MAX_TERMS,
    ngram: tuple[int, int] = (1, 2),
    min_tokens: int = config.MIN_TFIDF_TOKENS,
    out: str = "tfidf_mean",
) -> DataFrame:
    """Every document with the mean of its weights over the whole vocabulary.

    With w the raw weights, the mean is sum(w) / |w| / vocabulary size.  Short documents
    and empty vocabularies give 0.  A short vocabulary is applied in place; for a long one
    two partial sums per document are shuffled.
    """
    corpus = eligible(docs, min_tokens)
    if vocabulary is None:
        vocabulary = materialize(tfidf_vocabulary(corpus, key, text, max_features, ngram=ngram))
    terms = _listed_terms(vocabulary)
    if terms is not None:
        counts = (F.col("token_count") >= min_tokens) & (F.col("_norm") > 0)
        mean = F.col("_sum") / F.col("_norm") / max(len(terms), 1)
        return (
            _with_weights(docs, vocabulary, terms, text, ngram)
            .withColumn(out, F.when(counts, mean).otherwise(F.lit(0.0)))
            .drop("_weights", "_sum", "_norm")
        )
    size = one_row(vocabulary, F.count(F.lit(1)).alias("n"))["n"]
    rows = numbered(docs)
    means = (
        _joined_weights(eligible(rows, min_tokens), vocabulary, "_row", text, ngram)
        .groupBy("_row")
        .agg(F.sum("w").alias("s"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
        .select("_row", (F.col("s") / F.col("norm") / size).alias("_mean"))
    )
    joined = rows.join(means, "_row", "left").withColumn(out, F.coalesce(F.col("_mean"), F.lit(0.0)))
    return joined.drop("_row", "_mean")


def corpus_features(articles: DataFrame, key: str) -> DataFrame:
    """Article features with ``tfidf_mean``.

    The features are written once, since document count, vocabulary, weights and the
    result are four reads of them.
    """
    return tfidf_mean(materialize(articles), key)


def keyword_columns(df: DataFrame) -> Sequence[str]:
    return [c for c in df.columns if c.startswith("keyword_")]
