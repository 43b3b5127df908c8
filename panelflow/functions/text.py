"""Column expressions from clean text to tokens and lexicon scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column, functions as F

from panelflow.config import ENGLISH_STOP_WORDS, SPANISH_STOP_WORDS
from panelflow.functions.html import SPACE

# The same, first tested by range: most characters are none of it, and a long class is slow.
QUICK_SPACE = rf"[\x00-\x20\x{{7f}}-\x{{10ffff}}&&{SPACE}]"
# One character class instead of an alternation under a repeat, so that
# the matcher needs no stack; the range $-_ covers digits, capitals and most marks.
URL = r"https?://[a-zA-Z$-_!]+"
HOST = r"www\.[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# These, as three ranges with the digits between them, and all other digits.
MARKS_AND_DIGITS = r"[!-@\[-`{-~[\x{80}-\x{10ffff}&&\p{Nd}]]+"
# As a range: written as a negated class it takes a second and a half more per 25 MB of text on 8 cores.
NOT_ASCII = r"[\x{80}-\x{10ffff}]+"
# Words the tokenizer splits in two.
CONTRACTIONS = {
    "cannot": "can not",
    "gimme": "gim me",
    "gonna": "gon na",
    "gotta": "got ta",
    "lemme": "lem me",
    "wanna": "wan na",
}
# Accented letters folded when the caller asks for it.
ACCENTED, FOLDED = "áàâäãåéèêëíìîïóòôöõúùûüñç", "aaaaaaeeeeiiiiooooouuuunc"


@lru_cache
def default_stop_words() -> tuple[str, ...]:
    """English and Spanish stop words, sorted."""
    return tuple(sorted({*ENGLISH_STOP_WORDS, *SPANISH_STOP_WORDS}))


def _bound(text: Column, made: Callable[[Column], Column]) -> Column:
    """``made(text)`` as the body of a lambda.

    The text is made once, however often the body uses it.  And a chain of regular expressions in one
    generated method gets longer than the JVM compiles (8,000 bytes), so that its loops over matches would stay
    interpreted; a lambda's body is run by Spark's own compiled code.
    """
    return F.get(F.transform(F.array(text), made), F.lit(0))


def _if_held(text: Column, parts: Sequence[str], changed: Callable[[Column], Column], other: Callable[[Column], Column] | None = None) -> Column:
    """``changed(text)`` where one of ``parts`` occurs, else ``other(text)`` or the text itself.

    Looking for a few fixed strings is far cheaper than a regular expression.
    """

    def chosen(t: Column) -> Column:
        found = reduce(or_, [F.contains(t, F.lit(p)) for p in parts])
        return F.when(found, changed(t)).otherwise(t if other is None else other(t))

    return _bound(text, chosen)


def normalized(text: Column, fold_accents: bool = False) -> Column:
    """Lower-case and delete URLs, hosts, emails, digits, punctuation and non-ASCII."""

    def without_emails(t: Column) -> Column:
        # An email is a white-space delimited run with an @ inside it: linear per run.
        runs = F.filter(F.split(t, f"{QUICK_SPACE}+"), lambda run: ~run.rlike("(?s).@."))
        return F.array_join(runs, " ")

    def made(text: Column) -> Column:
        text = F.lower(text)
        if fold_accents:
            text = F.translate(text, ACCENTED, FOLDED)
        text = _if_held(text, ["http"], lambda t: F.regexp_replace(t, URL, ""))
        text = _if_held(text, ["www."], lambda t: F.regexp_replace(t, HOST, ""))
        text = _if_held(text, ["@"], without_emails, lambda t: F.regexp_replace(t, f"{QUICK_SPACE}+", " "))
        text = F.regexp_replace(text, MARKS_AND_DIGITS, "")
        # Of white space only the blanks just put in are left.
        text = F.trim(F.regexp_replace(text, "  +", " "))
        return F.regexp_replace(text, NOT_ASCII, "")

    return _bound(text, made)


def word_tokens(text: Column) -> Column:
    """Tokens of normalised text; contractions are split."""
    heads = "|".join(
        f"{pair.split()[0]}(?={pair.split()[1]}\\b)" for pair in CONTRACTIONS.values()
    )
    spaced = _if_held(text, list(CONTRACTIONS), lambda t: F.regexp_replace(t, rf"\b({heads})", "$1 "))
    return F.filter(F.split(spaced, " +"), lambda t: t != "")


def content_tokens(
    tokens: Column, stop_words: Sequence[str] | None = None, min_length: int = 3
) -> Column:
    """Alphabetic tokens of at least ``min_length`` characters that are no stop words.

    The list becomes a hash set in the plan, so a lookup does not scan it.
    """
    stops = list(default_stop_words() if stop_words is None else stop_words)

    def keep(token: Column) -> Column:
        shape = (F.length(token) >= min_length) & token.rlike("^[a-zA-Z]+$")
        return shape & ~token.isin(stops) if stops else shape

    return F.filter(tokens, keep)


def words_present(tokens: Column, words: Sequence[str]) -> Column:
    """How many distinct listed words occur."""
    if not words:
        return F.lit(0)
    return F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in dict.fromkeys(words)])))


def words_counted(tokens: Column, words: Sequence[str]) -> Column:
    """How often listed words occur, repeats included."""
    listed = list(dict.fromkeys(words))
    return F.size(F.filter(tokens, lambda t: t.isin(listed))) if listed else F.lit(0)


def adjacent_pairs(tokens: Column) -> Column:
    """Bigrams, in order."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), pairs),
        F.slice(tokens, F.lit(2), pairs),
        lambda left, right: F.concat(left, F.lit(" "), right),
    )


def polarity(positive: Column, negative: Column) -> Column:
    """(p - n) / (p + n), or 0.0 where neither occurs."""
    total = positive + negative
    return F.when(total == 0, F.lit(0.0)).otherwise((positive - negative) / total)
