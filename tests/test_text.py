import random
import string

import pytest
from helpers import column, plan, rows
from html_parser import parse_visible_text
from pyspark.sql import functions as F

from panelflow.functions import text as T
from panelflow.operators import monthly, text, tfidf


def texts(spark, values, name="html"):
    return spark.createDataFrame(list(enumerate(values)), f"id INT, {name} STRING")


CLEAN_CASES = [
    ("<p>in<b>flat</b>ion</p><script>x</script><!-- c -->&amp;", "in flat ion &"),
    ('<script>var a="<!--";</script>x < y<p title="a>b">z</p>', "x < y z"),
    ("a<!-- <script> -->b", "a b"),
    ("<nav>n<nav>m</nav>k</nav>z", "z"),
    ("<div><nav>menu</div>text", "text"),
    ("a<aside/>b", "a b"),
    ("<title>T</title><body>x&nbsp;y&eacute;&#233;</body>", "T x yéé"),
    ("a\tb<p>c\n  d   e</p>", "a\tb c d e"),
    ("<header>h</header><head>kept</head><form>f</form>", "kept"),
    ("<!DOCTYPE html><html>AT&T &unknown; &lt;b&gt;</html>", "AT&T &unknown <b>"),
    ("", ""),
    ("<style>p > a {}</style>only", "only"),
    ("<template>t</template>x<ruby>y<rt>z</rt></ruby>", "x y"),
    ("a<b>\t</b>c", "a c"),
    ("<header>a<header>b</header>c", ""),
    ("<div><nav>m</div>text</nav>x", "text x"),
    ("<nav><!-- </nav> -->m</nav>x", "x"),
    ("<header><nav><a>l</a></nav><form>f</form></header>x", "x"),
]


MARKUP_CASES = [
    ("<div><b></div><nav>m</b>n</nav>x", "x"),
    ("<b><div><nav>m</b>n</nav>x", "n x"),
    ("<form><p><form>a</p>b</form>c</form>d", "c d"),
    ("<ul><li>a<li>b</ul>c</li>d", "a b c d"),
    ("<p title='<nav>'>a</p><p title=\"</p>\">b</p>", "a b"),
    ("<a href=x/>a</a><nav/>b<br/>c", "a b c"),
    ("<NAV>m</Nav >x<SCRIPT>y</script\n>z", "x z"),
    ("&eacute;&#233;&#xE9;&#150;&#x110000;&#xD800;&#0065;&nosuch;&copy", "ééé–\ufffd\ufffdA&nosuch©"),
    ("a<![CDATA[<nav>b]]>c<![if x]>d", "a <nav>b c d"),
    ("a<script>x</nav>", "a"),
    ("a<!-- b > c", "a<!-- b > c"),
    ("<p \"q>x", "x"),
    ("a<nav>b\ufdd0</nav>\ufdd1\x01\x02c", "a \ufffd\x01\x02c"),
    ("<template><nav>a</template>b</nav>c", "b c"),
]


@pytest.mark.parametrize("mode", ["scan", "auto"])
def test_clean_html_golden(spark, mode):
    cases = CLEAN_CASES + MARKUP_CASES
    df = texts(spark, [h for h, _ in cases] + [None])
    got = column(text.clean_html(df, mode=mode).orderBy("id"), "text")
    assert got == [t for _, t in cases] + [None]


def test_native_alone_differs_on_nested_subtrees(spark):
    df = texts(spark, ["<nav>n<nav>m</nav>k</nav>z"])
    assert column(text.clean_html(df, mode="native"), "text") == ["k z"]
    assert column(text.clean_html(df), "text") == ["z"]
    with pytest.raises(ValueError, match="unknown mode"):
        text.clean_html(df, mode="parser")


def test_no_python_worker_and_no_shuffle_for_markup(spark):
    shown = plan(text.clean_html(texts(spark, ["x"]).filter("id < 9")))
    assert not any(node in shown for node in ("EvalPython", "InArrow", "InPandas", "Exchange"))


def _random_page(rng: random.Random) -> str:
    pieces = [
        "<p>", "</p>", "<b>", "</b>", "<br>", "<br/>", "<!-- c -->", "<script>if(a<b){}</script>",
        "<nav>x</nav>", "<style>p{}</style>", " ", "  ", "\n", "\t", "&amp;", "&lt;", "&nbsp;", "&copy;",
        '<a href="x">', "</a>", "<footer>f</footer>", "<!DOCTYPE html>", "<header>", "</header>", "<nav>",
        "&eacute;", "&#39;", "<form>", "</form>", "<header><nav>n</nav></header>", "<nav><a>l</a><ul><li>i</ul></nav>", 'title="a>b"', "<", ">", "<div title='q>r'>", "</div>",
    ]
    words = ["".join(rng.choices(string.ascii_letters + "éñ", k=4)) for _ in range(5)]
    return "".join(rng.choice(pieces + words) for _ in range(rng.randrange(1, 40)))


@pytest.mark.parametrize("mode", ["scan", "auto"])
def test_random_pages_against_a_parser(spark, mode):
    rng = random.Random(7)
    pages = [_random_page(rng) for _ in range(3000)]
    df = texts(spark, pages).repartition(8)
    got = {r["html"]: r["text"] for r in text.clean_html(df, mode=mode).collect()}
    assert [(p, got[p], parse_visible_text(p)) for p in pages if got[p] != parse_visible_text(p)] == []


def test_given_pages_against_a_parser(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("html")
    for r in text.clean_html(pages).collect():
        assert r["text"] == parse_visible_text(r["html"])


@pytest.mark.parametrize("mode", ["scan", "auto"])
def test_html_is_linear_on_hostile_pages(spark, mode):
    pages = [
        "<nav>" * 50_000,
        "<!--" * 50_000,
        "<a" * 50_000,
        "<!-- >" * 50_000,
        "<div>" * 50_000 + "a</b>" * 50_000,
        "<script>" + "x<" * 500_000 + "</script>done",
        "\t" * 100_000 + "x",
        "<p " + 'a="b" ' * 20_000 + ">y</p>",
        "<![CDATA[" * 30_000 + ">z",
        "<div>" * 10_000 + "</div>" * 10_000 + "<nav><nav></nav></nav>x",
        "<nav></nav>a&eacute;" * 2_000,
        "<b 'x" * 30_000 + ">w",
    ]
    got = column(text.clean_html(texts(spark, pages), mode=mode).orderBy("id"), "text")
    assert got[5] == "done" and got[6] == "x" and got[7] == "y" and got[8] == "z" and got[9] == "x"
    assert got[10] == " ".join(["aé"] * 2_000) and got[11] == "w"


NORMALIZE_CASES = [
    ("See https://a.com/x?y=1, a@b.co 12 Inflación!", "see inflacin"),
    ("a b", "a b"),
    ("http://" + "a" * 40_000, ""),
    ("www.example.org/path and www.x", "path and wwwx"),
    ("one@ @two x@y", "one two"),
    ("  A-B  c\td\n", "ab c d"),
]


def test_normalize_golden(spark):
    df = texts(spark, [t for t, _ in NORMALIZE_CASES], "text")
    got = column(text.normalize_text(df).orderBy("id"), "normalized")
    assert got == [n for _, n in NORMALIZE_CASES]


def test_fold_accents_option(spark):
    df = texts(spark, ["Inflación débil"], "text")
    assert column(text.normalize_text(df, fold_accents=True), "normalized") == ["inflacion debil"]


def tokens_of(spark, value):
    df = text.tokenize(text.normalize_text(texts(spark, [value], "text")))
    return column(text.filter_tokens(df), "tokens")[0]


def test_tokens_golden(spark):
    assert tokens_of(spark, "i cannot wanna market") == ["wan", "market"]
    assert tokens_of(spark, "") == []
    assert tokens_of(spark, "market market de la inflacion the") == ["market", "market", "inflacion"]


def lemma_frame(spark, lemmas):
    return spark.createDataFrame([(0, lemmas)], "id INT, lemmas ARRAY<STRING>")


def test_keywords_golden(spark):
    df = lemma_frame(spark, ["inflation", "inflation", "crisis"])
    row = text.keyword_counts(df).first()
    assert (row["keyword_inflation"], row["keyword_crisis"], row["keyword_gdp"]) == (1, 1, 0)
    row = text.keyword_counts(df, count="occurrences").first()
    assert row["keyword_inflation"] == 2
    phrase = lemma_frame(spark, ["interest", "rate"])
    assert text.keyword_counts(phrase).first()["keyword_interest"] == 0
    assert text.keyword_counts(phrase, phrases=True).first()["keyword_interest"] == 1


def test_sentiment_golden(spark):
    def score(words):
        return text.sentiment_score(lemma_frame(spark, words)).first()["sentiment_score"]

    assert round(score(["growth", "crisis", "fear"]), 4) == -0.3333
    assert score(["table"]) == 0.0
    assert score([]) == 0.0


def token_frame(spark, lists):
    return spark.createDataFrame(list(enumerate(lists)), "id INT, tokens ARRAY<STRING>")


def lemmas_by_id(df):
    return {r["id"]: r["lemmas"] for r in df.collect()}


DOCS = [
    ["banks", "bank", "banks", "boxes"],
    ["box", "women", "woman", "cities", "city", "gas"],
    ["ga", "glasses", "glass"],
    [],
]
LEMMAS = {
    0: ["bank", "bank", "bank", "box"],
    1: ["box", "woman", "woman", "city", "city", "ga"],
    2: ["ga", "glass", "glass"],
    3: [],
}


def test_lemmatize_with_corpus_lexicon(spark):
    df = token_frame(spark, DOCS)
    assert lemmas_by_id(text.lemmatize(df, "id")) == LEMMAS


@pytest.mark.parametrize("limit", [100_000, 0, 1, 3])
def test_lookup_paths_agree(spark, limit):
    df = token_frame(spark, DOCS).withColumn("title", F.lit("kept"))
    dictionary = text.lemma_dictionary(text.corpus_words(df))
    got = text.apply_lemmas(df, dictionary, "id", limit=limit)
    assert lemmas_by_id(got) == LEMMAS
    assert column(got, "title") == ["kept"] * 4


@pytest.mark.parametrize("limit", [100_000, 1])
def test_rows_of_repeated_and_null_keys_stay_apart(spark, limit):
    rows = [("a", ["banks", "glass"]), ("a", ["banks"]), (None, ["cities", "city"]), (None, []), ("a", ["banks"])]
    df = spark.createDataFrame(rows, "id STRING, tokens ARRAY<STRING>")
    dictionary = spark.createDataFrame([("banks", "bank"), ("cities", "city")], "form STRING, lemma STRING")
    got = text.apply_lemmas(df, dictionary, "id", limit=limit)
    assert got.columns == ["id", "tokens", "lemmas"]
    mapped = {"banks": "bank", "cities": "city"}
    want = sorted((str(k), [mapped.get(t, t) for t in ts]) for k, ts in rows)
    assert sorted((str(r["id"]), r["lemmas"]) for r in got.collect()) == want


def test_empty_dictionary_changes_nothing(spark):
    df = token_frame(spark, DOCS)
    nothing = spark.createDataFrame([], "form STRING, lemma STRING")
    assert lemmas_by_id(text.apply_lemmas(df, nothing, "id")) == dict(enumerate(DOCS))


def test_small_dictionary_does_not_shuffle_documents(spark):
    df = token_frame(spark, DOCS)
    dictionary = spark.createDataFrame([("banks", "bank")], "form STRING, lemma STRING")
    got = text.apply_lemmas(df, dictionary, "id")
    tree = plan(got).split("\n\n")[0].split("Subquery")[0]
    assert "Exchange" not in tree and "Join" not in tree
    assert "_table#" not in plan(got, "simple")  # no row carries the lookup table


def test_lemmatize_with_lexicon_and_dictionary(spark):
    df = token_frame(spark, [["banks", "cities", "geese"]])
    lexicon = spark.createDataFrame([("bank",), ("citie",)], "word STRING")
    assert lemmas_by_id(text.lemmatize(df, "id", lexicon=lexicon)) == {0: ["bank", "citie", "geese"]}
    dictionary = spark.createDataFrame([("geese", "goose")], "form STRING, lemma STRING")
    assert lemmas_by_id(text.lemmatize(df, "id", dictionary=dictionary)) == {0: ["banks", "cities", "goose"]}


def test_large_dictionary_join_leaves_hot_words_out(spark):
    """Half of all tokens are one word; it must not meet the join."""
    rare = [f"rare{chr(97 + i)}s" for i in range(20)]
    df = token_frame(spark, [["banks"] * 20 + rare for _ in range(10)])
    dictionary = spark.createDataFrame([("banks", "bank")] + [(r, r[:-1]) for r in rare], "form STRING, lemma STRING")
    got = text.apply_lemmas(df, dictionary, "id", limit=1)
    expected = ["bank"] * 20 + [r[:-1] for r in rare]
    assert lemmas_by_id(got) == {i: expected for i in range(10)}
    assert "CartesianProduct" not in plan(got)


def test_article_pipeline_gates_short_pages(spark):
    long = "<p>" + " ".join(f"word{chr(97 + i)} strong" for i in range(12)) * 2 + "</p>"
    few = "<p>" + "the " * 60 + "</p>"
    pages = spark.createDataFrame(
        [("a.html", long, None, "u", "2020-01-05", None), ("b.html", "<p>short</p>", "s", "u", "x", "t"), ("c.html", few, "s", "u", "x", "t")],
        "html_path STRING, html STRING, source STRING, url STRING, published STRING, title STRING",
    )
    got = text.article_features(pages).collect()
    assert [r["html_path"] for r in got] == ["a.html"]
    row = got[0]
    assert row["source"] == "unknown" and row["title"] == "" and row["sentiment_score"] == 1.0
    assert row["token_count"] == len(row["clean_text"].split())


def test_article_options(spark):
    words = " ".join(f"filler{chr(97 + i)}" for i in range(12))
    html = f"<p>{words} jobs jobs job débil interest rate banana pineapple pineapple pineapple</p>"
    pages = spark.createDataFrame(
        [("a.html", html, "s", "u", "2020-01-05", "t")],
        "html_path STRING, html STRING, source STRING, url STRING, published STRING, title STRING",
    )
    plain = text.article_features(pages).first()
    assert (plain["keyword_unemployment"], plain["keyword_interest"], plain["sentiment_score"]) == (0, 0, 0.0)
    options = {"negative": ["debil"], "fold_accents": True, "phrases": True, "lemmatize_lexicon": True}
    changed = text.article_features(pages, **options).first()
    assert (changed["keyword_unemployment"], changed["keyword_interest"], changed["sentiment_score"]) == (1, 1, -1.0)
    counted = text.article_features(pages, count="occurrences", lemmatize_lexicon=True).first()
    assert counted["keyword_unemployment"] == 3


def corpus(spark, values):
    rows_ = [(i, v, len(v.split())) for i, v in enumerate(values)]
    return spark.createDataFrame(rows_, "id INT, clean_text STRING, token_count INT")


def brute_vocabulary(values, limit, max_df=0.95):
    import math
    from collections import Counter

    df, total = Counter(), Counter()
    for v in values:
        words = [w for w in v.split() if len(w) >= 2]
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        total.update(terms)
        df.update(set(terms))
    n = len(values)
    kept = [t for t in total if df[t] <= max_df * n]
    kept.sort(key=lambda t: (-total[t], t))
    return {t: (df[t], total[t], round(math.log((1 + n) / (1 + df[t])) + 1, 9)) for t in kept[:limit]}


@pytest.mark.parametrize("limit", [5, 10, 40, 5_000])
@pytest.mark.parametrize("bits", [64, 1 << 22])
def test_vocabulary_equals_brute_force(spark, monkeypatch, limit, bits):
    monkeypatch.setattr(tfidf, "FILTER_BITS", bits)
    rng = random.Random(3)
    words = ["aa", "bb", "cc", "dd", "ee", "ff", "everywhere"]
    values = [
        " ".join(rng.choices(words, weights=[9, 8, 5, 3, 2, 1, 1], k=rng.randrange(3, 30))) + " everywhere"
        for _ in range(40)
    ]
    got = tfidf.tfidf_vocabulary(corpus(spark, values), "id", max_features=limit)
    found = {r["term"]: (r["df"], r["total"], round(r["idf"], 9)) for r in got.collect()}
    assert found == brute_vocabulary(values, limit)
    assert "everywhere" not in found


def test_filter_knows_its_words_and_few_others(spark):
    words = spark.createDataFrame([(f"w{i}",) for i in range(20_000)] + [("",), ("é",)], "term STRING")
    others = spark.range(20_000).select(F.concat(F.lit("x"), "id").alias("term"))
    holds = tfidf._may_hold(tfidf._word_filter(words), F.col("term"))
    assert words.filter(~holds).count() == 0 and others.filter(holds).count() < 20
    assert others.filter(tfidf._may_hold(tfidf._word_filter(words.limit(0)), F.col("term"))).count() == 0


def test_vocabulary_counts_only_pairs_of_frequent_words(spark):
    common, rare = "aa bb " * 50, " ".join(f"r{i} s{i}" for i in range(500))
    docs = corpus(spark, [common, rare])
    words = tfidf.term_totals(docs, ngram=(1, 1)).filter("total >= 50")
    assert sorted(column(tfidf.term_totals(docs, ngram=(2, 2), frequent=words), "term")) == ["aa bb", "bb aa"]


@pytest.mark.parametrize("literals,hot", [(2, 0), (2, 3), (2, 50_000), (5_000, 0)])
def test_weights_have_unit_length_and_mean_covers_vocabulary(spark, monkeypatch, literals, hot):
    monkeypatch.setattr(tfidf, "LITERAL_WORDS", literals)
    monkeypatch.setattr(tfidf, "HOT_TERMS", hot)
    values = ["aa bb cc aa", "bb cc dd", "ee ff ee"] * 2
    docs = corpus(spark, values).withColumn("token_count", F.lit(20))
    vocabulary = tfidf.tfidf_vocabulary(docs, "id")
    weights = tfidf.tfidf_weights(docs, vocabulary, "id")
    lengths = column(weights.groupBy("id").agg(F.sum(F.expr("weight * weight")).alias("l")), "l")
    assert all(abs(x - 1) < 1e-9 for x in lengths)
    size = vocabulary.count()
    expected = {r["id"]: r["m"] for r in weights.groupBy("id").agg((F.sum("weight") / size).alias("m")).collect()}
    for r in tfidf.tfidf_mean(docs, "id").collect():
        assert abs(r["tfidf_mean"] - expected[r["id"]]) < 1e-12


def test_weights_of_repeated_and_null_keys_are_the_same_on_both_paths(spark, monkeypatch):
    rows = [("a", "aa bb cc aa", 20), ("a", "bb cc dd", 20), (None, "ee ff ee", 20), (None, "aa aa", 3), ("b", "", 20), ("a", "bb cc dd", 20)]
    docs = spark.createDataFrame(rows, "id STRING, clean_text STRING, token_count INT")
    vocabulary = tfidf.tfidf_vocabulary(docs, "id")
    found = []
    for literals, hot in ((5_000, 0), (2, 0), (2, 2), (2, 50_000)):
        monkeypatch.setattr(tfidf, "LITERAL_WORDS", literals)
        monkeypatch.setattr(tfidf, "HOT_TERMS", hot)
        mean = tfidf.tfidf_mean(docs, "id", vocabulary=vocabulary)
        weights = tfidf.tfidf_weights(docs, vocabulary, "id")
        assert mean.columns == [*docs.columns, "tfidf_mean"]
        found.append(
            (
                sorted((str(r["id"]), r["clean_text"], round(r["tfidf_mean"], 9)) for r in mean.collect()),
                sorted((str(r["id"]), r["term"], r["tf"], round(r["weight"], 9)) for r in weights.collect()),
            )
        )
    assert all(f == found[0] for f in found) and len(found[0][0]) == len(rows)


def test_short_vocabulary_does_not_shuffle_documents(spark):
    docs = corpus(spark, ["aa bb cc aa", "bb cc dd"]).withColumn("token_count", F.lit(20))
    vocabulary = tfidf.tfidf_vocabulary(docs, "id")
    for df in (tfidf.tfidf_mean(docs, "id", vocabulary=vocabulary), tfidf.tfidf_weights(docs, vocabulary, "id")):
        tree = plan(df).split("\n\n")[0].split("Subquery")[0]
        assert "Exchange" not in tree and "Join" not in tree
        # No row carries the lookup table.
        assert "_runs" in plan(df, "extended") and "_table#" not in plan(df, "simple")


def test_tfidf_mean_zero_cases(spark):
    short = corpus(spark, ["aa bb cc"])
    assert column(tfidf.tfidf_mean(short, "id"), "tfidf_mean") == [0.0]
    # One document: every term is in all documents, so the vocabulary is empty.
    single = short.withColumn("token_count", F.lit(20))
    assert column(tfidf.tfidf_mean(single, "id"), "tfidf_mean") == [0.0]


def test_term_frequencies_do_not_shuffle(spark):
    docs = corpus(spark, ["aa bb aa", ""])
    frequencies = tfidf.term_frequencies(docs, "id")
    assert "Exchange" not in plan(frequencies)
    assert sorted(rows(frequencies)) == [(0, "aa", 2), (0, "aa bb", 1), (0, "bb", 1), (0, "bb aa", 1)]


def test_monthly_drops_unparsed_dates(spark):
    df = spark.createDataFrame(
        [("junk", 0.5, 0.1, 0.2, 1), ("2020-01-05T10:00:00", 0.5, 0.1, 0.2, 1), ("2020-01-31", -0.5, 0.3, 0.4, 2)],
        "published STRING, sentiment_score DOUBLE, tfidf_mean DOUBLE, vocabulary_richness DOUBLE, keyword_gdp INT",
    )
    out = monthly.monthly_text_features(monthly.parse_published(df)).collect()
    assert len(out) == 1
    row = out[0].asDict()
    assert row["year_month"] == "2020-01" and row["text_sentiment_score"] == 0.0
    assert row["text_keyword_gdp"] == 3 and row["text_article_count"] == 2


def test_stop_words_are_hashed(spark):
    df = texts(spark, ["a"], "text").select(T.content_tokens(F.split("text", " ")).alias("t"))
    assert "INSET" in plan(df)


def test_tokens_are_made_once_for_words_and_lemmas(spark):
    made = spark.sparkContext.accumulator(0)

    def split(value):
        made.add(1)
        return value.split()

    df = texts(spark, ["rates rate", "prices price", "rates"], "text").select(
        "id", F.udf(split, "array<string>")("text").alias("tokens")
    )
    found = {r["id"]: r["lemmas"] for r in text.lemmatize(df, "id").collect()}
    assert found == {0: ["rate", "rate"], 1: ["price", "price"], 2: ["rate"]}
    assert made.value == 3


def test_terms_are_not_counted_once_more_in_a_filter(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (1, "bb"), (2, ""), (3, None)], "id INT, clean_text STRING")
    vocabulary = tfidf.tfidf_vocabulary(docs, "id", max_df=1.0).localCheckpoint()
    weights = tfidf.tfidf_weights(docs, vocabulary, "id")
    conditions = [line for line in plan(weights).splitlines() if line.startswith("Condition")]
    assert not [c for c in conditions if "sort_array" in c]
    assert sorted((r["id"], r["term"], r["tf"]) for r in weights.collect()) == [
        (1, "aa", 2), (1, "aa bb", 1), (1, "bb", 1), (1, "bb", 1), (1, "bb aa", 1)
    ]


def test_long_vocabularies_without_rare_terms_read_documents_once(spark, monkeypatch):
    docs = spark.createDataFrame([(7, "aa bb aa"), (7, "aa bb aa"), (None, "bb cc"), (2, "")], "id INT, clean_text STRING")
    vocabulary = tfidf.tfidf_vocabulary(docs, "id", max_df=1.0).localCheckpoint()
    near = tfidf.tfidf_weights(docs, vocabulary, "id").withColumn("weight", F.round("weight", 9)).collect()
    monkeypatch.setattr(tfidf, "LITERAL_WORDS", 1)
    joined = tfidf.tfidf_weights(docs, vocabulary, "id").withColumn("weight", F.round("weight", 9))
    assert "LeftAnti" not in plan(joined, "simple")
    assert sorted(map(str, joined.collect())) == sorted(map(str, near))
