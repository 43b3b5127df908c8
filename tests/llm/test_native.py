"""Exact duplicates, URL rules and boilerplate lines."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import panelflow.llm.exact_dedup as exact
import panelflow.llm.line_dedup as lines
from panelflow.llm.exact_dedup import exact_duplicates
from panelflow.llm.line_dedup import drop_boilerplate
from panelflow.llm.url_filter import judge_urls
from panelflow.session import broadcast_if_small
from tests.helpers import plan


@pytest.mark.parametrize("name", ["op7_exact_dedup", "op8_url_filter", "op10_line_dedup"])
def test_queries_match_sql(same_as_sql, name):
    assert len(same_as_sql(name))


DOCS = [
    (5, "a b\tc"), (3, "abc"), (4, "a  b\tc"), (7, None), (9, ""), (8, " \n"), (11, "x" * 300_000), (12, "x" * 299_999 + " x"),
    (13, "x" * 299_999 + "y"), (None, "abc"), (20, "same"), (20, "same"), (None, "lone"), (31, "a bc"), (32, "é é"), (33, "éé"),
]


def brute(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = Counter()
    for same in groups.values():
        keep = min(same, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        for i, _ in same:
            out[(i, keep, len(same), i == keep)] += 1
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_exact_duplicates(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(exact, "broadcast_if_small", lambda df: df)
    df = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({"count": F.lit(1), "kept": F.lit("x"), "_best": F.lit(2)})
    got = exact_duplicates(df)
    assert set(got.columns) == {"doc_id", "text", "count", "kept", "_best", "keep_id", "group_size"}
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()) == brute(DOCS)
    assert not re.search("EvalPython|MapIn|InPandas|InArrow", plan(got))
    assert exact_duplicates(df.limit(0)).count() == 0


def test_urls(spark):
    rules = [("org", "/", "allow"), ("example.org", "/en/1", "block"), ("example.org", "/en/1", "allow"), (None, "/", "block"), ("B.com", "/", "block")]
    urls = [
        ("http://EXAMPLE.org/en/123", "example.org/en/1", "block"),
        ("http://a.b.example.org/en/2?x=://c.com/", "org/", "allow"),
        ("http://notexample.org/en/1", "org/", "allow"),
        ("http://example.org?/en/1", None, "none"),
        ("https://x.b.com/#", "b.com/", "block"),
        ("http://xb.com/", None, "none"),
        ("b.com/", None, "none"), ("", None, "none"), (None, None, "none"), ("http://b.com/", "b.com/", "block"), ("http://b.com/", "b.com/", "block"),
        ("http://" + "a." * 3000 + "org/" + "p" * 100_000, "org/", "allow"),
    ]
    df = spark.createDataFrame([(i, u[0], "z") for i, u in enumerate(urls)], "page_id int, url string, rule string")
    rule_rows = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(df, rule_rows, default="none").collect()}
    assert got == {i: u[1:] for i, u in enumerate(urls)}
    none = judge_urls(df, rule_rows.limit(0)).collect()
    assert len(none) == len(urls) and {r["verdict"] for r in none} == {"allow"}
    assert judge_urls(df.limit(0), rule_rows).count() == 0
    assert not re.search("EvalPython|MapIn|InPandas|InArrow", plan(judge_urls(df, rule_rows)))


@pytest.mark.parametrize("broadcast", [True, False])
def test_boilerplate(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(lines, "rows_up_to", lambda df: None)
    docs = [(i, "a" if i < 12 else None, f"head {i}\n Menu \n\nbody\nbody {i % 3}\nMenu") for i in range(18)]
    docs += [(20, "a", None), (21, "a", ""), (22, "b", "Menu\nMenu"), (None, "a", "Menu"), (23, "c", "z\n" * 50_000)]
    df = spark.createDataFrame(docs, "doc_id int, source string, text string").withColumn("key", F.lit(1))
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in drop_boilerplate(df, max_ratio=0.5, min_pages=4).collect()}

    pages, total = defaultdict(Counter), Counter()
    for _, host, text in docs:
        total[host] += 1
        pages[host].update({x.strip() for x in (text or "").split("\n")})
    for i, host, text in docs:
        if text is None:
            assert got[i] == (None, 0, 0)
            continue
        stays = [x for x in text.split("\n") if not x.strip() or not (pages[host][x.strip()] >= 4 and pages[host][x.strip()] > 0.5 * total[host])]
        assert got[i] == ("\n".join(stays), len(text.split("\n")), len(text.split("\n")) - len(stays))
    assert drop_boilerplate(df.limit(0)).count() == 0


def test_broadcasts_are_size_checked(spark):
    df = spark.range(10)
    assert broadcast_if_small(df, 5) is df


def test_digest_is_of_the_normalised_text(spark, sf):
    from panelflow.llm.queries import QUERIES

    row = QUERIES["op7_exact_dedup"](spark, sf).orderBy("doc_id").first()
    text = spark.read.parquet(f"{sf}/documents.parquet").filter(F.col("doc_id") == row["doc_id"]).first()["text"]
    assert row["text_sha256"] == hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text).encode()).hexdigest()
