"""Queries for sources, sinks and the crawl frontier."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelflow import schemas
from panelflow.operators import frontier
from panelflow.plans import bindings as B
from panelflow.plans import oracle as O
from panelflow.plans.registry import query, select
from panelflow.session import scratch_path
from panelflow.sources import files, indicators


@query(
    "parse_indicator_payload",
    select(
        "indicator:s country_code:s country_name:s date:d value:f",
        "SELECT * FROM series",
        O.chain(O.RECORDS),
    ),
)
def parse_indicator_payload(spark, sf):
    records, _ = indicators.parse_indicator_payload(B.indicator_pages(spark, sf))
    return records


@query(
    "indicator_payload_rejects",
    select(
        "indicator:s country_code:s reason:s",
        "SELECT 'trade' AS indicator, country_code, 'malformed payload' AS reason FROM nations",
        O.chain(O.NATIONS),
    ),
)
def indicator_payload_rejects(spark, sf):
    _, rejects = indicators.parse_indicator_payload(B.indicator_pages(spark, sf))
    return rejects.select("indicator", "country_code", "reason")


@query(
    "page_completeness",
    select(
        "country_code:s indicator:s pages_landed:i pages_announced:i records:i ended_early:s complete:s",
        "SELECT country_code, indicator, count(DISTINCT page) AS pages_landed, max(pages) AS pages_announced, "
        "sum(records) AS records, 'false' AS ended_early, "
        "CASE WHEN count(DISTINCT page) >= max(pages) THEN 'true' ELSE 'false' END AS complete "
        "FROM landed GROUP BY ALL",
        O.chain(O.LANDED),
    ),
)
def page_completeness(spark, sf):
    done = indicators.page_completeness(B.indicator_pages(spark, sf))
    flags = {c: F.col(c).cast("string") for c in ("ended_early", "complete")}
    return done.withColumns(flags)


_PANEL_OUT = "date:d country_code:s country_name:s inflation_rate:f gdp_growth:f interest_rate:f"


@query(
    "read_panel_csv",
    select(_PANEL_OUT + " from_csv:s", "SELECT *, 'true' AS from_csv FROM yearly", O.chain(O.YEARLY)),
)
def read_panel_csv(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_panel(B.yearly_panel(spark, sf), path, fmt="csv", sort_by=["date"])
    panel = files.read_panel_csv(spark, path)
    return panel.withColumn("from_csv", F.endswith("source_file", F.lit(".csv")).cast("string")).drop(
        "source_file"
    )


@query("write_panel", select(_PANEL_OUT, "SELECT * FROM yearly", O.chain(O.YEARLY)))
def write_panel(spark, sf):
    path = scratch_path(spark, "panel")
    panel = B.yearly_panel(spark, sf)
    files.write_panel(panel, path, partition_by=["country_code"], sort_by=["date"])
    return spark.read.schema(schemas.PANEL).parquet(path)


@query(
    "write_json_report",
    select(
        "country_code:s records:i mean:f",
        "SELECT country_code, count(*) AS records, avg(inflation_rate) AS mean FROM panel GROUP BY 1",
        O.chain(O.PANEL),
    ),
)
def write_json_report(spark, sf):
    path = scratch_path(spark, "report")
    report = B.panel(spark, sf).groupBy("country_code").agg(
        F.count(F.lit(1)).alias("records"), F.avg("inflation_rate").alias("mean")
    )
    files.write_json_report(report, path)
    return spark.read.schema("country_code STRING, records BIGINT, mean DOUBLE").json(path)


@query(
    "read_raw_pages",
    select(
        "url:s html_size:i text_size:i",
        "SELECT url, strlen(html) AS html_size, length(html) AS text_size FROM pages",
    ),
)
def read_raw_pages(spark, sf):
    """Pages written one per file, and a manifest of them; both read back and joined."""
    folder = scratch_path(spark, "raw")
    pages = frontier.page_size(B.raw_pages(spark, sf))
    stored = files.write_raw_pages(pages, f"{folder}/html")
    manifest = pages.join(stored, "page_id").select(
        "title", "url", "published", "source", stored["html_path"], "html_size"
    )
    files.write_json_report(manifest, f"{folder}/manifest")
    manifest = files.read_manifest(spark, f"{folder}/manifest", lines=True)
    read = files.read_raw_pages(spark, f"{folder}/html/*", manifest, depth=2)
    # Every stored page ends with one line break.
    return read.select("url", "html_size", (F.char_length("html") - 1).alias("text_size"))


@query(
    "read_feed_entries",
    select(
        "feed_name:s entry_rank:i title:s link:s published:t",
        "SELECT source || '-' || doc_id // 200 AS feed_name, "
        "row_number() OVER (PARTITION BY source, doc_id // 200 ORDER BY doc_id) AS entry_rank, "
        "'Entry ' || doc_id AS title, 'https://' || source || '.example/' || doc_id AS link, "
        "TIMESTAMP '2024-01-01 06:00:00' + to_days(CAST(n_chars % 60 AS INTEGER)) AS published FROM documents",
    ),
)
def read_feed_entries(spark, sf):
    """RSS channels of a source's documents, 200 document numbers each, parsed back from files."""
    path = scratch_path(spark, "feeds")
    day = F.expr("timestamp_ntz'2024-01-01 06:00:00' + make_dt_interval(n_chars % 60)")
    item = F.concat(
        F.lit("<item><title>Entry "),
        F.col("doc_id").cast("string"),
        F.lit("</title><link>https://"),
        "source",
        F.lit(".example/"),
        F.col("doc_id").cast("string"),
        F.lit("</link><pubDate>"),
        F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss"),
        F.lit(" GMT</pubDate></item>"),
    )
    docs = B.table(spark, sf, "documents")
    items = F.sort_array(F.collect_list(F.struct("doc_id", item.alias("xml"))))
    channel = F.concat(
        F.lit('<rss version="2.0"><channel><title>'),
        "source",
        F.lit("</title>"),
        F.array_join(F.col("items.xml"), ""),
        F.lit("</channel></rss>"),
    )
    page = F.concat_ws("-", "source", F.floor(F.col("doc_id") / 200).cast("string"))
    feeds = docs.groupBy("source", page.alias("feed")).agg(items.alias("items"))
    feeds.select(channel.alias("value"), "feed").write.partitionBy("feed").text(path)
    entries = files.read_feed_entries(spark, path, feed_name=F.col("feed"))
    return entries.select("feed_name", "entry_rank", "title", "link", "published")


@query(
    "read_feed_entries_atom",
    select(
        "feed_name:s entry_rank:i title:s url:s published:t",
        "SELECT source || '-' || doc_id // 200 AS feed_name, "
        "row_number() OVER (PARTITION BY source, doc_id // 200 ORDER BY doc_id) AS entry_rank, "
        "'Entry ' || doc_id AS title, 'https://' || source || '.example/' || doc_id AS url, "
        "CASE WHEN doc_id % 2 = 0 THEN TIMESTAMP '2024-01-01 06:00:00' ELSE TIMESTAMP '2024-02-01 04:30:00' END "
        "+ to_days(CAST(n_chars % 60 AS INTEGER)) AS published FROM documents",
    ),
)
def read_feed_entries_atom(spark, sf):
    """Atom feeds of a source's documents; every other entry has only its time of update, with an offset."""
    path = scratch_path(spark, "atom")

    def stamp(start: str, offset: str):
        day = F.expr(f"timestamp_ntz'{start}' + make_dt_interval(n_chars % 60)")
        return F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(offset))

    target = F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string"))
    published = F.concat(F.lit("<published>"), stamp("2024-01-01 06:00:00", "Z"), F.lit("</published>"))
    item = F.concat(
        F.lit("<entry><title>Entry "),
        F.col("doc_id").cast("string"),
        F.lit('</title><link rel="self" type="application/atom+xml" href="'),
        target,
        F.lit('/self"/><link rel="alternate" type="text/html" href="'),
        target,
        F.lit('"/>'),
        F.when(F.col("doc_id") % 2 == 0, published).otherwise(""),
        F.lit("<updated>"),
        stamp("2024-02-01 06:30:00", "+02:00"),
        F.lit("</updated></entry>"),
    )
    docs = B.table(spark, sf, "documents")
    items = F.sort_array(F.collect_list(F.struct("doc_id", item.alias("xml"))))
    feed = F.concat(F.lit("<feed><title>"), "source", F.lit("</title>"), F.array_join(F.col("items.xml"), ""), F.lit("</feed>"))
    page = F.concat_ws("-", "source", F.floor(F.col("doc_id") / 200).cast("string"))
    feeds = docs.groupBy("source", page.alias("feed")).agg(items.alias("items"))
    feeds.select(feed.alias("value"), "feed").write.partitionBy("feed").text(path)
    entries = files.read_feed_entries(spark, path, dialect="atom", feed_name=F.col("feed"))
    entries = frontier.resolve_link(frontier.resolve_published(entries, F.expr(B.NOW)))
    return entries.select("feed_name", "entry_rank", "title", "url", "published")


@query(
    "read_manifest_document",
    select(
        "url:s source:s html_size:i",
        "SELECT url, CASE WHEN page_id % 5 = 0 THEN 'fallback' ELSE 'main' END AS source, strlen(html) AS html_size FROM pages",
    ),
)
def read_manifest_document(spark, sf):
    """Single-document manifests, one per hundred pages, with articles and fallback pages; all read back."""
    path = scratch_path(spark, "manifest")
    pages = frontier.page_size(B.table(spark, sf, "pages"))
    source = F.when(F.col("page_id") % 5 == 0, "fallback").otherwise("main")
    record = F.struct("url", source.alias("source"), "html_size")
    kinds = {"articles": F.col("page_id") % 5 != 0, "fallback_pages": F.col("page_id") % 5 == 0}
    lists = [F.collect_list(F.when(which, record)).alias(name) for name, which in kinds.items()]
    documents = pages.groupBy(F.floor(F.col("page_id") / 100).alias("part")).agg(*lists)
    body = F.to_json(F.struct(*kinds), {"pretty": "true"})
    documents.select(body.alias("value"), "part").write.partitionBy("part").text(path)
    return files.read_manifest(spark, path).select("url", "source", "html_size")


@query(
    "resolve_published",
    select("doc_id:i published:t", "SELECT * FROM entries", O.chain(O.FEEDS)),
)
def resolve_published(spark, sf):
    entries = frontier.resolve_published(B.feed_entries(spark, sf), F.expr(B.NOW))
    return entries.select("doc_id", "published")


@query(
    "resolve_link",
    select("doc_id:i url:s", "SELECT * FROM entries WHERE url IS NOT NULL", O.chain(O.FEEDS)),
)
def resolve_link(spark, sf):
    return frontier.resolve_link(B.feed_entries(spark, sf)).select("doc_id", "url")


_HEAD = "SELECT *, row_number() OVER (PARTITION BY feed_name ORDER BY entry_rank) AS place FROM entries"


@query(
    "feed_head",
    select("feed_name:s entry_rank:i title:s", f"SELECT * FROM ({_HEAD}) WHERE place <= 10", O.chain(O.FEEDS)),
)
def feed_head(spark, sf):
    return frontier.feed_head(B.feed_entries(spark, sf)).select("feed_name", "entry_rank", "title")


@query(
    "age_filter",
    select(
        "doc_id:i published:t",
        "SELECT * FROM entries WHERE published >= TIMESTAMP '2024-03-01 00:00:00' - INTERVAL 30 DAY",
        O.chain(O.FEEDS),
    ),
)
def age_filter(spark, sf):
    now = F.expr(B.NOW)
    entries = frontier.resolve_published(B.feed_entries(spark, sf), now)
    return frontier.age_filter(entries, now).select("doc_id", "published")


@query(
    "crawl_frontier",
    select(
        "feed_name:s entry_rank:i url:s published:t title:s",
        f"SELECT * FROM ({_HEAD}) WHERE place <= 10 AND url IS NOT NULL "
        "AND published >= TIMESTAMP '2024-03-01 00:00:00' - INTERVAL 30 DAY",
        O.chain(O.FEEDS),
    ),
)
def crawl_frontier(spark, sf):
    """Feed head, publication time, age and link in the order a crawl applies them."""
    now = F.expr(B.NOW)
    entries = frontier.resolve_published(frontier.feed_head(B.feed_entries(spark, sf)), now)
    entries = frontier.resolve_link(frontier.age_filter(entries, now))
    return entries.select("feed_name", "entry_rank", "url", "published", "title")


@query(
    "global_cap",
    select(
        "doc_id:i status_code:i",
        "SELECT * FROM entries WHERE status_code < 400 ORDER BY feed_rank, entry_rank LIMIT 50",
        O.chain(O.FEEDS),
    ),
)
def global_cap(spark, sf):
    return frontier.global_cap(B.feed_entries(spark, sf)).select("doc_id", "status_code")


@query(
    "page_identity",
    select(
        "page_id:i host:s url_hash:s source:s html_path:s", "SELECT * FROM raw_pages", O.chain(O.RAW_PAGES)
    ),
)
def page_identity(spark, sf):
    return B.raw_pages(spark, sf).select("page_id", "host", "url_hash", "source", "html_path")


@query("page_size", select("page_id:i html_size:i", "SELECT page_id, strlen(html) AS html_size FROM pages"))
def page_size(spark, sf):
    return frontier.page_size(B.table(spark, sf, "pages")).select("page_id", "html_size")


_FALLBACK = (
    "SELECT * FROM ({primary}) UNION ALL SELECT * FROM (SELECT page_id AS id, url, 'fallback' AS kind FROM pages "
    "ORDER BY page_id LIMIT 5) WHERE (SELECT count(*) FROM ({primary})) < 10"
)


def _fallback_sql(primary: str) -> str:
    return select("id:i url:s kind:s", _FALLBACK.format(primary=primary), O.chain(O.FEEDS))


def _pages_as_fallback(spark, sf):
    return B.table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), "url", F.lit("fallback").alias("kind")
    )


def _primary(spark, sf):
    entries = frontier.resolve_link(B.feed_entries(spark, sf))
    return entries.select(F.col("doc_id").alias("id"), "url", F.lit("article").alias("kind"), "n_chars")


@query(
    "with_fallback_not_needed",
    _fallback_sql("SELECT doc_id AS id, url, 'article' AS kind FROM entries WHERE url IS NOT NULL"),
)
def with_fallback_not_needed(spark, sf):
    primary = _primary(spark, sf).drop("n_chars")
    return frontier.with_fallback(primary, _pages_as_fallback(spark, sf), ["id"])


@query(
    "with_fallback",
    _fallback_sql(
        "SELECT doc_id AS id, url, 'article' AS kind FROM entries WHERE url IS NOT NULL "
        "AND n_chars = (SELECT max(n_chars) FROM entries WHERE url IS NOT NULL)"
    ),
)
def with_fallback(spark, sf):
    """Only the longest entries are kept as primary rows, so the fallback applies."""
    primary = _primary(spark, sf)
    longest = primary.agg(F.max("n_chars")).scalar()
    primary = primary.filter(F.col("n_chars") == longest).drop("n_chars")
    return frontier.with_fallback(primary, _pages_as_fallback(spark, sf), ["id"])


def _crawl(spark, sf):
    """Documents as fetched articles and pages as fallback pages."""
    docs = B.table(spark, sf, "documents").select(
        F.when(F.col("lang") != "es", F.col("source")).alias("source"),
        F.col("text").alias("html"),
        F.lit(False).alias("is_fallback"),
    )
    pages = B.table(spark, sf, "pages").select(
        F.lit("fallback").alias("source"), "html", F.lit(True).alias("is_fallback")
    )
    return frontier.page_size(docs.unionByName(pages))


@query(
    "crawl_summary",
    select(
        "total_articles:i total_fallback_pages:i total_records:i total_bytes:i",
        "SELECT a AS total_articles, p AS total_fallback_pages, a + p AS total_records, ab + pb AS total_bytes FROM "
        "(SELECT count(*) AS a, sum(strlen(text)) AS ab FROM documents), "
        "(SELECT count(*) AS p, sum(strlen(html)) AS pb FROM pages)",
    ),
)
def crawl_summary(spark, sf):
    return frontier.crawl_summary(_crawl(spark, sf))


@query(
    "articles_by_source",
    select(
        "source:s articles:i",
        "SELECT CASE WHEN lang = 'es' THEN 'unknown' ELSE source END AS source, count(*) AS articles "
        "FROM documents GROUP BY 1",
    ),
)
def articles_by_source(spark, sf):
    return frontier.articles_by_source(_crawl(spark, sf).filter(~F.col("is_fallback")))
