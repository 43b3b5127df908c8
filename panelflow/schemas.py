"""Declared schemas; no dataset is read with inference."""

from __future__ import annotations

PANEL = (
    "date DATE, country_code STRING, country_name STRING, "
    "inflation_rate DOUBLE, gdp_growth DOUBLE, interest_rate DOUBLE"
)

SERIES = (
    "indicator STRING, country_code STRING, country_name STRING, date DATE, value DOUBLE"
)

PAGE_RECORD = (
    "title STRING, url STRING, published STRING, source STRING, html_path STRING, "
    "html_size BIGINT, content_type STRING, fetch_timestamp STRING, status_code INT"
)

MANIFEST = f"articles ARRAY<STRUCT<{PAGE_RECORD}>>, fallback_pages ARRAY<STRUCT<{PAGE_RECORD}>>"

FEED_LINKS = "ARRAY<STRUCT<rel: STRING, type: STRING, href: STRING>>"
