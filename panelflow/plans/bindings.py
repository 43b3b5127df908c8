"""The operators' inputs expressed over the given tables.

Panel: orders by customer nation and month.  Yearly indicators: line items by supplier
nation and year.  Articles: ``documents`` as clean text, ``pages`` as HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelflow.functions.calendar import month_start
from panelflow.operators.frontier import page_identity
from panelflow.operators.panel import indicator_series, merge_indicators, series_column
from panelflow.session import fill_cores, materialize

# Mean order value against which a nation's deviation in percent is its "rate".
TYPICAL_ORDER = 250_000
YEARS_PER_PAGE = 2

# Word lists made of words that are frequent in the given texts; the built-in economic
# lists meet next to none of them.
CATEGORIES = {
    "inflation": ["thon", "thth", "ionaux"],
    "crisis": ["thnt", "thre"],
    "growth": ["thhe", "thed", "tionen"],
    "interest": ["thha", "erin"],
    "unemployment": ["thble", "anea"],
    "gdp": ["thor", "ther"],
    "currency": ["thin", "eron"],
    "market": ["thes", "rere"],
}
POSITIVE = ["tion", "ther", "thre", "thes", "thed"]
NEGATIVE = ["ing", "ble", "thor", "thin", "eror"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of long texts, which comes as a single row group."""
    return fill_cores(table(spark, sf, name))


def money(col: str) -> Column:
    """Exact sums of two-decimal amounts, whatever the order of summation."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


def nations(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey",
        F.col("n_name").alias("country_code"),
        F.concat_ws(", ", "n_name", "r_name").alias("country_name"),
    )


def _rates(spark: SparkSession, sf: str, period: Column) -> DataFrame:
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer")
    rate = 100 * (F.col("amount") / F.col("n") / TYPICAL_ORDER - 1)
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .groupBy("c_nationkey", period.cast("date").alias("date"))
        .agg(money("o_totalprice").alias("amount"), F.count(F.lit(1)).alias("n"))
        .join(nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("date", "country_code", "country_name", rate.alias("inflation_rate"))
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly panel with gaps where a nation has no orders."""
    return _rates(spark, sf, month_start("o_orderdate"))


def indicator_records(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly records ``(indicator, country_code, country_name, date, value)``, some null.

    ``interest_rate`` is published for complete years only and ``gdp_growth`` not for a
    nation's first year.
    """
    inflation = _rates(spark, sf, F.trunc("o_orderdate", "year")).select(
        F.lit("inflation").alias("indicator"),
        "country_code",
        "country_name",
        "date",
        F.col("inflation_rate").alias("value"),
    )
    items = table(spark, sf, "lineitem")
    suppliers = table(spark, sf, "supplier")
    # One nation's years: bounded by the calendar.
    by_year = Window.partitionBy("country_code").orderBy("date")
    yearly = (
        items.join(suppliers, items["l_suppkey"] == suppliers["s_suppkey"])
        .groupBy("s_nationkey", F.trunc("l_shipdate", "year").alias("date"))
        .agg(
            money("l_extendedprice").alias("revenue"),
            money("l_discount").alias("discount"),
            F.count(F.lit(1)).alias("n"),
            F.countDistinct(F.month("l_shipdate")).alias("months"),
        )
        .join(nations(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("before", F.lag("revenue").over(by_year))
    )
    growth = 100 * (F.col("revenue") / F.col("before") - 1)
    interest = F.when(F.col("months") == 12, 100 * F.col("discount") / F.col("n"))
    both = yearly.select(
        "country_code",
        "country_name",
        "date",
        F.inline(
            F.array(
                F.struct(F.lit("gdp_growth").alias("indicator"), growth.alias("value")),
                F.struct(F.lit("interest_rate").alias("indicator"), interest.alias("value")),
            )
        ),
    )
    return inflation.unionByName(both)


def yearly_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly panel merged from the three indicators.

    The series are landed first, so the line items are read once and not per indicator.
    """
    series = materialize(indicator_series(indicator_records(spark, sf)))
    return merge_indicators(
        series_column(series, "inflation", "inflation_rate"),
        {
            "gdp_growth": series_column(series, "gdp_growth", "gdp_growth"),
            "interest_rate": series_column(series, "interest_rate", "interest_rate"),
        },
    )


def indicator_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed API pages of two years each, plus one error page per nation.

    A page without any value never landed.  A page holds at most two records.
    """
    in_series = Window.partitionBy("indicator", "country_code").orderBy("date")
    whole = Window.partitionBy("indicator", "country_code")
    pages = (
        indicator_records(spark, sf)
        .withColumn("page", F.floor((F.row_number().over(in_series) - 1) / YEARS_PER_PAGE) + 1)
        .withColumn("pages", F.max("page").over(whole.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .groupBy("indicator", "country_code", "country_name", "page", "pages")
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.date_format("date", "yyyy").alias("date"), "value"))
            ).alias("records"),
            F.count("value").alias("values"),
        )
        .filter("values > 0")
    )
    options = {"ignoreNullFields": "false"}
    payload = F.concat(
        F.lit("["), F.to_json(F.struct("page", "pages")), F.lit(","), F.to_json("records", options), F.lit("]")
    )
    errors = nations(spark, sf).select(
        F.lit("trade").alias("indicator"),
        "country_code",
        "country_name",
        F.concat(F.lit('{"message":"'), "country_code", F.lit('"}')).alias("payload"),
    )
    return pages.select("indicator", "country_code", "country_name", payload.alias("payload")).unionByName(errors)


def uploads(spark: SparkSession, sf: str) -> DataFrame:
    """User files: customer balances by segment and month of the first order."""
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.groupBy(
        F.concat(F.lower("c_mktsegment"), F.lit(".csv")).alias("file_name"),
        month_start("o_orderdate").alias("date"),
    ).agg(
        (100 * (money("o_totalprice") / F.count(F.lit(1)) / TYPICAL_ORDER - 1)).alias("inflation_rate")
    )


def upload_text(spark: SparkSession, sf: str) -> DataFrame:
    """Uploads as they arrive, all text: some dates and numbers are broken."""
    orders = table(spark, sf, "orders")
    rate = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return orders.select(
        F.concat(F.lit("upload_"), F.lower(F.substring("o_orderpriority", 3, 20))).alias("dataset_id"),
        F.when(F.col("o_totalprice") < 2000, "someday")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date"),
        F.when((F.col("o_orderstatus") == "P") & F.startswith("o_orderpriority", F.lit("5")), "n/a")
        .otherwise(rate)
        .alias("inflation_rate"),
        F.when(F.col("o_orderstatus") != "O", rate).alias("gdp_growth"),
        F.col("o_custkey").cast("string").alias("country_code"),
        F.col("o_orderkey").cast("string").alias("order_key"),
    )


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as clean articles dated over the panel's months."""
    return texts(spark, sf, "documents").select(
        "doc_id",
        "text",
        "source",
        F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("lang") == "de", "undated")
        .otherwise(
            F.date_format(
                F.add_months(F.lit("1995-01-01").cast("date"), (F.col("doc_id") % 80).cast("int")),
                "yyyy-MM-dd'T'HH:mm:ss",
            )
        )
        .alias("published"),
        F.lit(None).cast("string").alias("title"),
    )


def marked_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a URL, a host, an address, a number and a no-break space added."""
    tail = F.concat(
        F.lit(" Read https://news.example/a?id="),
        F.col("doc_id").cast("string"),
        F.lit("&x=1 or www.example.org, mail me@news.example 42%\u00a0cannot wanna"),
    )
    return texts(spark, sf, "documents").select("doc_id", F.concat("text", tail).alias("text"))


CRAWL_DAY = "2024-03-01"


def raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    """HTML pages with crawl metadata."""
    pages = texts(spark, sf, "pages").withColumn("source", F.lit(None).cast("string"))
    return page_identity(pages, F.lit(CRAWL_DAY).cast("date")).select(
        "page_id",
        F.col("file_name").alias("html_path"),
        "html",
        "source",
        "host",
        "url_hash",
        "url",
        F.lit(None).cast("string").alias("title"),
        F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (F.col("page_id") % 365).cast("int")), "yyyy-MM-dd").alias("published"),
    )


def feed_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as feed entries: a feed per source, ranked by document.

    By language an entry has a link, only alternate links, or none that is usable, and a
    publication time, only an update time, or neither.
    """
    docs = table(spark, sf, "documents")
    url = F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string"))

    def link(rel: str, kind: str, suffix: str) -> Column:
        return F.struct(
            F.lit(rel).alias("rel"), F.lit(kind).alias("type"), F.concat(url, F.lit(suffix)).alias("href")
        )

    lang = F.col("lang")
    when = F.expr("timestamp_ntz'2024-01-01 06:00:00' + make_dt_interval(n_chars % 60)")
    return docs.select(
        "doc_id",
        F.col("source").alias("feed_name"),
        F.substring("source", 4, 10).cast("int").alias("feed_rank"),
        F.col("doc_id").alias("entry_rank"),
        F.get(F.split("text", "\n"), 0).alias("title"),
        F.when(lang == "en", url).alias("link"),
        F.when(
            lang == "fr", F.array(link("self", "application/xml", "/s"), link("alternate", "text/html", "/a"))
        )
        .when(lang == "es", F.array(link("self", "text/html; x", "/h")))
        .when(lang == "de", F.array(link("self", "application/xml", "/s")))
        .alias("links"),
        F.when(lang == "en", when).alias("published"),
        F.when(lang == "fr", when).alias("updated"),
        F.when(F.col("n_chars") < 300, 404).otherwise(200).alias("status_code"),
        "n_chars",
    )


NOW = "TIMESTAMP_NTZ'2024-03-01 00:00:00'"


def predictions(features: DataFrame) -> DataFrame:
    """Fixed linear forecast from last month's value and the three-month mean."""
    predicted = F.lit(0.6) * F.col("inflation_lag_1") + F.lit(0.4) * F.col("rolling_mean_3")
    return features.select(
        "country_code",
        "date",
        F.col("inflation_rate_t_plus_1").alias("actual"),
        predicted.alias("predicted"),
    ).filter("actual IS NOT NULL AND predicted IS NOT NULL")
