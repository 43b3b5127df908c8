import datetime as dt
import gzip

import pytest
from helpers import column, plan, rows
from pyspark.sql import functions as F

from panelflow import schemas
from panelflow.operators import catalog, frontier, panel, quality, timeseries
from panelflow.plans import QUERIES, source_queries
from panelflow.session import scratch_path
from panelflow.sources import files, indicators

D = dt.date


def payloads(spark, values):
    return spark.createDataFrame(
        [("PER", "Peru", "inflation", v) for v in values],
        "country_code STRING, country_name STRING, indicator STRING, payload STRING",
    )


def test_payload_golden(spark):
    page = '[{"page":1,"pages":1},[{"date":"2001","value":1.5},{"date":"2002","value":null}]]'
    records, rejects = indicators.parse_indicator_payload(payloads(spark, [page]))
    assert rows(records) == [("inflation", "PER", "Peru", D(2001, 1, 1), 1.5)]
    assert rejects.count() == 0


def test_payload_rejects(spark):
    values = [
        '{"message":"x"}',
        "not json",
        '[{"page":1}]',
        '[{},[{"date":"2001M1","value":1}]]',
        '[{},[{"date":"2001","value":"many"}]]',
        "[{},null]",
        "[{},[]]",
        None,
    ]
    records, rejects = indicators.parse_indicator_payload(payloads(spark, values))
    assert records.count() == 0
    reasons = sorted(column(rejects, "reason"))
    assert reasons == ["date is not a year"] + ["malformed payload"] * 4 + ["value is not a number"]


@pytest.mark.parametrize("second", ['{"a":1}', '"x"', "3"])
def test_a_second_element_that_is_no_list_is_rejected(spark, second):
    records, rejects = indicators.parse_indicator_payload(payloads(spark, [f"[{{}},{second}]"]))
    assert records.count() == 0 and column(rejects, "reason") == ["malformed payload"]


def test_page_completeness(spark):
    def done(values):
        return indicators.page_completeness(payloads(spark, values)).first().asDict()

    page = '[{{"page":{},"pages":3}},[{{"date":"2001","value":1}}]]'
    assert done([page.format(1), page.format(3)])["complete"] is False
    assert done([page.format(1), page.format(2), page.format(3)])["complete"] is True
    ended = done([page.format(1), '[{"page":2,"pages":3},[]]'])
    assert ended["ended_early"] is True and ended["complete"] is True


def series(spark, data):
    return spark.createDataFrame(
        [("i", "A", "Aland", D(y, 1, 1), v) for y, v in data], schemas.SERIES
    )


def test_merge_golden(spark):
    base = panel.series_column(series(spark, [(2001, 1.0), (2002, 2.0)]), "i", "inflation_rate")
    gdp = panel.series_column(series(spark, [(2001, 9.0), (2003, 8.0)]), "i", "gdp_growth")
    merged = panel.merge_indicators(base, {"gdp_growth": gdp, "interest_rate": None})
    assert merged.columns == panel.PANEL_COLUMNS
    assert sorted(rows(merged.select("date", "inflation_rate", "gdp_growth", "interest_rate"))) == [
        (D(2001, 1, 1), 1.0, 9.0, None),
        (D(2002, 1, 1), 2.0, None, None),
    ]
    twice = panel.merge_indicators(base, {"gdp_growth": gdp.union(gdp)})
    assert twice.count() == 3


def test_master_panel_of_nothing(spark):
    assert panel.master_panel([]).columns == panel.PANEL_COLUMNS


def test_series_report_golden(spark):
    countries = spark.createDataFrame([("A",), ("B",)], "country_code STRING")
    report = catalog.series_report(series(spark, [(2001, 1.0), (2002, 3.0)]), countries, ["i", "j"])
    got = {(r["country_code"], r["indicator"]): (r["status"], r["records"], r["value_mean"]) for r in report.collect()}
    assert got[("A", "i")] == ("success", 2, 2.0)
    assert got[("B", "i")] == ("failed_or_empty", 0, None)
    assert len(got) == 4 and "CartesianProduct" not in plan(report)


def test_dataset_history_prefers_country(spark):
    p = spark.createDataFrame([("upload_x", D(2001, 1, 1), 1.0)], "country_code STRING, date DATE, inflation_rate DOUBLE")
    u = spark.createDataFrame([("x.csv", D(2002, 1, 1), 2.0)], "file_name STRING, date DATE, inflation_rate DOUBLE")
    assert column(catalog.dataset_history(p, u, "upload_x"), "date") == ["2001-01-01"]
    assert column(catalog.dataset_history(p.limit(0), u, "upload_x"), "date") == ["2002-01-01"]
    assert catalog.dataset_history(p, u, "nothing").count() == 0


def test_catalog_skips_undated_uploads(spark):
    p = spark.createDataFrame([("A", "Aland")], "country_code STRING, country_name STRING")
    u = spark.createDataFrame([("x.csv", D(2002, 1, 1)), ("y.csv", None)], "file_name STRING, date DATE")
    assert sorted(column(catalog.dataset_catalog(p, u), "id")) == ["A", "upload_x"]


def upload(spark, data, names="dataset_id STRING, date STRING, inflation_rate STRING, other STRING, country_code STRING"):
    return spark.createDataFrame(data, names)


def test_validate_golden(spark):
    df = upload(spark, [("a", "2001-01-01", "1.5", "3", "PER"), ("a", "2001-02-01", "abc", "3", "PER"), ("b", "2001-01-01", None, None, "PER")])
    valid, rejected, report = quality.validate_panel(df)
    assert sorted(rows(valid.select("dataset_id", "date", "inflation_rate"))) == [("a", D(2001, 1, 1), 1.5), ("b", D(2001, 1, 1), None)]
    assert "other" not in valid.columns and "country_code" in valid.columns
    assert column(rejected, "reason") == ["inflation_rate must be numeric"]
    verdict = {r["dataset_id"]: (r["accepted"], r["unknown_columns"]) for r in report.collect()}
    assert verdict == {"a": (False, ["other"]), "b": (True, ["other"])}


def test_validate_missing_required_column(spark):
    df = upload(spark, [("a", "2001-01-01")], "dataset_id STRING, date STRING")
    valid, rejected, report = quality.validate_panel(df)
    assert valid.count() == 0 and "inflation_rate" in rejected.first()["reason"]
    assert report.first()["accepted"] is False


def test_validate_reads_a_dataset_in_one_format(spark):
    data = [("a", "13/02/2001"), ("a", "03/04/2001"), ("a", "x"), ("b", "02/13/2001"), ("b", "03/04/2001"), ("c", "2001-02-13"), ("d", None), (None, "2001-02-13")]
    df = upload(spark, [(k, d, "1") for k, d in data], "dataset_id STRING, date STRING, inflation_rate STRING")
    valid, rejected, report = quality.validate_panel(df, formats=["yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy"])
    assert sorted(rows(valid.select("dataset_id", "date")), key=str) == sorted(
        [("a", D(2001, 2, 13)), ("a", D(2001, 4, 3)), ("b", D(2001, 2, 13)), ("b", D(2001, 3, 4)), ("c", D(2001, 2, 13)), ("d", None), (None, D(2001, 2, 13))], key=str
    )
    assert rows(rejected) == [("a", "x", "1", "date must be a date")]
    got = {r["dataset_id"]: (r["date_format"], r["accepted"]) for r in report.collect()}
    assert got == {"a": ("dd/MM/yyyy", False), "b": ("MM/dd/yyyy", True), "c": ("yyyy-MM-dd", True), "d": ("yyyy-MM-dd", True), None: ("yyyy-MM-dd", True)}


def months(spark, data):
    return spark.createDataFrame([(k, D(y, m, 1), v) for k, y, m, v in data], "country_code STRING, date DATE, inflation_rate DOUBLE")


def test_spine_and_lags_golden(spark):
    df = months(spark, [("A", 2001, 1, 1.0), ("A", 2001, 3, 3.0), ("B", 2001, 5, 5.0)])
    spine = timeseries.month_spine(df)
    assert sorted(rows(spine)) == [
        ("A", D(2001, 1, 1), 1.0),
        ("A", D(2001, 2, 1), None),
        ("A", D(2001, 3, 1), 3.0),
        ("B", D(2001, 5, 1), 5.0),
    ]
    lagged = {r["date"]: r for r in timeseries.add_lags(spine, lags=(1, 2)).filter("country_code = 'A'").collect()}
    assert lagged[D(2001, 3, 1)]["inflation_lag_1"] is None
    assert lagged[D(2001, 3, 1)]["inflation_lag_2"] == 1.0
    target = {r["date"]: r[-1] for r in timeseries.add_target(spine).collect()}
    assert target[D(2001, 2, 1)] == 3.0 and target[D(2001, 3, 1)] is None


def test_rolling_needs_full_window(spark):
    df = months(spark, [("A", 2001, m, float(m)) for m in range(1, 8)])
    out = {r["date"].month: r for r in timeseries.add_rolling_std(timeseries.add_rolling_mean(df)).collect()}
    assert out[2]["rolling_mean_3"] is None and out[3]["rolling_mean_3"] == 2.0
    assert out[5]["rolling_std_6"] is None and round(out[6]["rolling_std_6"], 6) == 1.870829


def test_a_written_master_panel_is_not_sorted_globally(spark):
    df = months(spark, [("B", 2001, 1, 1.0), ("A", 2001, 1, 2.0)])
    assert "rangepartitioning" in plan(panel.master_panel([df, df]))
    loose = panel.master_panel([df, df], ordered=False)
    assert "Exchange" not in plan(loose) and loose.count() == 4


def test_seasonality_golden(spark):
    row = timeseries.add_seasonality(months(spark, [("A", 2001, 1, 0.0)])).first()
    assert round(row["month_sin"], 7) == 0.5 and round(row["month_cos"], 7) == 0.8660254


def test_align_annual_golden(spark):
    df = months(spark, [("A", y, m, 0.0) for y in (2001, 2002) for m in range(1, 13)])
    yearly = spark.createDataFrame([("A", D(2001, 1, 1), 4.0)], "country_code STRING, date DATE, gdp_growth DOUBLE")
    out = timeseries.align_annual(df, yearly)
    assert out.filter("year(date) = 2001 AND gdp_growth = 4.0").count() == 12
    assert out.filter("year(date) = 2002 AND gdp_growth IS NULL").count() == 12
    assert timeseries.align_annual(df, yearly, lag_years=1).filter("gdp_growth = 4.0").select(F.year("date")).distinct().first()[0] == 2002


def test_temporal_split_clips_month_end(spark):
    days = [D(2024, 2, 29), D(2023, 2, 28), D(2023, 3, 1), D(2022, 8, 28), D(2022, 9, 1)]
    df = spark.createDataFrame([(d,) for d in days], "date DATE")
    train, test = timeseries.temporal_split(df)
    assert sorted(column(train, "date")) == [D(2022, 8, 28), D(2022, 9, 1), D(2023, 2, 28)]
    assert sorted(column(test, "date")) == [D(2023, 3, 1), D(2024, 2, 29)]
    parts = [sorted(column(p, "date")) for p in timeseries.temporal_split3(df)]
    assert sorted(sum(parts, [])) == sorted(days) and parts[1] == [D(2022, 9, 1), D(2023, 2, 28)]


def test_features_use_one_shuffle_and_no_cross_join(spark):
    df = months(spark, [("A", 2001, m, float(m)) for m in range(1, 13)])
    text = plan(timeseries.build_features(df))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "SinglePartition" not in text


def feature_inputs(spark):
    df = months(spark, [("A", 2001, m, float(m)) for m in range(1, 13)])
    annual = spark.createDataFrame([("A", D(2001, 1, 1), 4.0)], "country_code STRING, date DATE, gdp_growth DOUBLE")
    text = spark.createDataFrame([("2001-02", 3)], "year_month STRING, text_article_count INT")
    return df, text, annual


def test_yearly_and_text_rows_do_not_shuffle_the_panel_again(spark):
    out = timeseries.build_features(*feature_inputs(spark))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = plan(timeseries.build_features(*feature_inputs(spark))).split("\n\n")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The panel and the yearly rows by entity, and the few months.
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == 3 and tree.count("BroadcastExchange") == 1
    panel_side = tree[tree.index("Window") :]
    assert panel_side[: panel_side.index("Sort")].count("Exchange") == 0
    assert out.filter("gdp_growth = 4.0").count() == 12 and out.filter("text_article_count = 3").count() == 1


def test_building_features_starts_no_job(spark):
    inputs = feature_inputs(spark)
    spark.sparkContext.setJobGroup("planning", "build_features")
    try:
        out = timeseries.build_features(*inputs)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") == []
        assert out.count() == 12
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") != []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_alignment_of_odd_rows(spark):
    schema = "country_code STRING, date DATE, gdp_growth DOUBLE"
    yearly = spark.createDataFrame([("A", D(2001, 1, 1), 4.0), ("A", D(2001, 5, 1), 5.0), (None, D(2001, 1, 1), 6.0), ("A", None, 7.0)], schema)
    df = spark.createDataFrame([("A", D(2001, 3, 1), 9.0), ("A", None, 9.0), (None, D(2001, 3, 1), 9.0), ("B", D(2001, 3, 1), 9.0)], schema)
    got = sorted(rows(timeseries.align_annual(df, yearly)), key=str)
    assert got == [("A", None, None), ("A", D(2001, 3, 1), 4.0), ("A", D(2001, 3, 1), 5.0), ("B", D(2001, 3, 1), None), (None, D(2001, 3, 1), None)]
    assert timeseries.align_annual(df, yearly.limit(0)).filter("gdp_growth IS NULL").count() == 4
    assert timeseries.align_annual(df.limit(0), yearly).count() == 0


def test_text_rows_of_one_month_and_of_no_month(spark):
    df = months(spark, [("A", 2001, 1, 0.0), ("B", 2001, 1, 0.0), ("A", 2001, 2, 0.0)])
    text = spark.createDataFrame([("2001-01", 1), ("2001-01", 2), ("2001-13", 8), (None, 9)], "year_month STRING, text_n INT")
    out = timeseries.join_text_features(df, text)
    assert sorted(rows(out.select("country_code", F.month("date"), "text_n")), key=str) == [("A", 1, 2), ("A", 2, None), ("B", 1, 2)]


def test_available_features_lists_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "month_cos DOUBLE, inflation_lag_1 DOUBLE")
    selected, missing = timeseries.available_features(df)
    assert selected.columns == ["inflation_lag_1", "month_cos"]
    assert "gdp_growth" in missing and len(missing) == 22


def entries(spark, n, published):
    return spark.createDataFrame(
        [("f", i, published(i)) for i in range(1, n + 1)], "feed_name STRING, entry_rank INT, published TIMESTAMP_NTZ"
    )


def test_feed_head_before_age_golden(spark):
    now = dt.datetime(2024, 3, 1)
    df = entries(spark, 12, lambda i: now - dt.timedelta(days=90 if i in (2, 5, 9) else 1))
    kept = frontier.age_filter(frontier.feed_head(df), F.lit(now).cast("timestamp_ntz"))
    assert sorted(column(kept, "entry_rank")) == [1, 3, 4, 6, 7, 8, 10]


def test_feed_head_limits_before_the_shuffle(spark):
    df = entries(spark, 12, lambda i: dt.datetime(2024, 1, 1))
    text = plan(frontier.feed_head(df))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_resolve_link_golden(spark):
    link = "STRUCT<rel: STRING, type: STRING, href: STRING>"
    df = spark.createDataFrame(
        [
            (1, "u1", [("alternate", None, "x")]),
            (2, None, [("self", "a/b", "u0"), ("alternate", None, "u2")]),
            (3, None, [("self", "text/html; x", "u3")]),
            (4, None, [("alternate", None, None), ("alternate", None, "later")]),
            (5, None, []),
            (6, None, None),
            (7, "", [("alternate", None, "x")]),
        ],
        f"id INT, link STRING, links ARRAY<{link}>",
    )
    got = {r["id"]: r["url"] for r in frontier.resolve_link(df).collect()}
    assert got == {1: "u1", 2: "u2", 3: "u3"}


def test_page_identity_golden(spark):
    df = spark.createDataFrame([("https://www.a.com/x", None), ("http://b.org:8080/", "s")], "url STRING, source STRING")
    got = frontier.page_identity(df, F.lit(D(2024, 3, 1))).orderBy("url").collect()
    assert got[1]["host"] == "a.com" and len(got[1]["url_hash"]) == 12
    assert got[1]["source"] == "fallback_a.com"
    assert got[0]["host"] == "b.org:8080" and got[0]["file_name"].startswith("s_20240301_")


def test_global_cap_is_a_top_n(spark):
    df = spark.range(100).select(
        F.lit(1).alias("feed_rank"), F.col("id").alias("entry_rank"), F.when(F.col("id") < 5, 404).otherwise(200).alias("status_code")
    )
    capped = frontier.global_cap(df, 3)
    assert column(capped, "entry_rank") == [5, 6, 7] and "TakeOrderedAndProject" in plan(capped)


@pytest.mark.parametrize("n, expected", [(9, 14), (10, 10)])
def test_with_fallback(spark, n, expected):
    primary = spark.range(n).select("id")
    fallback = spark.range(100, 120).select("id")
    assert frontier.with_fallback(primary, fallback, ["id"]).count() == expected


def test_panel_csv_round_trip_and_header_check(spark):
    df = spark.createDataFrame([(D(2001, 1, 1), "A", "Aland", 1.5, None, 2.0)], schemas.PANEL)
    path = scratch_path(spark, "t")
    files.write_panel(df, path, fmt="csv")
    back = files.read_panel_csv(spark, path)
    assert rows(back.drop("source_file")) == rows(df)
    other = scratch_path(spark, "t")
    df.withColumnRenamed("gdp_growth", "gdp").write.option("header", True).csv(other)
    with pytest.raises(Exception):
        files.read_panel_csv(spark, other).collect()


def test_write_panel_splits_a_hot_partition_value(spark):
    df = spark.range(1000).select(F.lit("A").alias("country_code"), F.col("id").alias("v"))
    path = scratch_path(spark, "t")
    files.write_panel(df, path, partition_by=["country_code"], sort_by=["v"])
    assert spark.read.parquet(path).count() == 1000
    assert "REBALANCE" in plan(df.hint("rebalance", F.col("country_code")))


def test_manifest_joins_files_by_name(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>\nA</p>")
    (tmp_path / "m.json").write_text(
        '{"articles": [{"url": "u", "html_path": "data/a.html"}, {"url": "none", "html_path": "data/missing.html"}],\n'
        ' "fallback_pages": [{"url": "v", "html_path": null}]}'
    )
    pages = files.read_raw_pages(spark, str(tmp_path / "*.html"), files.read_manifest(spark, str(tmp_path / "m.json")))
    assert rows(pages.select("url", "html")) == [("u", "<p>\nA</p>")]


def test_packed_pages_are_unpacked_and_bytes_kept(spark, tmp_path):
    (tmp_path / "raw html").mkdir()
    texts = {"a.html": b"<p>\nA\r\n\xc3\xa9</p>", "b.html": b"\xef\xbb\xbfq\xff", "c.html.gz": b"packed", "dgz": b"no name of a packed file"}
    for name, text in texts.items():
        (tmp_path / "raw html" / name).write_bytes(gzip.compress(text) if name.endswith(".gz") else text)
    manifest = spark.createDataFrame([(n, f"data/{n}") for n in [*texts, "none"]], "url STRING, html_path STRING")
    pages = files.read_raw_pages(spark, str(tmp_path / "raw html" / "*"), manifest)
    assert {r["url"]: bytes(r["html"]) for r in pages.withColumn("html", F.col("html").cast("binary")).collect()} == texts


def test_small_files_are_read_by_few_tasks(spark, tmp_path):
    for i in range(2000):
        (tmp_path / f"{i}.html").write_text("x")
    manifest = spark.createDataFrame([(f"{i}.html",) for i in range(3)], "html_path STRING")
    pages = files.read_raw_pages(spark, str(tmp_path / "*.html"), F.broadcast(manifest))
    assert pages.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism + 1
    assert rows(pages.orderBy("html_path")) == [(f"{i}.html", "x") for i in range(3)]


def test_stored_pages_share_folders(spark, tmp_path, monkeypatch):
    pages = [(i, f"https://a.example/{i}", "é\n" * i) for i in range(40)]
    spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING").write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(source_queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    got = rows(QUERIES["read_raw_pages"](spark, str(tmp_path)))
    assert sorted(got) == sorted((url, 3 * i, 2 * i) for i, url, _ in pages)
    stored = [p for p in (tmp_path / "raw" / "html").rglob("*") if p.is_file() and not p.name.startswith((".", "_"))]
    assert len(stored) == 40
    assert len({p.parent for p in stored}) <= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("mounted", [True, False])
def test_every_page_is_stored_in_a_file(spark, tmp_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(files, "_local_folder", lambda spark, path: None)
    monkeypatch.setattr(files, "PAGES_PER_FOLDER", 3)
    pages = [(1, "a\nb"), (7, None), *((i, "é" * i) for i in range(10, 18)), (1, "again")]
    path = str(tmp_path / "html")
    stored = files.write_raw_pages(spark.createDataFrame(pages, "page_id BIGINT, html STRING").coalesce(1), path)
    # Rows of one id in one task share a file.
    assert sorted(column(stored, "page_id")) == [1, 7, *range(10, 18)]
    back = files.read_raw_pages(spark, f"{path}/*", stored, depth=2).select("page_id", "html")
    html = dict(rows(back))
    assert sorted(html.pop(1).split("\n")) == ["", "a", "again", "b"]
    assert html == {7: "\n"} | {i: "é" * i + "\n" for i in range(10, 18)}
    if mounted:
        assert len([p for p in (tmp_path / "html").iterdir() if p.is_dir()]) == 4


def test_feeds(spark, tmp_path):
    (tmp_path / "news.xml").write_text(
        "<rss><channel><title>t</title><item><title>A</title><link>u</link><pubDate>Mon, 01 Jan 2024 06:00:00 +0200</pubDate></item>"
        "<item><title>B</title><pubDate>bad</pubDate></item></channel></rss>"
    )
    got = rows(files.read_feed_entries(spark, str(tmp_path / "news.xml")).select("feed_name", "entry_rank", "title", "link", "published"))
    assert got == [("news", 1, "A", "u", dt.datetime(2024, 1, 1, 4)), ("news", 2, "B", None, None)]
    (tmp_path / "atom.xml").write_text(
        '<feed><title>t</title><entry><title>A</title><link rel="self" href="s"/><link rel="alternate" href="u"/>'
        "<updated>2024-01-01T06:00:00Z</updated></entry></feed>"
    )
    atom = files.read_feed_entries(spark, str(tmp_path / "atom.xml"), dialect="atom")
    resolved = frontier.resolve_link(frontier.resolve_published(atom, F.lit(None).cast("timestamp_ntz")))
    assert rows(resolved.select("url", "published")) == [("u", dt.datetime(2024, 1, 1, 6))]
