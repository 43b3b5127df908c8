"""Queries for panel assembly, catalogue, quality and time-series features."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelflow.operators import catalog, panel, quality, timeseries
from panelflow.operators.catalog import upload_id
from panelflow.plans import bindings as B
from panelflow.plans import oracle as O
from panelflow.plans.registry import query, select
from panelflow.plans.text_queries import MONTHLY_OUT, monthly_features

INDICATORS = ["inflation", "gdp_growth", "interest_rate", "unemployment"]
PANEL_OUT = "date:d country_code:s country_name:s inflation_rate:f gdp_growth:f interest_rate:f"


@query(
    "indicator_series",
    select("indicator:s country_code:s country_name:s date:d value:f", "SELECT * FROM series", O.chain(O.RECORDS)),
)
def indicator_series(spark, sf):
    return panel.indicator_series(B.indicator_records(spark, sf))


@query("merge_indicators", select(PANEL_OUT, "SELECT * FROM yearly", O.chain(O.YEARLY)))
def merge_indicators(spark, sf):
    return B.yearly_panel(spark, sf)


@query(
    "master_panel",
    select(
        PANEL_OUT,
        "SELECT date, country_code, country_name, inflation_rate, gdp_growth, interest_rate FROM yearly UNION ALL "
        "SELECT date, country_code, country_name, inflation_rate, NULL, NULL FROM panel",
        O.chain(O.YEARLY, O.PANEL),
    ),
)
def master_panel(spark, sf):
    """Yearly and monthly panels under one another."""
    return panel.master_panel([B.yearly_panel(spark, sf), B.panel(spark, sf)])


@query(
    "series_report",
    select(
        "country_code:s indicator:s status:s records:i date_min:d date_max:d value_min:f value_max:f value_mean:f null_count:i",
        "SELECT n.country_code, i.indicator, CASE WHEN count(date) = 0 THEN 'failed_or_empty' ELSE 'success' END AS status, "
        "count(date) AS records, min(date) AS date_min, max(date) AS date_max, min(value) AS value_min, "
        "max(value) AS value_max, avg(value) AS value_mean, "
        "CASE WHEN count(date) > 0 THEN count(date) - count(value) END AS null_count "
        f"FROM nations n CROSS JOIN (SELECT unnest({O.listed(INDICATORS)}) AS indicator) i "
        "LEFT JOIN series s ON s.country_code = n.country_code AND s.indicator = i.indicator GROUP BY 1, 2",
        O.chain(O.RECORDS),
    ),
)
def series_report(spark, sf):
    series = panel.indicator_series(B.indicator_records(spark, sf))
    return catalog.series_report(series, B.nations(spark, sf), INDICATORS)


@query(
    "dataset_catalog",
    select(
        "id:s name:s source:s records:i",
        "SELECT country_code AS id, country_name AS name, 'worldbank' AS source, count(*) AS records FROM panel GROUP BY 1, 2 "
        "UNION ALL SELECT 'upload_' || replace(file_name, '.csv', ''), file_name, 'user_upload', count(*) "
        "FROM uploads GROUP BY file_name",
        O.chain(O.PANEL, O.UPLOADS),
    ),
)
def dataset_catalog(spark, sf):
    return catalog.dataset_catalog(B.panel(spark, sf), B.uploads(spark, sf))


@query(
    "dataset_history",
    select("date:d inflation_rate:f", "SELECT * FROM panel WHERE country_code = 'NATION_7'", O.chain(O.PANEL)),
)
def dataset_history(spark, sf):
    history = catalog.dataset_history(B.panel(spark, sf), B.uploads(spark, sf), "NATION_7")
    return history.select("date", "inflation_rate")


@query(
    "dataset_history_upload",
    select("date:d inflation_rate:f", "SELECT * FROM uploads WHERE file_name = 'machinery.csv'", O.chain(O.UPLOADS)),
)
def dataset_history_upload(spark, sf):
    history = catalog.dataset_history(B.panel(spark, sf), B.uploads(spark, sf), "upload_machinery")
    return history.select("date", "inflation_rate")


def _datasets(spark, sf):
    countries = B.panel(spark, sf).select(
        F.col("country_code").alias("dataset_id"), F.col("country_name").alias("name"), "date", "inflation_rate"
    )
    files = B.uploads(spark, sf).select(
        upload_id(F.col("file_name")).alias("dataset_id"), F.col("file_name").alias("name"), "date", "inflation_rate"
    )
    return countries.unionByName(files)


_DATASETS = {
    **O.PANEL,
    **O.UPLOADS,
    "datasets": (
        "SELECT country_code AS dataset_id, country_name AS name, 'worldbank' AS source, date, inflation_rate FROM panel "
        "UNION ALL SELECT 'upload_' || replace(file_name, '.csv', ''), file_name, 'user_upload', date, inflation_rate "
        "FROM uploads"
    ),
}


@query(
    "dataset_profile",
    select(
        "dataset_id:s name:s source:s records:i date_min:d date_max:d columns:s",
        "SELECT dataset_id, name, source, count(*) AS records, min(date) AS date_min, max(date) AS date_max, "
        "'date inflation_rate' AS columns FROM datasets GROUP BY 1, 2, 3",
        O.chain(_DATASETS),
    ),
)
def dataset_profile(spark, sf):
    return catalog.dataset_profile(_datasets(spark, sf))


@query(
    "series_stats",
    select(
        "dataset_id:s mean:f max:f min:f std:f",
        "SELECT dataset_id, avg(inflation_rate) AS mean, max(inflation_rate) AS max, min(inflation_rate) AS min, "
        "stddev_samp(inflation_rate) AS std FROM datasets GROUP BY 1",
        O.chain(_DATASETS),
    ),
)
def series_stats(spark, sf):
    return catalog.series_stats(_datasets(spark, sf))


@query(
    "validate_panel_valid",
    select(
        "dataset_id:s date:s inflation_rate:f gdp_growth:f country_code:s",
        "SELECT * FROM judged WHERE reason IS NULL",
        O.chain(O.UPLOAD_TEXT),
    ),
)
def validate_panel_valid(spark, sf):
    valid, _, _ = quality.validate_panel(B.upload_text(spark, sf))
    return valid


@query(
    "validate_panel_rejected",
    select(
        "dataset_id:s date:s inflation_rate:s gdp_growth:s country_code:s order_key:s reason:s",
        "SELECT * FROM judged WHERE reason IS NOT NULL",
        O.chain(O.UPLOAD_TEXT),
    ),
)
def validate_panel_rejected(spark, sf):
    _, rejected, _ = quality.validate_panel(B.upload_text(spark, sf))
    return rejected


@query(
    "validate_panel",
    select(
        "dataset_id:s records:i rejected:i accepted:s unknown_columns:s",
        "SELECT dataset_id, count(*) AS records, count(reason) AS rejected, "
        "CASE WHEN count(reason) = 0 THEN 'true' ELSE 'false' END AS accepted, 'order_key' AS unknown_columns "
        "FROM judged GROUP BY 1",
        O.chain(O.UPLOAD_TEXT),
    ),
)
def validate_panel(spark, sf):
    _, _, report = quality.validate_panel(B.upload_text(spark, sf))
    return report.withColumn("accepted", F.col("accepted").cast("string"))


DATE_FORMATS = {"yyyy-MM-dd": "%Y-%m-%d", "MM/dd/yyyy": "%m/%d/%Y", "dd/MM/yyyy": "%d/%m/%Y", "yyyy.MM.dd": "%Y.%m.%d"}
_FORMATTED = {
    **O.UPLOAD_TEXT,
    "formatted": (
        "SELECT * REPLACE (CASE WHEN date = 'someday' THEN date WHEN dataset_id = 'upload_high' THEN strftime(CAST(date AS DATE), '%d/%m/%Y') "
        "WHEN dataset_id = 'upload_medium' THEN strftime(CAST(date AS DATE), '%Y.%m.%d') ELSE date END AS date) FROM upload_text"
    ),
    "attempts": " UNION ALL ".join(
        f"SELECT dataset_id, '{f}' AS f, {i} AS i, count(try_strptime(date, '{d}')) AS n FROM formatted GROUP BY 1"
        for i, (f, d) in enumerate(DATE_FORMATS.items())
    ),
    "chosen": "SELECT dataset_id, arg_max(f, n * 10 - i) AS date_format FROM attempts GROUP BY 1",
    "dated_uploads": (
        "SELECT *, CASE "
        + " ".join(f"WHEN date_format = '{f}' THEN try_strptime(date, '{d}')" for f, d in DATE_FORMATS.items())
        + " END AS day, CASE WHEN day IS NULL THEN 1 WHEN try_cast(inflation_rate AS DOUBLE) IS NULL THEN 1 END AS bad "
        "FROM formatted JOIN chosen USING (dataset_id)"
    ),
}


def _formatted(spark, sf):
    """Uploads of which two write their dates in another way."""
    day = F.col("date").try_cast("date")
    other = F.when(F.col("dataset_id") == "upload_high", F.date_format(day, "dd/MM/yyyy"))
    other = other.when(F.col("dataset_id") == "upload_medium", F.date_format(day, "yyyy.MM.dd"))
    return B.upload_text(spark, sf).withColumn("date", F.coalesce(other, F.col("date")))


@query(
    "validate_panel_formats",
    select(
        "dataset_id:s date_format:s records:i rejected:i accepted:s",
        "SELECT dataset_id, date_format, count(*) AS records, count(bad) AS rejected, "
        "CASE WHEN count(bad) = 0 THEN 'true' ELSE 'false' END AS accepted FROM dated_uploads GROUP BY 1, 2",
        O.chain(_FORMATTED),
    ),
)
def validate_panel_formats(spark, sf):
    _, _, report = quality.validate_panel(_formatted(spark, sf), formats=list(DATE_FORMATS))
    return report.withColumn("accepted", F.col("accepted").cast("string")).drop("unknown_columns")


@query(
    "validate_panel_formats_valid",
    select(
        "dataset_id:s date:d inflation_rate:f",
        "SELECT dataset_id, CAST(day AS DATE) AS date, CAST(inflation_rate AS DOUBLE) AS inflation_rate FROM dated_uploads WHERE bad IS NULL",
        O.chain(_FORMATTED),
    ),
)
def validate_panel_formats_valid(spark, sf):
    valid, _, _ = quality.validate_panel(_formatted(spark, sf), formats=list(DATE_FORMATS))
    return valid.select("dataset_id", "date", "inflation_rate")


@query(
    "select_allowed",
    select("date:s inflation_rate:s gdp_growth:s country_code:s", "SELECT * FROM upload_text", O.chain(O.UPLOAD_TEXT)),
)
def select_allowed(spark, sf):
    return quality.select_allowed(B.upload_text(spark, sf))


@query(
    "history_chart_series",
    select("dataset_id:s date:d inflation_rate:f", "SELECT * FROM datasets", O.chain(_DATASETS)),
)
def history_chart_series(spark, sf):
    return catalog.history_chart_series(_datasets(spark, sf))


def spine(spark, sf):
    return timeseries.month_spine(B.panel(spark, sf), carry=["country_name"])


_KEYS = "country_code:s date:d "
_WINDOWED = O.chain(O.WINDOWED)


@query(
    "month_spine", select(_KEYS + "country_name:s inflation_rate:f", "SELECT * FROM spine", O.chain(O.SPINE))
)
def month_spine(spark, sf):
    return spine(spark, sf)


@query(
    "add_lags",
    select(
        _KEYS + "inflation_lag_1:f inflation_lag_3:f inflation_lag_6:f inflation_lag_12:f",
        "SELECT * FROM windowed",
        _WINDOWED,
    ),
)
def add_lags(spark, sf):
    return timeseries.add_lags(spine(spark, sf)).drop("country_name", "inflation_rate")


@query(
    "add_rolling_mean",
    select(_KEYS + "rolling_mean_3:f rolling_mean_6:f rolling_mean_12:f", "SELECT * FROM windowed", _WINDOWED),
)
def add_rolling_mean(spark, sf):
    return timeseries.add_rolling_mean(spine(spark, sf)).drop("country_name", "inflation_rate")


@query("add_rolling_std", select(_KEYS + "rolling_std_6:f", "SELECT * FROM windowed", _WINDOWED))
def add_rolling_std(spark, sf):
    return timeseries.add_rolling_std(spine(spark, sf)).drop("country_name", "inflation_rate")


@query("add_seasonality", select(_KEYS + "month_sin:f month_cos:f", "SELECT * FROM windowed", _WINDOWED))
def add_seasonality(spark, sf):
    return timeseries.add_seasonality(spine(spark, sf)).drop("country_name", "inflation_rate")


@query("add_target", select(_KEYS + "inflation_rate_t_plus_1:f", "SELECT * FROM windowed", _WINDOWED))
def add_target(spark, sf):
    return timeseries.add_target(spine(spark, sf)).drop("country_name", "inflation_rate")


@query(
    "join_text_features",
    select(
        _KEYS + "inflation_rate:f " + MONTHLY_OUT,
        "SELECT p.*, m.* EXCLUDE (year_month) FROM panel p LEFT JOIN monthly m ON m.year_month = strftime(p.date, '%Y-%m')",
        O.chain(O.PANEL, O.MONTHLY),
    ),
)
def join_text_features(spark, sf):
    joined = timeseries.join_text_features(B.panel(spark, sf), monthly_features(spark, sf))
    return joined.drop("country_name")


def yearly(spark, sf):
    return B.yearly_panel(spark, sf).select("country_code", "date", "gdp_growth", "interest_rate")


@query(
    "align_annual",
    select(_KEYS + "gdp_growth:f interest_rate:f", "SELECT * FROM aligned", O.chain(O.NUMERIC)),
)
def align_annual(spark, sf):
    aligned = timeseries.align_annual(spine(spark, sf), yearly(spark, sf))
    return aligned.select("country_code", "date", "gdp_growth", "interest_rate")


@query(
    "align_annual_lagged",
    select(
        _KEYS + "gdp_growth:f interest_rate:f",
        "SELECT s.country_code, s.date, y.gdp_growth, y.interest_rate FROM spine s LEFT JOIN yearly y "
        "ON y.country_code = s.country_code AND year(y.date) = year(s.date) - 1",
        O.chain(O.SPINE, O.YEARLY),
    ),
)
def align_annual_lagged(spark, sf):
    aligned = timeseries.align_annual(spine(spark, sf), yearly(spark, sf), lag_years=1)
    return aligned.select("country_code", "date", "gdp_growth", "interest_rate")


NUMERIC_OUT = (
    "inflation_lag_1:f inflation_lag_3:f inflation_lag_6:f inflation_lag_12:f rolling_mean_3:f "
    "rolling_mean_6:f rolling_mean_12:f rolling_std_6:f gdp_growth:f interest_rate:f month_sin:f month_cos:f"
)


def numeric_features(spark, sf):
    """Panel features without text, keyed by country and month."""
    return timeseries.build_features(B.panel(spark, sf), yearly=yearly(spark, sf))


@query(
    "build_features",
    select(
        _KEYS + "inflation_rate:f " + NUMERIC_OUT + " " + MONTHLY_OUT + " inflation_rate_t_plus_1:f",
        "SELECT * FROM feature_table",
        O.chain(O.FEATURE_TABLE),
    ),
)
def build_features(spark, sf):
    return timeseries.build_features(B.panel(spark, sf), monthly_features(spark, sf), yearly(spark, sf))


_SPLIT = "SELECT *, (SELECT max(date) FROM windowed) AS last FROM windowed"


@query(
    "temporal_split",
    select(
        _KEYS + "split:s",
        "SELECT *, CASE WHEN date <= last - INTERVAL 12 MONTH THEN 'train' ELSE 'test' END AS split "
        f"FROM ({_SPLIT})",
        _WINDOWED,
    ),
)
def temporal_split(spark, sf):
    train, test = timeseries.temporal_split(spine(spark, sf))
    labelled = [d.withColumn("split", F.lit(s)) for d, s in ((train, "train"), (test, "test"))]
    return labelled[0].unionByName(labelled[1]).select("country_code", "date", "split")


@query(
    "temporal_split_validation",
    select(
        _KEYS + "split:s",
        "SELECT *, CASE WHEN date <= last - INTERVAL 18 MONTH THEN 'train' "
        f"WHEN date <= last - INTERVAL 12 MONTH THEN 'validation' ELSE 'test' END AS split FROM ({_SPLIT})",
        _WINDOWED,
    ),
)
def temporal_split_validation(spark, sf):
    parts = timeseries.temporal_split3(spine(spark, sf))
    labelled = [d.withColumn("split", F.lit(s)) for d, s in zip(parts, ("train", "validation", "test"))]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2]).select("country_code", "date", "split")


@query("available_features", select(NUMERIC_OUT, "SELECT * FROM aligned", O.chain(O.NUMERIC)))
def available_features(spark, sf):
    """The table has no text features, so those are reported missing and left out."""
    selected, _ = timeseries.available_features(numeric_features(spark, sf))
    return selected
