"""Validation of uploads: row quarantine plus a per-dataset verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelflow import config


def select_allowed(
    df: DataFrame,
    allowed: Sequence[str] = config.ALLOWED_UPLOAD_COLUMNS,
    ids: Sequence[str] = config.ID_COLUMNS,
) -> DataFrame:
    """Known columns in input order."""
    return df.select(*[c for c in df.columns if c in allowed or c in ids])


def chosen_date_formats(df: DataFrame, formats: Sequence[str], dataset: str = "dataset_id", date: str = "date") -> DataFrame:
    """``(dataset, date_format)``: the format that reads most dates of a dataset; of equal ones the first listed.

    A dataset is read in one format, so that day and month are told apart by all of its rows.
    """
    read = [F.count(F.try_to_timestamp(date, F.lit(f))).alias(f"_f{i}") for i, f in enumerate(formats)]
    ranked = F.array(*[F.struct(F.col(f"_f{i}").alias("n"), F.lit(-i).alias("place"), F.lit(f).alias("format")) for i, f in enumerate(formats)])
    return df.groupBy(dataset).agg(*read).select(dataset, F.array_max(ranked)["format"].alias("date_format"))


def validate_panel(
    df: DataFrame,
    dataset: str = "dataset_id",
    required: Sequence[str] = config.REQUIRED_UPLOAD_COLUMNS,
    allowed: Sequence[str] = config.ALLOWED_UPLOAD_COLUMNS,
    ids: Sequence[str] = config.ID_COLUMNS,
    formats: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(valid, rejected, report)`` for an all-text upload table.

    Dates must parse and every other column but the ids must be numeric; nulls pass.
    ``valid`` is typed and holds known columns; ``rejected`` keeps the text with a
    reason; ``report`` accepts a dataset only without rejects.

    Dates are read as Spark casts them, or, with ``formats``, in the listed format that reads most
    dates of their dataset, which ``report`` then names in ``date_format``.
    """
    parsed = F.col("date").try_cast("timestamp_ntz") if "date" in df.columns else None
    lenient = formats is not None and "date" in df.columns
    columns = df.columns
    if lenient:
        chosen = chosen_date_formats(df, formats, dataset).withColumnRenamed(dataset, "_dataset").withColumnRenamed("date_format", "_format")
        df = df.join(chosen, F.col(dataset).eqNullSafe(F.col("_dataset"))).drop("_dataset")
        read = [F.when(F.col("_format") == f, F.try_to_timestamp("date", F.lit(f))) for f in formats]
        parsed = F.coalesce(*read).cast("timestamp_ntz")
    missing = [c for c in required if c not in columns]
    unknown = [c for c in columns if c not in (*allowed, *ids, dataset)]
    numeric = [c for c in columns if c not in ("date", *ids, dataset)]
    checks = []
    if missing:
        checks.append(F.lit(f"missing required columns: {', '.join(missing)}"))
    if "date" in df.columns:
        unparsed = F.col("date").isNotNull() & parsed.isNull()
        checks.append(F.when(unparsed, F.lit("date must be a date")))
    for c in numeric:
        bad = F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()
        checks.append(F.when(bad, F.lit(f"{c} must be numeric")))
    checked = df.withColumn("reason", F.coalesce(*checks))
    typed = {c: F.col(c).try_cast("double") for c in numeric if c in allowed}
    if "date" in df.columns:
        typed["date"] = parsed.cast("date")
    kept = [c for c in columns if c not in unknown]
    valid = checked.filter("reason IS NULL").withColumns(typed).select(*kept)
    rejected = checked.filter("reason IS NOT NULL").select(*columns, "reason")
    formats_used = [F.max("_format").alias("date_format")] if lenient else []
    report = (
        checked.groupBy(dataset)
        .agg(F.count(F.lit(1)).alias("records"), F.count("reason").alias("rejected"), *formats_used)
        .withColumn("accepted", F.col("rejected") == 0)
        .withColumn("unknown_columns", F.array(*[F.lit(c) for c in unknown]).cast("array<string>"))
    )
    return valid, rejected, report
