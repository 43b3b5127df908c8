"""Imputation and scaling fitted on training rows only.

``impute`` and ``scale_*`` are lazy: the statistics are a one-row subquery of the
result.  ``PanelPreprocessor`` is the same as an Estimator, so it can be saved inside a
Pipeline; its fit reads back one small row per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from panelflow import config
from panelflow.functions.numbers import nan_to_null
from panelflow.operators.quantiles import exact_quantiles, most_frequent

FITTED = ("median", "mean", "most_frequent")


def _number(c: str) -> Column:
    return nan_to_null(F.col(c).cast("double"))


def _wide(long: DataFrame, cols: Sequence[str], value: str) -> DataFrame:
    """One row with a column per feature."""
    return long.agg(*[F.max(F.when(F.col("feature") == c, F.col(value))).alias(c) for c in cols])


def fill_values(
    train: DataFrame,
    cols: Sequence[str],
    strategy: str = "median",
    fill: float = 0.0,
    exact: bool = True,
) -> DataFrame:
    """One row: the replacement for missing values of each column."""
    if strategy == "constant":
        return train.sparkSession.range(1).select(*[F.lit(float(fill)).alias(c) for c in cols])
    if strategy == "mean":
        return train.agg(*[F.avg(_number(c)).alias(c) for c in cols])
    if strategy == "most_frequent":
        return _wide(most_frequent(train, cols), cols, "value")
    if strategy == "median":
        if not exact:
            return train.agg(*[F.percentile_approx(_number(c), 0.5, 100_000).alias(c) for c in cols])
        medians = exact_quantiles(train, cols, [0.5])
        return _wide(medians.select("feature", F.col("quantiles")[0].alias("q")), cols, "q")
    raise ValueError(f"unknown imputer strategy: {strategy}")


def scale_values(
    train: DataFrame, cols: Sequence[str], scaler: str = "standard", exact: bool = True
) -> DataFrame:
    """One row: ``<col>__center`` and ``<col>__scale``; a zero scale is 1."""
    if scaler == "standard":
        pairs = {c: (F.avg(_number(c)), F.stddev_pop(_number(c))) for c in cols}
        stats = train
    elif scaler == "minmax":
        pairs = {c: (F.min(_number(c)), F.max(_number(c)) - F.min(_number(c))) for c in cols}
        stats = train
    elif scaler == "robust":
        probs = [0.25, 0.5, 0.75]
        if exact:
            stats = exact_quantiles(train, cols, probs)
            qs = {c: F.max(F.when(F.col("feature") == c, F.col("quantiles"))) for c in cols}
        else:
            stats = train
            qs = {c: F.percentile_approx(_number(c), probs, 100_000) for c in cols}
        pairs = {c: (q[1], q[2] - q[0]) for c, q in qs.items()}
    else:  # any other name means no scaling
        none = [F.lit(v).alias(f"{c}__{p}") for c in cols for p, v in (("center", 0.0), ("scale", 1.0))]
        return train.sparkSession.range(1).select(*none)
    out = []
    for c, (center, scale) in pairs.items():
        out.append(center.alias(f"{c}__center"))
        out.append(F.when(scale == 0, F.lit(1.0)).otherwise(scale).alias(f"{c}__scale"))
    return stats.agg(*out)


def _with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """``df`` with a one-row table as the struct ``_fit``: one subquery, not one per use."""
    return df.withColumn("_fit", row.select(F.struct(*row.columns).alias("fit")).scalar())


def impute(
    train: DataFrame,
    apply_to: DataFrame,
    cols: Sequence[str],
    strategy: str = "median",
    fill: float = 0.0,
    exact: bool = True,
) -> DataFrame:
    """Fill missing numbers with a statistic of the training rows.

    A column without any training value stays NULL here, as the columns of a lazy plan
    cannot depend on data; ``PanelPreprocessor`` drops it.
    """
    fills = _with_row(apply_to, fill_values(train, cols, strategy, fill, exact))
    return fills.withColumns({c: F.coalesce(_number(c), F.col("_fit")[c]) for c in cols}).drop("_fit")


def _scale(train: DataFrame, apply_to: DataFrame, cols: Sequence[str], scaler: str, exact: bool) -> DataFrame:
    scaled = {
        c: (_number(c) - F.col("_fit")[f"{c}__center"]) / F.col("_fit")[f"{c}__scale"] for c in cols
    }
    return _with_row(apply_to, scale_values(train, cols, scaler, exact)).withColumns(scaled).drop("_fit")


def scale_standard(train: DataFrame, apply_to: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation."""
    return _scale(train, apply_to, cols, "standard", True)


def scale_minmax(train: DataFrame, apply_to: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min); a constant column gives 0."""
    return _scale(train, apply_to, cols, "minmax", True)


def scale_robust(
    train: DataFrame, apply_to: DataFrame, cols: Sequence[str], exact: bool = True
) -> DataFrame:
    """(x - median) / interquartile range."""
    return _scale(train, apply_to, cols, "robust", exact)


def _names(value: Sequence[str]) -> list[str]:
    return TypeConverters.toListString(list(value))


class _PreprocessorParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric features", _names)
    textCols = Param(Params._dummy(), "textCols", "text features", _names)
    numericStrategy = Param(Params._dummy(), "numericStrategy", "imputer", TypeConverters.toString)
    textStrategy = Param(Params._dummy(), "textStrategy", "imputer", TypeConverters.toString)
    textFill = Param(Params._dummy(), "textFill", "constant", TypeConverters.toFloat)
    scaler = Param(Params._dummy(), "scaler", "numeric scaler", TypeConverters.toString)
    exact = Param(Params._dummy(), "exact", "exact order statistics", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector", TypeConverters.toString)


class PanelPreprocessor(_PreprocessorParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns fill, center and scale per feature; columns without any value are dropped."""

    @keyword_only
    def __init__(
        self,
        *,
        numericCols=(),
        textCols=(),
        numericStrategy="median",
        textStrategy="constant",
        textFill=0.0,
        scaler="standard",
        exact=True,
        outputCol="features",
    ):
        super().__init__()
        self._setDefault(
            numericCols=[],
            textCols=[],
            numericStrategy="median",
            textStrategy="constant",
            textFill=0.0,
            scaler="standard",
            exact=True,
            outputCol="features",
        )
        self._set(**self._input_kwargs)

    @staticmethod
    def from_config(df: DataFrame, cfg: dict, exact: bool = True) -> PanelPreprocessor:
        """Built on the configured features that the table has."""
        numeric = cfg["preprocessing"]["numeric"]
        text = cfg["preprocessing"]["text"]
        return PanelPreprocessor(
            numericCols=[c for c in cfg["features"]["numeric"] if c in df.columns],
            textCols=[c for c in cfg["features"]["text"] if c in df.columns],
            numericStrategy=numeric.get("imputer_strategy", "median"),
            textStrategy=text.get("imputer_strategy", "constant"),
            textFill=float(text.get("imputer_fill_value", 0)),
            scaler=numeric.get("scaler", "standard"),
            exact=exact,
        )

    def _fills(self, df: DataFrame, cols: list[str], strategy: str) -> dict[str, float]:
        if not cols:
            return {}
        fill, exact = self.getOrDefault("textFill"), self.getOrDefault("exact")
        row = fill_values(df, cols, strategy, fill, exact).first()
        return {c: row[c] for c in cols if row[c] is not None}

    def _fit(self, df: DataFrame) -> PanelPreprocessorModel:
        get = self.getOrDefault
        numeric = self._fills(df, get("numericCols"), get("numericStrategy"))
        text = self._fills(df, get("textCols"), get("textStrategy"))
        centers = {c: 0.0 for c in [*numeric, *text]}
        scales = {c: 1.0 for c in [*numeric, *text]}
        if numeric:
            filled = df.select(*[F.coalesce(_number(c), F.lit(v)).alias(c) for c, v in numeric.items()])
            row = scale_values(filled, list(numeric), get("scaler"), get("exact")).first()
            for c in numeric:
                centers[c], scales[c] = row[f"{c}__center"], row[f"{c}__scale"]
        fills = {**numeric, **text}
        return PanelPreprocessorModel(
            featureCols=list(fills),
            fills=list(fills.values()),
            centers=list(centers.values()),
            scales=list(scales.values()),
            outputCol=get("outputCol"),
        )


class PanelPreprocessorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted preprocessor: a projection plus a feature vector."""

    featureCols = Param(Params._dummy(), "featureCols", "features in order", _names)
    fills = Param(Params._dummy(), "fills", "replacements", TypeConverters.toListFloat)
    centers = Param(Params._dummy(), "centers", "centers", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "scales", TypeConverters.toListFloat)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featureCols=(), fills=(), centers=(), scales=(), outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**self._input_kwargs)

    def feature_names(self) -> list[str]:
        return self.getOrDefault("featureCols")

    def expressions(self) -> dict[str, Column]:
        get = self.getOrDefault
        return {
            c: (F.coalesce(_number(c), F.lit(fill)) - F.lit(center)) / F.lit(scale)
            for c, fill, center, scale in zip(
                get("featureCols"), get("fills"), get("centers"), get("scales"), strict=True
            )
        }

    def _transform(self, df: DataFrame) -> DataFrame:
        temporary = {f"_x_{c}": e for c, e in self.expressions().items()}
        assembler = VectorAssembler(
            inputCols=list(temporary), outputCol=self.getOrDefault("outputCol")
        )
        return assembler.transform(df.withColumns(temporary)).drop(*temporary)


def preprocess(
    train: DataFrame, apply_to: DataFrame, cfg: dict | None = None, exact: bool = True
) -> DataFrame:
    """Preprocessed feature columns, numeric then text; all other columns are dropped."""
    cfg = cfg or config.default_config()
    model = PanelPreprocessor.from_config(train, cfg, exact).fit(train)
    return apply_to.select(*[e.alias(c) for c, e in model.expressions().items()])
