"""In-fold preprocessing: features, exact median / mode imputation, scaling of
the numeric columns, indexing + one-hot encoding and assembly.

The numeric columns are scaled before assembly, by mean and population
deviation; one-hot columns are never scaled."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import feature_baselines
from ..operators.features import add_v2_features

V1_FEATURE_SQL = (
    "SELECT *, coalesce(applicant_income, 0D) + coalesce(coapplicant_income, 0D) AS total_income, "
    "ln(1D + greatest(coalesce(applicant_income, 0D) + coalesce(coapplicant_income, 0D), 0D)) AS log_total_income, "
    "CASE WHEN loan_amount IS NULL THEN NULL ELSE ln(1D + greatest(loan_amount, 0D)) END AS log_loan_amount, "
    "loan_amount * 1000D / nullif((coalesce(applicant_income, 0D) + coalesce(coapplicant_income, 0D)) * 12D, 0D) "
    "AS loan_to_annual_income, loan_amount * 1000D / nullif(loan_amount_term, 0D) AS monthly_principal_proxy, "
    "CAST(CAST(credit_history AS INT) AS STRING) AS credit_history_cat FROM __THIS__")
V1_NUMERIC = ["applicant_income", "coapplicant_income", "loan_amount", "loan_amount_term", "total_income",
              "log_total_income", "log_loan_amount", "loan_to_annual_income", "monthly_principal_proxy"]
V1_CATEGORICAL = ["married", "dependents", "education", "self_employed", "credit_history_cat", "property_area"]


# Model columns of the v2 layout.
V2_NUMERIC = ["no_of_dependents", "income_annum", "loan_amount", "loan_term", "cibil_score",
              "residential_assets_value", "commercial_assets_value", "luxury_assets_value", "bank_asset_value",
              "total_assets", "loan_to_income", "asset_to_loan", "bank_assets_to_income", "loan_per_term_year",
              "net_worth_proxy", "cibil_x_asset_coverage"]
V2_CATEGORICAL = ["education", "self_employed", "cibil_band"]


class _ImputerParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns (median fill)",
                        typeConverter=TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical columns (mode fill)",
                            typeConverter=TypeConverters.toListString)


class ExactImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Median (exact, interpolated) for numerics and mode (ties -> smallest)
    for categoricals; Spark's ``Imputer`` median is a sample quantile, not
    the interpolated median.  Fitting is the distributed baseline job."""

    @keyword_only
    def __init__(self, numericCols=None, categoricalCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ExactImputerModel":
        num = self.getOrDefault(self.numericCols)
        cat = self.getOrDefault(self.categoricalCols)
        rows = feature_baselines(df, cat, num).collect()   # one row per column: bounded
        fills = {r["feature"]: (r["category"] if r["kind"] == "categorical" else r["number"]) for r in rows}
        return ExactImputerModel(numericCols=num, categoricalCols=cat, fillJson=json.dumps(fills))


class ExactImputerModel(Model, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    fillJson = Param(Params._dummy(), "fillJson", "fill values as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, numericCols=None, categoricalCols=None, fillJson=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = json.loads(self.getOrDefault(self.fillJson))
        cols = []
        for c in df.columns:
            if c in fills:
                v = fills[c]
                cols.append(F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)).alias(c))
            else:
                cols.append(F.col(c))
        return df.select(*cols)


class _ScalerParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", typeConverter=TypeConverters.toListString)


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """``<column>_z``: (x - mean) / population deviation, divided by 1 for a
    constant column.  One aggregate; the transform is a projection."""

    @keyword_only
    def __init__(self, numericCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        num = self.getOrDefault(self.numericCols)
        r = df.agg(*[F.avg(c).alias(f"m_{c}") for c in num], *[F.stddev_pop(c).alias(f"s_{c}") for c in num]).first()
        stats = {c: (r[f"m_{c}"] or 0.0, r[f"s_{c}"] or 1.0) for c in num}
        return PopulationScalerModel(numericCols=num, statsJson=json.dumps(stats))


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    statsJson = Param(Params._dummy(), "statsJson", "mean and deviation as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, numericCols=None, statsJson=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def stats(self) -> dict[str, tuple[float, float]]:
        return {c: tuple(v) for c, v in json.loads(self.getOrDefault(self.statsJson)).items()}

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_z": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats().items()})


class V2Features(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The engineered columns of the v2 layout, so that a saved model scores raw rows."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_v2_features(df)


def layout_stages(features, numeric, categorical) -> list:
    """Stages whose fitted form turns raw rows into ``plain`` and ``scaled`` vectors
    (the same slots: numeric columns, then the levels of each categorical one)."""
    idx, ohe = [f"{c}_idx" for c in categorical], [f"{c}_ohe" for c in categorical]
    return [features,
            ExactImputer(numericCols=list(numeric), categoricalCols=list(categorical)),
            PopulationScaler(numericCols=list(numeric)),
            StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            # the indexer puts unseen levels last and the encoder drops the last slot: all zeros
            OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error"),
            VectorAssembler(inputCols=list(numeric) + ohe, outputCol="plain", handleInvalid="keep"),
            VectorAssembler(inputCols=[f"{c}_z" for c in numeric] + ohe, outputCol="scaled", handleInvalid="keep")]


def v1_stages() -> list:
    return layout_stages(SQLTransformer(statement=V1_FEATURE_SQL), V1_NUMERIC, V1_CATEGORICAL)


def v2_stages() -> list:
    return layout_stages(V2Features(), V2_NUMERIC, V2_CATEGORICAL)


def build_pipeline(estimators: list) -> Pipeline:
    """The v1 layout with estimators that read ``plain`` or ``scaled``."""
    return Pipeline(stages=v1_stages() + estimators)
