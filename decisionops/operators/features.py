"""Engineered features (row-local projections, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip

BAND_EDGES = [(499, "weak"), (649, "fair"), (749, "good")]  # right-closed; above -> excellent


def _num(c: str) -> Column:
    return F.expr(f"try_cast(`{c}` AS DOUBLE)")


def add_v1_features(df: DataFrame, fill_income_nulls: bool = True) -> DataFrame:
    """total_income, log_total_income, log_loan_amount, loan_to_annual_income,
    monthly_principal_proxy.  Zero denominators give NULL (no ANSI error).

    ``fill_income_nulls=False`` is the exploratory variant where a missing
    income makes the total missing."""
    a, c = _num("applicant_income"), _num("coapplicant_income")
    loan, term = _num("loan_amount"), _num("loan_amount_term")
    total = (F.coalesce(a, F.lit(0.0)) + F.coalesce(c, F.lit(0.0))) if fill_income_nulls else (a + c)
    df = df.withColumn("total_income", total)
    t = F.col("total_income")
    return df.select(
        "*",
        F.log(F.lit(1.0) + clip(t, 0.0)).alias("log_total_income"),
        F.log(F.lit(1.0) + clip(loan, 0.0)).alias("log_loan_amount"),
        (loan * 1000.0 / F.nullif(t * 12.0, F.lit(0.0))).alias("loan_to_annual_income"),
        (loan * 1000.0 / F.nullif(term, F.lit(0.0))).alias("monthly_principal_proxy"))


def cibil_band(c: Column) -> Column:
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, name in BAND_EDGES:
        out = out.when(c <= edge, F.lit(name))
    return out.otherwise(F.lit("excellent"))


def add_v2_features(df: DataFrame) -> DataFrame:
    """Asset totals and ratios, inputs clipped at 0, right-closed score band."""
    income = clip(_num("income_annum"), 0.0)
    loan = clip(_num("loan_amount"), 0.0)
    term = clip(_num("loan_term"), 1.0)
    cibil = _num("cibil_score")
    for col in ("residential_assets_value", "commercial_assets_value",
                "luxury_assets_value", "bank_asset_value"):
        df = df.withColumn(col, clip(_num(col), 0.0))
    total_assets = (F.coalesce(F.col("residential_assets_value"), F.lit(0.0))
                    + F.coalesce(F.col("commercial_assets_value"), F.lit(0.0))
                    + F.coalesce(F.col("luxury_assets_value"), F.lit(0.0))
                    + F.coalesce(F.col("bank_asset_value"), F.lit(0.0)))
    df = (df.withColumn("total_assets", total_assets)
            .withColumn("loan_to_income", loan / (income + 1.0))
            .withColumn("asset_to_loan", F.col("total_assets") / (loan + 1.0))
            .withColumn("bank_assets_to_income", F.col("bank_asset_value") / (income + 1.0))
            .withColumn("loan_per_term_year", loan / term)
            .withColumn("net_worth_proxy", F.col("total_assets") - loan))
    return (df.withColumn("cibil_x_asset_coverage",
                          cibil * F.log(F.lit(1.0) + clip(F.col("asset_to_loan"), 0.0)))
              .withColumn("cibil_band", cibil_band(cibil)))
