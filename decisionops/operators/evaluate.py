"""Evaluation metrics as grouped aggregates.

Every metric is computed from per-group confusion counts (one partial
aggregation), so evaluating many models / folds / slices at once is one
grouped job over a long table, never a loop of collects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .globalrank import exact_quantiles, rank_sum_auc


def confusion_counts(df: DataFrame, y: str, yhat: Column | str, group_cols=()) -> DataFrame:
    yhat = F.col(yhat) if isinstance(yhat, str) else yhat
    yy, pp = F.col(y) == 1, yhat == 1
    return df.groupBy(*group_cols).agg(
        F.count_if(~yy & ~pp).alias("tn"), F.count_if(~yy & pp).alias("fp"),
        F.count_if(yy & ~pp).alias("fn"), F.count_if(yy & pp).alias("tp"))


def _div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def metric_columns(balanced_mode: str = "zero") -> list[Column]:
    """accuracy, balanced accuracy, precision(1), recall(1), recall(0), F1(1)
    from tn/fp/fn/tp; 0 where a denominator is 0.  ``balanced_mode``:
    'zero' averages both recalls (an absent class counts 0), 'present'
    averages only over classes present in the truth."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    rec1, rec0 = _div(tp, tp + fn), _div(tn, tn + fp)
    prec = _div(tp, tp + fp)
    if balanced_mode == "present":
        npres = (F.when(tp + fn > 0, 1).otherwise(0) + F.when(tn + fp > 0, 1).otherwise(0))
        bal = _div(F.when(tp + fn > 0, rec1).otherwise(0.0) + F.when(tn + fp > 0, rec0).otherwise(0.0),
                   npres.cast("double"))
    else:
        bal = (rec1 + rec0) / 2.0
    f1 = _div(2 * prec * rec1, prec + rec1)
    return [_div(tp + tn, n).alias("accuracy"), bal.alias("balanced_accuracy"), prec.alias("precision"),
            rec1.alias("recall"), rec0.alias("recall_0"), f1.alias("f1")]


def classification_metrics(df: DataFrame, y: str, score: str, threshold: float = 0.5,
                           group_cols=(), balanced_mode: str = "zero") -> DataFrame:
    c = confusion_counts(df, y, (F.col(score) >= threshold).cast("int"), group_cols)
    return c.select(*group_cols, "tn", "fp", "fn", "tp", *metric_columns(balanced_mode))


def confusion_long(df: DataFrame, y: str, score: str, threshold: float = 0.5) -> DataFrame:
    """(actual, predicted, count) on the full 2x2 skeleton (zeros kept)."""
    c = confusion_counts(df, y, (F.col(score) >= threshold).cast("int"))
    cells = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(k).alias("count"))
                      for a, p, k in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return c.select(F.explode(cells).alias("c")).select("c.*")


def brier(df: DataFrame, y: str, score: str, group_cols=()) -> DataFrame:
    return df.groupBy(*group_cols).agg(F.avg(F.pow(F.col(score) - F.col(y), 2)).alias("brier"))


def auc(df: DataFrame, y: str, score: str, group_cols=()) -> DataFrame:
    return rank_sum_auc(df, score, y, list(group_cols))


def class_balance(df: DataFrame, y: str) -> DataFrame:
    return df.agg(F.count_if(F.col(y) == 1).alias("approved"), F.count_if(F.col(y) == 0).alias("rejected"),
                  F.avg(F.col(y).cast("double")).alias("approval_rate"))


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """'balanced' weights n / (2 * count(class)) -- a 2-row table to join
    (broadcast) onto rows as a ``weightCol``."""
    c = df.where(F.col(y).isNotNull()).groupBy(y).agg(F.count(F.lit(1)).alias("count"))
    tot = c.agg(F.sum("count").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return c.crossJoin(tot).select(F.col(y).alias("label"), "count",
                                   (F.col("_n") / (F.col("_k") * F.col("count"))).alias("weight"))


def fairness_slices(df: DataFrame, y: str, score: str, attributes, threshold: float = 0.5,
                    min_group: int = 10, by=()) -> DataFrame:
    """Per (attribute, group), and per value of the columns ``by``: n, actual / predicted rate, mean score,
    balanced accuracy (over classes present), recall(1), recall(0).  One
    aggregation over (attribute, group) pairs; groups under ``min_group``
    rows are dropped; a null group is 'Missing'."""
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"),
                                         F.coalesce(F.col(a).cast("string"), F.lit("Missing")).alias("group"))
                                for a in attributes]))
    pred = (F.col(score) >= threshold).cast("int")
    x = df.select(*by, pairs.alias("g"), F.col(y).alias("_y"), pred.alias("_p"), F.col(score).alias("_s"))
    yy, pp = F.col("_y") == 1, F.col("_p") == 1
    g = x.groupBy(*by, F.col("g.attribute").alias("attribute"), F.col("g.group").alias("group")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("_y").cast("double")).alias("actual_rate"),
        F.avg(F.col("_p").cast("double")).alias("predicted_rate"), F.avg("_s").alias("mean_score"),
        F.count_if(~yy & ~pp).alias("tn"), F.count_if(~yy & pp).alias("fp"),
        F.count_if(yy & ~pp).alias("fn"), F.count_if(yy & pp).alias("tp"))
    _, bal, _, rec1, rec0, _ = metric_columns("present")
    return g.where(F.col("n") >= min_group).select(
        *by, "attribute", "group", "n", "actual_rate", "predicted_rate", "mean_score", bal, rec1, rec0)


def fairness_gaps(slices: DataFrame, attribute: str, groups=("Female", "Male")) -> DataFrame:
    """max - min of predicted rate, recall(1), recall(0) between two groups;
    empty unless both groups are present."""
    s = slices.where((F.col("attribute") == attribute) & F.col("group").isin(*groups))
    a = s.agg(F.count(F.lit(1)).alias("_k"),
              (F.max("predicted_rate") - F.min("predicted_rate")).alias("demographic_parity_gap"),
              (F.max("recall") - F.min("recall")).alias("equal_opportunity_gap"),
              (F.max("recall_0") - F.min("recall_0")).alias("rejection_recall_gap"))
    return a.where(F.col("_k") == len(groups)).drop("_k")


def feature_baselines(df: DataFrame, categorical, numeric) -> DataFrame:
    """Mode of each categorical (ties -> smallest value, none -> 'Unknown')
    and exact median of each numeric (none -> 0), as (feature, kind,
    category, number).  Long-form grouped aggregates."""
    spark = df.sparkSession
    parts = []
    if categorical:
        parts.append(_modes(df, categorical))
    if numeric:
        parts.append(_medians(df, numeric))
    if not parts:
        raise ValueError("no columns")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _modes(df: DataFrame, categorical) -> DataFrame:
    spark = df.sparkSession
    cat = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v"))
                                        for c in categorical])).alias("p")).select("p.*")
    counts = cat.where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("c"))
    modes = counts.groupBy("feature").agg(F.min_by("v", F.struct(-F.col("c"), F.col("v"))).alias("category"))
    names = spark.createDataFrame([(c,) for c in categorical], "feature string")
    modes = names.join(modes, "feature", "left").select(
        "feature", F.lit("categorical").alias("kind"), F.coalesce("category", F.lit("Unknown")).alias("category"),
        F.lit(None).cast("double").alias("number"))
    return modes


def _medians(df: DataFrame, numeric) -> DataFrame:
    spark = df.sparkSession
    num = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"))
                                        for c in numeric])).alias("p")).select("p.*")
    med = exact_quantiles(num, "v", [0.5], ["feature"]).select("feature", F.col("value").alias("number"))
    nnames = spark.createDataFrame([(c,) for c in numeric], "feature string")
    meds = nnames.join(med, "feature", "left").select(
        "feature", F.lit("numeric").alias("kind"), F.lit(None).cast("string").alias("category"),
        F.coalesce("number", F.lit(0.0)).alias("number"))
    return meds


def mean_std_over_folds(fold_metrics: DataFrame, group_cols, metrics) -> DataFrame:
    """Mean and population std of each metric over folds."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return fold_metrics.groupBy(*group_cols).agg(*aggs)
