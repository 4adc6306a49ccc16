"""Fixed-size lists of a report: the first k rows of every list.

Rows are ranked inside their list by value (largest first), then name.  The rank
is limited where it is computed, so every task keeps at most k rows of a list
before anything is shuffled, and the final ranking sees k rows a list and task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def entries(df: DataFrame, name: str, label: Column, *order: Column, value: Column, detail: Column | None = None) -> DataFrame:
    """Rows of the list ``name``: label, value, and the sort key (larger first)."""
    keys = [k.cast("double") for k in order] or [value.cast("double")]
    second = keys[1] if len(keys) > 1 else F.lit(0.0)
    return df.select(F.lit(name).alias("list"), label.cast("string").alias("label"), value.cast("double").alias("value"),
                     (detail if detail is not None else F.lit(None)).cast("string").alias("detail"),
                     keys[0].alias("_first"), second.alias("_second"))


def top_lists(parts: list[DataFrame], sizes: dict[str, int], floors: dict[str, float]) -> DataFrame:
    """(list, rank, label, value, relative_to_max, detail): the first ``sizes[list]`` entries of
    every list; the relative value is against the whole list's maximum (at least ``floors[list]``,
    negative values count as 0)."""
    rows = reduce(DataFrame.unionByName, parts)
    floor = F.coalesce(*[F.when(F.col("list") == name, F.lit(v)) for name, v in floors.items()], F.lit(1.0))
    most_of = rows.groupBy("list").agg(F.max("value").alias("_max"))             # one row a list
    order = (F.col("_first").desc(), F.col("_second").desc(), "label")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("list").orderBy(*order)))
    most = F.coalesce(*[F.when(F.col("list") == name, F.lit(k)) for name, k in sizes.items()], F.lit(0))
    kept = ranked.where(F.col("rank") <= max(sizes.values())).where(F.col("rank") <= most)
    relative = F.greatest(F.lit(0.0), F.col("value")) / F.greatest(F.col("_max"), floor)
    return kept.join(F.broadcast(most_of), "list").select("list", "rank", "label", "value",
                                                          F.round(relative, 6).alias("relative_to_max"), "detail")
