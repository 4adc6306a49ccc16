"""Stable hash enrichment for operational fields a table lacks.

Every draw is a uniform from ``hash_uniforms(id, salt)``: a function of the
row key only, so results do not depend on partitioning, task order or
retries (a lost executor recomputes the same values).  The helpers below
turn a uniform column into the wanted distribution; each has a DuckDB twin.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cumulative(weights) -> list[float]:
    """Running sums, accumulated left to right in double precision."""
    out, acc = [], 0.0
    for w in weights:
        acc += w
        out.append(acc)
    return out


def weighted_choice(u: Column, choices, weights) -> Column:
    """First choice whose running weight is >= u; the last choice is the
    fallback when rounding leaves the total below u."""
    cum = cumulative(weights)
    out = None
    for name, c in zip(choices, cum):
        out = F.when(u <= F.lit(c), F.lit(name)) if out is None else out.when(u <= F.lit(c), F.lit(name))
    return out.otherwise(F.lit(choices[-1]))


def weighted_choice_sql(u: str, choices, weights) -> str:
    cum = cumulative(weights)
    parts = [f"WHEN {u} <= {c!r} THEN '{n}'" for n, c in zip(choices, cum)]
    return "(CASE " + " ".join(parts) + f" ELSE '{choices[-1]}' END)"


def gamma2(u1: Column, u2: Column, scale: float) -> Column:
    """Gamma(shape=2, scale) as the exact sum of two exponentials:
    ``-scale * ln((1-u1)(1-u2))``; ``1-u`` lies in (0, 1]."""
    return F.lit(-float(scale)) * F.log((F.lit(1.0) - u1) * (F.lit(1.0) - u2))


def gamma2_sql(u1: str, u2: str, scale: float) -> str:
    return f"({-float(scale)!r} * ln((1.0 - {u1}) * (1.0 - {u2})))"


def int_between(u: Column, lo: int, hi_inclusive: int) -> Column:
    return (F.lit(lo) + F.floor(u * (hi_inclusive - lo + 1))).cast("int")


def int_between_sql(u: str, lo: int, hi_inclusive: int) -> str:
    return f"CAST({lo} + floor({u} * {hi_inclusive - lo + 1}) AS INTEGER)"


def pick(u: Column, names) -> Column:
    """Uniform pick from a fixed list (1-based ``element_at``)."""
    idx = (F.floor(u * len(names)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx)


def pick_sql(u: str, names) -> str:
    arr = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    return f"{arr}[CAST(floor({u} * {len(names)}) AS INTEGER) + 1]"
