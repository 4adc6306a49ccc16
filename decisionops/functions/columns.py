"""Column expressions shared by all operators.

Every helper has a DataFrame form and, where an oracle needs it, the
matching DuckDB SQL text.  All of them are built-in JVM expressions, so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_uniform(key, salt: str) -> Column:
    """Stable uniform draw in [0, 1) from (key, salt).

    The value depends only on the row's key, never on partitioning or task
    order, so recomputation after an executor loss yields the same draw.
    """
    text = F.concat(_col(key).cast("string"), F.lit(":" + salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(TWO_POW_32)


def hash_uniform_sql(key_sql: str, salt: str) -> str:
    return (f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{salt}'), 1, 8))::BIGINT"
            f" / 4294967296.0)")


def hash_uniforms(key, salt: str, n: int = 4) -> list[Column]:
    """Up to four independent uniforms from one md5 digest (32-bit slices),
    a quarter of the hashing cost of four ``hash_uniform`` calls."""
    if not 1 <= n <= 4:
        raise ValueError("one digest yields 1..4 uniforms")
    digest = F.md5(F.concat(_col(key).cast("string"), F.lit(":" + salt)))
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") / F.lit(TWO_POW_32)
            for i in range(n)]


def hash_uniforms_sql(key_sql: str, salt: str, n: int = 4) -> list[str]:
    d = f"md5(CAST({key_sql} AS VARCHAR) || ':{salt}')"
    return [f"(('0x' || substr({d}, {1 + 8 * i}, 8))::BIGINT / 4294967296.0)" for i in range(n)]


def fround(c, n: int) -> Column:
    """Half-up rounding on the binary value: ``floor(x * 10^n + 0.5) / 10^n``.
    Used for row-level outputs whose exact value can sit on a decimal tie;
    every engine evaluates it bit-identically (unlike decimal-string
    rounding)."""
    scale = float(10 ** n)
    return F.floor(_col(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def fround_sql(x: str, n: int) -> str:
    scale = float(10 ** n)
    return f"(floor(({x}) * {scale!r} + 0.5) / {scale!r})"


def clip(c, lo=None, hi=None) -> Column:
    """Null-preserving clip (``greatest``/``least`` would turn NULL into the
    bound)."""
    c = _col(c)
    out = c
    if lo is not None:
        out = F.when(out < F.lit(float(lo)), F.lit(float(lo))).otherwise(out)
    if hi is not None:
        out = F.when(out > F.lit(float(hi)), F.lit(float(hi))).otherwise(out)
    return out


def clip_sql(x: str, lo=None, hi=None) -> str:
    out = x
    if lo is not None:
        out = f"(CASE WHEN {out} < {float(lo)!r} THEN {float(lo)!r} ELSE {out} END)"
    if hi is not None:
        out = f"(CASE WHEN {out} > {float(hi)!r} THEN {float(hi)!r} ELSE {out} END)"
    return out


def nan_to_null(c) -> Column:
    """NaN compares as the largest double in Spark; route it as missing."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def safe_number(c, fallback: float = 0.0) -> Column:
    """Non-numeric, null, NaN or infinite input -> fallback."""
    x = F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(float(fallback))).otherwise(x)


def rate(cond: Column) -> Column:
    """Share of rows where ``cond`` holds, as DOUBLE (never DECIMAL)."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


def sql_rate(cond: str) -> str:
    return f"avg(CASE WHEN {cond} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
