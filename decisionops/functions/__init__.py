from .columns import (  # noqa: F401
    clip, clip_sql, hash_uniform, hash_uniform_sql, safe_number, nan_to_null,
    rate, sql_rate,
)
