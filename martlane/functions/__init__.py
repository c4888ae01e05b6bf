"""Column-level functions (all built-in Spark expressions, no UDFs)."""

from martlane.functions.scalar import (
    age_365,
    age_band,
    alert_id,
    create_date,
    create_hour,
    epoch_ms,
    log_date,
    log_hour,
    mask_tel,
    prev_day,
    ratio1,
    sku_price,
    tokens,
)

__all__ = [
    "age_365", "age_band", "alert_id", "create_date", "create_hour", "epoch_ms",
    "log_date", "log_hour", "mask_tel", "prev_day", "ratio1", "sku_price", "tokens",
]
