from .once import compute_once
from .scalar import (
    alert_id,
    bucket,
    capped_ratio,
    clean_name,
    finite,
    hour_of_iso,
    key_hash,
    percent_text,
    ratio,
    time_cutoff,
    try_number,
    uniform,
)

__all__ = [
    "alert_id",
    "bucket",
    "capped_ratio",
    "clean_name",
    "compute_once",
    "finite",
    "hour_of_iso",
    "key_hash",
    "percent_text",
    "ratio",
    "time_cutoff",
    "try_number",
    "uniform",
]
