"""Settings of the pipeline, passed explicitly to every model."""

from __future__ import annotations

from dataclasses import dataclass

LABELS = ("on_time", "upload_fault", "delivery_fault", "timing_gap", "unattributed")


# Fixed values of the contract: the defaults that published results rest on.
@dataclass(frozen=True)
class Params:
    skew_max_min: int = 5
    delivery_grace_min: int = 10
    unattributed_max: float = 0.10
    retention_days: int = 28
    feature_window_days: int = 30
    max_user_shift_min: int = 120
    shrinkage_pseudo_count: int = 5
    model_version: str = "v1"
    lookback_days: int = 5
    source_prune_margin_days: int = 5
    dim_user: str = "dim_user"
    schema_prefix: str = ""
