"""Every business constant of a run, in one immutable record."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Params:
    # These defaults must equal the recorded business rules.
    completed_status: str = "delivered"
    voucher_type: str = "voucher"
    unknown_category: str = "unknown"
    fallback_median_gap: float = 45.0
    gap_multiple: int = 2
    min_churn_threshold: int = 60
    recent_days: int = 90
    prior_days: int = 180
    split_date: date = date(2018, 3, 1)
    lifespan_years: float = 2.0
    gross_margin: float = 0.20
    days_per_year: float = 365.25
    min_tenure_days: int = 90
    target_recall: float = 0.80
    threshold_floor: float = 0.3
    threshold_ceiling: float = 0.7
    lr_threshold: float = 0.5
    sweep_from_pct: int = 10
    sweep_to_pct: int = 90
    pivot_periods: int = 12
    sample_size: int = 5000
    sample_seed: int = 42
    cost_per_customer: float = 5.0
    z_95: float = 1.96
    model_seed: int = 42
    max_iter: int = 1000
    n_trees: int = 100
    tree_depth: int = 6
    tree_bins: int = 128  # split candidates per feature; also sets how many rows place them

    tree_bootstrap: bool = True  # each tree on its own draw of the training rows
    lr_tolerance: float = 1e-10

    # Choices the caller makes explicitly.
    category_pick: str = "lowest"  # or "equals_one"
    risk_threshold: float = 0.5
    arm_salt: str = ":s1"
    treatment_pct: int = 50
    outcome_days: int = 180
