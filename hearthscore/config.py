"""Domain constants and model settings."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Labels and midpoints as they occur in the source data.
INCOME_MIDPOINTS = {
    "Under 10K": 5000,
    "10-19,999": 15000,
    "20-29,999": 25000,
    "30-39,999": 35000,
    "40-49,999": 45000,
    "50-59,999": 55000,
    "60-69,999": 65000,
    "70-79,999": 75000,
    "80-89,999": 85000,
    "90-99,999": 95000,
    "100-149,999": 125000,
    "150 - 174,999": 162500,
    "175 - 199,999": 187500,
    "200 - 249,999": 225000,
    "250K+": 275000,
}
CREDIT_MIDPOINTS = {
    "499 & Less": 400,
    "500-549": 525,
    "550-599": 575,
    "600-649": 625,
    "650-699": 675,
    "700-749": 725,
    "750-799": 775,
    "800+": 825,
}
CHILDREN_COUNTS = {
    "No children": 0,
    "One Child": 1,
    "Two Children": 2,
    "Three Children": 3,
    "Four Children": 4,
    "Five Children": 5,
    "Six Children": 6,
}
YES_NO = {"Y": 1, "N": 0, "Yes": 1, "No": 0}
KEEP_STATUS = ("ACTIVE", "PENDING")

# Columns no model may see: a protected attribute, an unusable one, and three
# that are only filled once a member has left.
EXCLUDED = (
    "race",
    "reason_joined",
    "cancel_date",
    "cancel_reason",
    "months_from_join_to_cancel",
)

# Non-product columns the engine reads.
MEMBER_COLUMNS = (
    "member_key",
    "household_key",
    "zip",
    "number_of_children",
    "length_of_residence",
    "mail_responder",
    "home_owner",
    "income",
    "dwelling_type",
    "credit_ranges",
    "do_not_direct_mail_solicit",
    "email_available",
    "ers_ent_count_year_1",
    "ers_ent_count_year_2",
    "ers_ent_count_year_3",
    "ers_member_cost_year_1",
    "ers_member_cost_year_2",
    "ers_member_cost_year_3",
    "member_status",
    "member_tenure_years",
    "member_type",
    "mosaic_household",
    "mosaic_global_household",
    "kcl_b_ind_mosaicsgrouping",
    "sc_date",
    "total_cost",
)

# Cost-derived columns a cost model must not see (regular expressions).
COST_LEAKAGE = (
    r"^cost_\d{4}",
    "ers_member_cost",
    "avg_cost_per_call",
    "total_cost",
    "cost_trend",
)

MISSING_LABEL = "Not Set"
NURTURE_LABEL = "Nurture — no immediate offer"
SEGMENT_LABELS = {
    "multi_product": "Loyal Multi-Product Members",
    "heavy_use": "High ERS Utilizers",
    "high_income": "High-Income Prospects",
    "long_tenure": "Long-Tenure Single-Product",
    "dominant": "{} Aficionados",
    "other": "General Segment {}",
}
# --- end of fixed values ----------------------------------------------------

MODE_COLUMNS = (
    "zip",
    "home_owner",
    "dwelling_type",
    "mosaic_household",
    "mosaic_global_household",
    "kcl_b_ind_mosaicsgrouping",
)
MEAN_COLUMNS = (
    "length_of_residence",
    "member_tenure_years",
    "income",
    "credit_ranges",
    "number_of_children",
    "mail_responder",
    "email_available",
    "do_not_direct_mail_solicit",
)
CALL_COLUMNS = tuple(
    f"{stem}_year_{i}" for i in (1, 2, 3) for stem in ("ers_ent_count", "ers_member_cost")
)
FLAG_SUFFIX = "_flag"


@dataclass(frozen=True)
class BoostSettings:
    rounds: int = 300
    depth: int = 4
    step: float = 0.05
    row_share: float = 0.8
    column_share: str = "0.8"
    min_rows: int = 20


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 200
    depth: int = 8
    min_rows: int = 15
    columns: str = "sqrt"


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    min_penetration: float = 0.05
    min_positives: int = 20
    test_share: float = 0.20
    validation_share: float = 0.10
    folds: int = 5
    min_propensity: float = 0.15
    contact_share: float = 0.10
    contact_cost: int = 10
    balanced: bool = True
    # False keeps the product's own flag inside product_count, as a literal
    # reading of the feature would; True removes it (no target leakage).
    leave_one_out: bool = True
    boost: BoostSettings = field(default_factory=BoostSettings)
    forest: ForestSettings = field(default_factory=ForestSettings)
    logistic_iterations: int = 1000
    ridge_alphas: tuple[float, ...] = (0.01, 0.1, 1.0, 10.0, 100.0)
    huber_epsilon: float = 1.35
    huber_iterations: int = 500
    cost_forest: ForestSettings = field(
        default_factory=lambda: ForestSettings(trees=200, depth=6, min_rows=20, columns="all")
    )
    cost_boost: BoostSettings = field(
        default_factory=lambda: BoostSettings(
            rounds=200, depth=4, step=0.05, row_share=1.0, column_share="all", min_rows=20
        )
    )
    segment_range: tuple[int, ...] = tuple(range(2, 12))
    segments: int = 8
    sweep_starts: int = 10
    segment_starts: int = 20
    segment_iterations: int = 500
    fit_threads: int = 4


# Same methods, fewer rounds: keeps routine checks of the model queries short.
SHORT_RUN = Settings(
    boost=BoostSettings(rounds=10),
    forest=ForestSettings(trees=20),
    logistic_iterations=100,
    huber_iterations=50,
    cost_forest=ForestSettings(trees=20, depth=6, min_rows=20, columns="all"),
    cost_boost=BoostSettings(rounds=10, row_share=1.0, column_share="all"),
    segment_range=(2, 3, 4, 5, 6, 7, 8),
    sweep_starts=1,
    segment_starts=2,
)


def products_in(columns) -> list[str]:
    """Product names, taken from the ``*_flag`` columns of a raw frame."""
    return [c[: -len(FLAG_SUFFIX)] for c in columns if c.endswith(FLAG_SUFFIX)]
