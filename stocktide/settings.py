"""Default parameters, in one place.

Every operator takes its parameters as arguments; the defaults come from here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Feature periods and model constants that results depend on.
LAG_PERIODS = (7, 14, 30, 60, 90)
ROLLING_WINDOWS = (7, 14, 30)
PROMO_RATIO = 0.9
YEAR_LAG = 365
HOLIDAY_WEEK_DAYS = 3
MIN_CORRELATION_PAIRS = 7

# The months in which a category peaks.
SEASONAL_PEAKS = {
    "Electronics": (11, 12),
    "Apparel": (3, 4, 9, 10),
    "Home & Garden": (4, 5, 6),
    "Health & Beauty": (1, 2, 12),
    "Grocery": (11, 12),
    "Toys & Games": (11, 12),
    "Sports & Outdoors": (5, 6, 7, 8),
    "Automotive": (3, 4, 5),
    "Office Supplies": (8, 9, 1),
    "Pet Supplies": (5, 6, 7),
}

# Columns that are never model inputs.
NON_FEATURE_COLUMNS = (
    "product_id",
    "date",
    "units_sold",
    "revenue",
    "target",
    "year",
    "week",
    "demand_change",
)


# The constants of the four classes below.
@dataclass(frozen=True)
class ForestSettings:
    """Random forest defaults. A leaf of 5 rows already implies a split of 10."""

    trees: int = 500
    max_depth: int = 20
    min_leaf_rows: int = 5
    feature_subset: str = "sqrt"
    seed: int = 42
    importance_threshold: float = 0.001
    folds: int = 5


@dataclass(frozen=True)
class EnsembleSettings:
    """Weights are kept in whole percent so that grid points are exact."""

    fixed_first_pct: int = 40
    min_pct: int = 20
    max_pct: int = 80
    step_pct: int = 5
    tuning_share: float = 0.6
    block_rows: int = 30
    mae_multiple: float = 2.0

    @property
    def grid(self) -> tuple[int, ...]:
        return tuple(range(self.min_pct, self.max_pct + 1, self.step_pct))


@dataclass(frozen=True)
class StockSettings:
    """Business constants of the positioning, risk and impact reports."""

    service_z: float = 1.65
    lead_days: int = 7
    unit_price: float = 45.0
    order_cost: float = 25.0
    holding_rate: float = 0.02
    tier_a_mean: float = 200.0
    tier_b_mean: float = 50.0
    make_to_order_cv: float = 0.8
    critical_ratio: float = 1.5
    high_ratio: float = 1.2
    medium_cv: float = 0.5
    supply_days: float = 14.0
    margin_rate: float = 0.35
    safety_stock_cut: float = 0.12
    margin_gain_pct: float = 12.0
    understock_share: float = 0.9


@dataclass(frozen=True)
class DemandSettings:
    lags: tuple[int, ...] = LAG_PERIODS
    windows: tuple[int, ...] = ROLLING_WINDOWS
    min_history_days: int = 90
    train_share: float = 0.8
    gap_days: int = 0
    horizon: int = 30
    n_products: int = 50
    min_daily_demand: float = 20.0
    target_mape: float = 10.0
    target_coverage: int = 200
    forest: ForestSettings = field(default_factory=ForestSettings)
    ensemble: EnsembleSettings = field(default_factory=EnsembleSettings)
    stock: StockSettings = field(default_factory=StockSettings)


DEFAULTS = DemandSettings()
