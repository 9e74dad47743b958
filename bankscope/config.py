"""Calendar and business parameters shared by every operator.

Everything that the pipeline treats as a tunable constant lives in one of
two frozen dataclasses so that jobs can run over any observation window
(the fixture tables span 1995-2001, the original generator 2023-2024)
without editing operator code.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Calendar:
    """Observation window of the transaction history.

    ``end`` is ``start + obs_days``; the recency and trailing-window features
    are measured against it.  Months are indexed ``0 .. n_months-1`` from
    ``start``; transactions of other months count in all but the month grid.
    The default spans the whole of the fixture's orders.
    """

    start: _dt.date = _dt.date(1995, 1, 1)
    n_months: int = 80
    obs_days: int = 2404
    recent_days: tuple[int, int] = (30, 90)

    @property
    def end(self) -> _dt.date:
        return self.start + _dt.timedelta(days=self.obs_days)

    @property
    def cut_30(self) -> _dt.date:
        return self.end - _dt.timedelta(days=self.recent_days[0])

    @property
    def cut_90(self) -> _dt.date:
        return self.end - _dt.timedelta(days=self.recent_days[1])

    @property
    def centre(self) -> float:
        """Mean of the month indices 0..n-1, used by the closed-form slope."""
        return (self.n_months - 1) / 2.0

    @property
    def sxx(self) -> float:
        """Sum of squared centred month indices: n(n^2-1)/12 (1150 for n=24)."""
        n = self.n_months
        return n * (n * n - 1) / 12.0


# Fixed values that must equal the original pipeline's for identical results:
# segment names, cost to serve per segment (default 250), action names, the
# 3x3 risk/value decision matrix, urgency and code per action, segment labels,
# value-tier and age-band labels.
SEGMENTS = ("retail", "premium", "high_net_worth")
COST_TO_SERVE = {"retail": 180.0, "premium": 320.0, "high_net_worth": 600.0}
DEFAULT_COST_TO_SERVE = 250.0
LEVELS = ("High", "Medium", "Low")
RETAIN_PREMIUM = "Retain - Premium Offer"
RETAIN_STANDARD = "Retain - Standard Offer"
CROSS_SELL = "Cross-Sell Opportunity"
MONITOR = "Monitor"
NO_ACTION = "No Action"
ACTIONS = (RETAIN_PREMIUM, RETAIN_STANDARD, CROSS_SELL, MONITOR, NO_ACTION)
DECISION_MATRIX = {
    ("High", "High"): RETAIN_PREMIUM,
    ("High", "Medium"): RETAIN_STANDARD,
    ("High", "Low"): MONITOR,
    ("Medium", "High"): CROSS_SELL,
    ("Medium", "Medium"): MONITOR,
    ("Medium", "Low"): NO_ACTION,
    ("Low", "High"): CROSS_SELL,
    ("Low", "Medium"): NO_ACTION,
    ("Low", "Low"): NO_ACTION,
}
ACTION_URGENCY = {
    RETAIN_PREMIUM: "CRITICAL",
    RETAIN_STANDARD: "HIGH",
    CROSS_SELL: "MEDIUM",
    MONITOR: "LOW",
    NO_ACTION: "MINIMAL",
}
DEFAULT_URGENCY = "LOW"
ACTION_CODE = {
    RETAIN_PREMIUM: "RETAIN_PREMIUM",
    RETAIN_STANDARD: "RETAIN_STANDARD",
    CROSS_SELL: "CROSS_SELL",
    MONITOR: "MONITOR",
    NO_ACTION: "NO_ACTION",
}
DEFAULT_ACTION_CODE = "MONITOR"
SEGMENT_LABEL = {
    "retail": "Retail Banking",
    "premium": "Premium Banking",
    "high_net_worth": "High Net Worth",
}
VALUE_TIERS = ("Standard", "Preferred", "Premium", "Elite")
AGE_BAND_EDGES = (17, 29, 39, 49, 59, 75)
AGE_BANDS = ("18-29", "30-39", "40-49", "50-59", "60+")
CLUSTER_NAMES = ("low", "medium", "high")
# Card label, measure of the total level, and rule of its colour.
KPI_CARDS = (
    ("Total Annual Revenue", "total_revenue", "static blue"),
    ("Revenue at Risk", "total_revenue_at_risk", "rar"),
    ("Portfolio Churn Rate", "churn_rate_pct", "churn"),
    ("5-Year Customer CLV", "total_clv", "static green"),
    ("Net Portfolio Profit", "total_net_profit", "profit"),
    ("Critical Accounts", "critical_count", "static red"),
)

def _annuity(rate: float, years: int) -> float:
    return sum(1.0 / (1.0 + rate) ** t for t in range(1, years + 1))


@dataclass(frozen=True)
class Params:
    """Business parameters (defaults are the original pipeline's)."""

    margin_rate: float = 0.18
    discount_rate: float = 0.10
    clv_years: int = 5
    risk_p_high: float = 0.65
    risk_p_low: float = 0.35
    value_p_high: float = 0.75
    value_p_low: float = 0.25
    churn_label_cut: float = 0.65
    balance_decay: float = 0.60
    low_engagement: float = 0.25
    tier_ps: tuple[float, float, float] = (0.40, 0.70, 0.90)
    tercile_ps: tuple[float, float] = (0.33, 0.66)
    cost_to_serve: dict = field(default_factory=lambda: dict(COST_TO_SERVE))
    default_cost: float = DEFAULT_COST_TO_SERVE
    seed: int = 42

    @property
    def discount_factor(self) -> float:
        """Sum over t=1..years of (1+r)^-t (3.7907867694... for 10 %, 5 y)."""
        return _annuity(self.discount_rate, self.clv_years)


DEFAULT_CALENDAR = Calendar()
DEFAULT_PARAMS = Params()
