"""Versioned business rules as frozen dataclasses; operators turn them into columns."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RiskTerm:
    """One scored condition: `points` when `column <op> threshold` holds, else 0."""

    column: str
    op: str  # ">", "<" or "in"
    threshold: float | tuple[int, ...]
    points: int


# The version 1.0 risk score.
RISK_TERMS_V1 = (
    RiskTerm("dti", ">", 0.4, 3),
    RiskTerm("Credit_Utilization_Ratio", ">", 0.5, 2),
    RiskTerm("Credit_Mix_ID", "in", (3, 99), 2),
    RiskTerm("Credit_History_Months", "<", 24, 1),
    RiskTerm("Changed_Credit_Limit", ">", 15, 1),
    RiskTerm("Num_Credit_Inquiries", ">", 10, 1),
)


@dataclass(frozen=True)
class RiskRule:
    version: str = "1.0"
    terms: tuple[RiskTerm, ...] = RISK_TERMS_V1


@dataclass(frozen=True)
class LabelRule:
    """Delinquency label thresholds. `crs = 0` switches the risk-score condition off."""

    version: str = "1.0"
    dpd: int = 30
    mob: int = 6
    dsl: int = 10
    crs: int = 0
    risk: RiskRule = field(default_factory=RiskRule)

    @property
    def primary_def(self) -> str:
        base = f"{self.dpd}dpd_{self.mob}mob"
        return f"{base}_{self.crs}crs" if self.crs else base

    @property
    def primary_version(self) -> str:
        return f"{self.version}_crs{self.risk.version}" if self.crs else self.version

    @property
    def surrogate_def(self) -> str:
        return f"{self.dsl}dsl_0mob"


@dataclass(frozen=True)
class PerformanceLimits:
    auc_min: float = 0.62
    gini_min: float = 0.24
    accuracy_min: float = 0.70
    logloss_max: float = 0.60


@dataclass(frozen=True)
class DriftLimits:
    psi_warn: float = 0.10
    psi_alert: float = 0.25
    csi_warn: float = 0.10
    csi_alert: float = 0.25


@dataclass(frozen=True)
class TrainingWindow:
    """Months and ratio that place train, test and out-of-time rows around a train date."""

    train_test_months: int = 12
    oot_months: int = 2
    train_ratio: float = 0.8
    label_shift_months: int = 6
    seed: int = 88


RETRAIN_POLICY = ("PERF_BELOW", "PSI_ALERT", "CSI_ALERT")
