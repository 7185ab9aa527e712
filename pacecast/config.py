"""Run parameters, passed as plain values instead of widgets or a config server."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

# Names and defaults that callers of the existing jobs rely on.
TARGET_PREFIX = {"REVENUE": "RV", "ROOMS": "RM", "ADR": "ADR"}
NO_SHOW = "No-show"
PMS_CHANNEL = "PMS"
SENTINEL_DATE = date(1900, 1, 1)


@dataclass(frozen=True)
class RunConfig:
    target_type: str = "REVENUE"
    model_start: date = date(1990, 1, 1)
    partition_date: date | None = None
    without_pms: bool = False
    horizon: int = 28
    lead_window: int = 100
    snapshots: int | None = None  # None: as many as the distances read
    lags: tuple[int, ...] = (1, 7, 14, 28)
    quantiles: tuple[float, ...] = (0.1, 0.5, 0.9)
    pace_features: int | None = None
    recursive: bool = False
    cancel_aware: bool = True  # False: plain pace of confirmed bookings, the same in every snapshot
    pipeline: str = "main_training_pipeline"  # whose exclusions hold
    targets_by_status: bool = False  # True: targets count every booking of a confirmed status, cancelled later or not
    filter_bits: int = 0  # above 0: size of a filter of cancelled ids; bookings it rules out skip the exchange

    def __post_init__(self):
        target_prefix(self.target_type)
        check_quantiles(self.quantiles)
        if self.targets_by_status and not self.cancel_aware:
            raise ValueError("targets by status stand beside cancel-aware features")
        if self.snapshots is None:
            object.__setattr__(self, "snapshots", self.snapshots_read)
        if self.snapshots < self.snapshots_read:
            raise ValueError(f"distances up to {max(self.distances)} read {self.snapshots_read} snapshots, not {self.snapshots}")
        if max(max(self.distances) + 1, self.targets) > self.lead_window:
            raise ValueError(f"distances and targets cannot reach past the lead window of {self.lead_window}")

    @property
    def distances(self) -> tuple[int, ...]:
        return tuple(range(1, self.horizon + 1))

    @property
    def targets(self) -> int:
        """Leads of the target curve that the distances ask for."""
        return self.horizon

    @property
    def snapshots_read(self) -> int:
        return self.horizon

    @property
    def prefix(self) -> str:
        return target_prefix(self.target_type)


@dataclass(frozen=True)
class FarFieldConfig(RunConfig):
    """Weekly points 91..35 days ahead, each read at snapshot `point`."""

    points: tuple[int, ...] = tuple(range(91, 34, -7))
    step: int = 7
    lead_window: int = 152
    lags: tuple[int, ...] = tuple(range(7, 148, 7))

    @property
    def distances(self) -> tuple[int, ...]:
        return tuple(self.points)

    @property
    def targets(self) -> int:
        return max(self.points) - self.step + 1

    @property
    def snapshots_read(self) -> int:
        return max(self.points) + 1


def target_prefix(target_type: str) -> str:
    if target_type not in TARGET_PREFIX:
        raise ValueError(f"target_type must be one of {sorted(TARGET_PREFIX)}, got {target_type!r}")
    return TARGET_PREFIX[target_type]


def check_quantiles(quantiles) -> None:
    if 0.5 not in quantiles:
        raise ValueError("quantiles must contain the median 0.5")
    if list(quantiles) != sorted(set(quantiles)):
        raise ValueError("quantiles must be ascending and distinct")


def evaluation_window(today: date, days: int, settle_days: int = 2) -> tuple[date, date]:
    """Scoring window of `days` days that ends `settle_days` before today."""
    end = today - timedelta(days=settle_days)
    return end - timedelta(days=days), end
