"""Window durations."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class WindowConfig:
    """Size, hop and lateness of the averages, in seconds."""

    size: int = 300
    step: int = 60
    expires: int = 600

    def __post_init__(self) -> None:
        if self.size <= 0 or self.step <= 0 or self.expires < 0:
            raise ValueError(f"durations must be positive: {self}")
        if self.step > self.size:
            raise ValueError(f"a hop longer than the window would lose readings: {self}")

    @property
    def shares_panes(self) -> bool:
        """Whether every window is a whole number of hops, so that hop-sized sums can be combined."""
        return self.size % self.step == 0

    @property
    def pane(self) -> int:
        """The longest span that divides size and hop."""
        return math.gcd(self.size, self.step)

    @classmethod
    def from_env(cls, environ: Mapping[str, str]) -> WindowConfig:
        """The demo preset when DEMO_MODE is on, else the default, with single durations overridden by
        WINDOW_SIZE_SECONDS, HOPPING_STEP_SECONDS and WINDOW_EXPIRES_SECONDS."""
        demo = environ.get("DEMO_MODE", "").lower() in ("1", "true", "yes")
        preset = DEMO_WINDOWS if demo else DEFAULT_WINDOWS
        return cls(
            size=int(environ.get("WINDOW_SIZE_SECONDS", preset.size)),
            step=int(environ.get("HOPPING_STEP_SECONDS", preset.step)),
            expires=int(environ.get("WINDOW_EXPIRES_SECONDS", preset.expires)),
        )


DEFAULT_WINDOWS = WindowConfig()
DEMO_WINDOWS = WindowConfig(size=30, step=10, expires=120)


def seconds(value: int) -> str:
    return f"{value} seconds"
