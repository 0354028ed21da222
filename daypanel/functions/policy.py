"""Sell rules.

A rule is written with comparison operators only, so the same method serves
DataFrame columns and the arrays inside a Python task. Subclass and override
``signals`` to plug in another rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from daypanel import schema

MODES = ("code", "documented")


@dataclass(frozen=True)
class Policy:
    """``code`` keeps the comparisons existing results were made with;
    ``documented`` is what their description says (sell on a fall of more than
    delta; sell when the price stayed within delta)."""

    stop_loss_delta: float = schema.STOP_LOSS_DELTA
    plateau_delta: float = schema.PLATEAU_DELTA
    mode: str = "code"

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {self.mode!r}")

    def stop_loss(self, entry, today):
        floor = entry - self.stop_loss_delta
        return today > floor if self.mode == "code" else today < floor

    def plateau(self, entry, today):
        if self.mode == "code":
            return today > entry + self.plateau_delta
        return ((today - entry) <= self.plateau_delta) & ((entry - today) <= self.plateau_delta)

    def signals(self, entry, today):
        """(reason, condition) pairs; the first condition that holds decides."""
        return [("STOP_LOSS", self.stop_loss(entry, today)),
                ("PLATEAU", self.plateau(entry, today))]


def fired(condition: Column) -> Column:
    """A signal with a missing price on either side does not fire."""
    return F.coalesce(condition, F.lit(False))


def sell_reason(policy: Policy, entry: Column, today: Column) -> Column:
    """Name of the rule that sells the position, NULL to keep it."""
    pairs = policy.signals(entry, today)
    reason = F.lit(None).cast("string")
    for name, condition in reversed(pairs):
        reason = F.when(condition, F.lit(name)).otherwise(reason)
    return reason
