"""Load profiles: events per second as a function of the seconds since the run began.

A profile has a rate at each moment and, in closed form, the mean of that rate over a run,
both never below ``MIN_RATE``; make a ``Profile`` of two such functions to add one.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The lowest rate of any profile, and where in a run the spike begins.
MIN_RATE = 0.1
SPIKE_BEGINS = 0.4


@dataclass(frozen=True)
class Profile:
    """``rate(elapsed)``, not yet floored, and ``events(duration)``: the floored rate summed over a run."""

    rate: Callable[[Column], Column]
    events: Callable[[Column], Column]

    def __call__(self, elapsed: Column) -> Column:
        return self.rate(elapsed)


def _floor(rate) -> float:
    return max(float(rate), MIN_RATE)


def steady(rate: float) -> Profile:
    return Profile(lambda elapsed: F.lit(float(rate)) + elapsed * 0, lambda d: _floor(rate) * d)


def burst(
    baseline_rate: float, burst_rate: float, burst_duration_s: float = 2.0, burst_interval_s: float = 10.0
) -> Profile:
    """Starts with a burst; the pause between bursts lasts ``burst_interval_s``."""
    cycle = float(burst_duration_s + burst_interval_s)

    def rate(elapsed: Column) -> Column:
        bursting = F.pmod(elapsed, F.lit(cycle)) < burst_duration_s
        return F.when(bursting, float(burst_rate)).otherwise(float(baseline_rate))

    def events(d: Column) -> Column:
        in_bursts = F.floor(d / cycle) * burst_duration_s + F.least(F.pmod(d, F.lit(cycle)), F.lit(float(burst_duration_s)))
        return in_bursts * _floor(burst_rate) + (d - in_bursts) * _floor(baseline_rate)

    return Profile(rate, events)


def _ramp(start_rate: float, end_rate: float, duration_s) -> Profile:
    a, b = float(start_rate), float(end_rate)

    def events(d: Column) -> Column:
        whole = F.lit(duration_s) if not isinstance(duration_s, Column) else duration_s
        t = F.least(d, whole)
        # above the floor a line goes from ``u`` to ``v``; where one of them is below, a triangle is left
        u, v = F.lit(a - MIN_RATE), F.lit(a - MIN_RATE) + (b - a) * t / whole
        up, down = F.greatest(u, F.lit(0.0)), F.greatest(v, F.lit(0.0))
        even = (up + down) / 2 * t
        cut = F.greatest(up, down) * F.greatest(up, down) / (2 * F.abs(v - u)) * t
        above = F.when((u < 0) & (v < 0), 0.0).when((u < 0) | (v < 0), cut).otherwise(even)
        return MIN_RATE * t + above + _floor(b) * (d - t)

    return Profile(lambda elapsed: a + (b - a) * F.least(elapsed / duration_s, F.lit(1.0)), events)


def ramp_up(start_rate: float, end_rate: float, duration_s) -> Profile:
    return _ramp(start_rate, end_rate, duration_s)


def ramp_down(start_rate: float, end_rate: float, duration_s) -> Profile:
    return _ramp(start_rate, end_rate, duration_s)


def spike(baseline_rate: float, spike_rate: float, duration_s, spike_duration_s: float = 3.0) -> Profile:
    begins = SPIKE_BEGINS * duration_s

    def rate(elapsed: Column) -> Column:
        inside = (elapsed >= begins) & (elapsed < begins + spike_duration_s)
        return F.when(inside, float(spike_rate)).otherwise(float(baseline_rate))

    def events(d: Column) -> Column:
        inside = F.least(F.greatest(d - begins, F.lit(0.0)), F.lit(float(spike_duration_s)))
        return inside * _floor(spike_rate) + (d - inside) * _floor(baseline_rate)

    return Profile(rate, events)


def sinusoidal(min_rate: float, max_rate: float, period_s: float = 20.0) -> Profile:
    middle, swing = (min_rate + max_rate) / 2, (max_rate - min_rate) / 2
    turn = 2 * math.pi

    def rate(elapsed: Column) -> Column:
        return middle + swing * F.sin(elapsed * (turn / period_s))

    def above(angle: Column) -> Column:
        """Integral of what lies above the floor, from 0 up to an angle within one turn."""
        if min(min_rate, max_rate) >= MIN_RATE:
            spans = [(0.0, turn)]
        elif max(min_rate, max_rate) <= MIN_RATE:
            spans = []
        else:
            at = math.asin((MIN_RATE - middle) / swing)  # the sine that meets the floor
            low, high = sorted(((at % turn), ((math.pi - at) % turn)))
            inside = middle + swing * math.sin((low + high) / 2) > MIN_RATE
            spans = [(low, high)] if inside else [(0.0, low), (high, turn)]
        total = F.lit(0.0)
        for lo, hi in spans:
            a, b = F.least(angle, F.lit(lo)), F.least(angle, F.lit(hi))
            total = total + (middle - MIN_RATE) * (b - a) - swing * (F.cos(b) - F.cos(a))
        return total

    def events(d: Column) -> Column:
        angle = F.pmod(d, F.lit(float(period_s))) * (turn / period_s)
        turns = F.floor(d / period_s)
        return MIN_RATE * d + (turns * above(F.lit(turn)) + above(angle)) * (period_s / turn)

    return Profile(rate, events)


PROFILES: dict[str, Callable[..., Profile]] = {
    "steady": steady,
    "burst": burst,
    "ramp_up": ramp_up,
    "ramp_down": ramp_down,
    "spike": spike,
    "sinusoidal": sinusoidal,
}


def load_profile(kind: str, elapsed: Column, **params) -> Column:
    """Rate of profile ``kind`` at ``elapsed`` seconds, never below ``MIN_RATE``."""
    if kind not in PROFILES:
        raise ValueError(f"unknown profile {kind!r}; choose one of {', '.join(PROFILES)}")
    return floored(PROFILES[kind](**params))(elapsed)


def floored(profile: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda elapsed: F.greatest(profile(elapsed).cast("double"), F.lit(MIN_RATE))


def mean_rate(profile: Profile, duration_s: Column) -> Column:
    """Mean of a profile over a run; over a run without length, its rate at the start."""
    start = floored(profile)(F.lit(0.0))
    return F.when(duration_s > 0, profile.events(duration_s) / duration_s).otherwise(start)
