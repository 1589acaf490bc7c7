"""Sweep, seed and temperature parameters, parsed on the driver."""

from __future__ import annotations

import re
from dataclasses import dataclass

GAS_CONSTANT = 0.001987
DEFAULT_TEMPERATURE = 37.0


def thermal_energy(temperature: float = DEFAULT_TEMPERATURE) -> float:
    """RT in kcal/mol at a temperature in degrees Celsius."""
    return GAS_CONSTANT * (temperature + 273.15)


@dataclass(frozen=True)
class Config:
    """One way of altering energies: a clamp (alpha, gamma), a scale (theta), or neither."""

    alpha: float = 1.0
    gamma: float = 1.0
    theta: float | None = None

    @property
    def suffix(self) -> str:
        if self.theta is not None:
            return f":theta={self.theta}"
        return "" if self.alpha == self.gamma == 1.0 else f":alpha={self.alpha},gamma={self.gamma}"

    @property
    def title(self) -> str:
        return f"theta={self.theta}" if self.theta is not None else f"alpha={self.alpha} and gamma={self.gamma}"


def numbers(text: str | None) -> list[float]:
    """Floats parted by semicolons."""
    return [float(x) for x in (text or "").split(";") if x.strip()]


def sweep(alpha: str = "1.0", gamma: str = "1.0", theta: str = "") -> list[Config]:
    """The base, then thetas, then (alpha, gamma) pairs with alpha <= gamma, each once."""
    configs = [Config()] + [Config(theta=t) for t in numbers(theta)]
    configs += [Config(a, g) for a in numbers(alpha) for g in numbers(gamma) if a <= g]
    return list(dict.fromkeys(configs))


def seed_spec(spec: str) -> tuple[int | None, int | None, int]:
    """``l``, ``n:m/l`` or ``n:m`` as (start, end, length); places are 1-based, ends included."""
    if found := re.fullmatch(r"\s*/?(\d+)\s*", spec):
        return None, None, int(found[1])
    if found := re.fullmatch(r"\s*(\d+):(\d+)(?:/?(\d+))?\s*", spec):
        start, end = int(found[1]), int(found[2])
        return start, end, int(found[3]) if found[3] else end - start + 1
    raise ValueError(f"not a seed: {spec!r}; give l, n:m or n:m/l")


# Names of the energy matrices.
MATRICES = ("t04", "t99", "slh04", "s95-rna-dna", "s95-dna-rna")


def check_seed(start: int | None, end: int | None, length: int, matrix: str = "t04") -> None:
    if (start is None) != (end is None):
        raise ValueError("give both the start and the end of the seed window, or neither")
    if start is not None and (start < 1 or end < start or length > end - start + 1):
        raise ValueError(f"a seed of {length} does not fit places {start} to {end}")
    if length < 1:
        raise ValueError("a seed has one base at least")
    if matrix not in MATRICES:
        raise ValueError(f"unknown energy matrix {matrix!r}; known are {', '.join(MATRICES)}")
