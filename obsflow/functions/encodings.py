"""SQL expressions for time and position features (text in, text out)."""

from __future__ import annotations

import math


def as_timestamp(text: str) -> str:
    """Text to timestamp in the session time zone; null when it is not one."""
    return f"try_cast({text} AS TIMESTAMP)"


def cyclic(value: str, period: float, name: str, pi: float = math.pi) -> list[str]:
    """``<name>_sin`` and ``<name>_cos`` of a value that repeats every ``period``.

    The angle per unit is folded here, so each row costs one multiplication.
    """
    angle = f"{value} * {2.0 * pi / period!r}D"
    return [f"sin({angle}) AS {name}_sin", f"cos({angle}) AS {name}_cos"]


def unit_sphere(latitude: str, longitude: str, prefix: str = "geo") -> list[str]:
    """A position in degrees as x, y, z on the unit sphere."""
    phi, lam = f"radians({latitude})", f"radians({longitude})"
    return [
        f"cos({phi}) * cos({lam}) AS {prefix}_x",
        f"cos({phi}) * sin({lam}) AS {prefix}_y",
        f"sin({phi}) AS {prefix}_z",
    ]
