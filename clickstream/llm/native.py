"""Native (JVM-side) expression helpers."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: ASCII white space as a regular expression class, and as characters.
WS_CLASS = r"\x20\x09-\x0D"
WS_CHARS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A column used inside a lambda can be inlined there and so computed for every element;
    a lambda variable cannot.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by the logistic-polynomial approximation (error below 2e-4)."""
    z = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    return 1.0 / (1.0 + F.exp(0.07056 * F.pow(z, 3) + 1.5976 * z))


def far_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, within 0.3 % of itself in the far tail too (Borjesson and Sundberg's form)."""
    z = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    x = F.abs(z)
    upper = F.exp(-x * x / 2) / (math.sqrt(2 * math.pi) * (0.661 * x + 0.339 * F.sqrt(x * x + 5.510)))
    return F.when(z < 0, 1 - upper).otherwise(upper)
