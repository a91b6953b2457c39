"""Small numeric helpers used on tiny result rows (never on row data).

No SciPy is available, so the F-distribution tail is computed from the
regularised incomplete beta function (its continued fraction),
and normal quantiles come from :class:`statistics.NormalDist`.
"""

from __future__ import annotations

import math
from statistics import NormalDist


#: Terms of the continued fraction; its truncation error is far below a double's precision where it is used.
TERMS = 400


def _fraction(a: float, b: float, x: float) -> float:
    """1 / (1 + d1 / (1 + d2 / ...)), the continued fraction of the incomplete beta function, from its last term inwards."""

    def term(k: int) -> float:
        m = k // 2
        if k % 2:
            return -(a + m) * (a + b + m) * x / ((a + k - 1) * (a + k))
        return m * (b - m) * x / ((a + k - 1) * (a + k))

    value = 1.0
    for k in range(TERMS, 0, -1):
        value = 1.0 + term(k) / value
    return 1.0 / value


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, 1.0 - x) / b


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f) for an F(d1, d2) variable."""
    if f is None or d1 is None or d2 is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def normal_quantiles(probs: list[float]) -> list[float]:
    nd = NormalDist()
    return [nd.inv_cdf(p) for p in probs]
