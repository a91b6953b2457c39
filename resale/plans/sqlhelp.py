"""Small helpers for writing the oracle SQL with the same output types as the Spark side."""

from __future__ import annotations


def R(expr: str, alias: str, d: int = 4) -> str:
    """Double rounded like :func:`resale.functions.exprs.finalize`."""
    scale = 10**d
    return f"(round(CAST({expr} AS DOUBLE) * {scale}) / {scale} + 0.0) AS {alias}"


def D(expr: str, alias: str) -> str:
    """Nullable integer values, output as double on both sides."""
    return R(expr, alias)


def I(expr: str, alias: str) -> str:  # noqa: E743
    return f"CAST({expr} AS BIGINT) AS {alias}"


def S(expr: str, alias: str) -> str:
    return f"CAST({expr} AS VARCHAR) AS {alias}"
