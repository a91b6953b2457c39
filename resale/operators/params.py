"""Learned processing parameters (E-04).

All parameters are exact quantiles of the train rows
(:mod:`resale.operators.quantiles`): a 1-row frame, joined back by broadcast
(the 1-row bound is proven by construction).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resale.functions import constants as K
from resale.operators import quantiles

PARAM_COLUMNS = ["mileage_cap", "price_floor", "price_cap", "median_mileage", "median_engine_power", "median_age"]


def learn(train: DataFrame) -> DataFrame:
    """1-row frame of winsor caps and imputation medians, from train rows only."""
    return quantiles.wide(train, {
        "mileage_cap": ("mileage", K.MILEAGE_CAP_Q), "price_floor": ("price", K.PRICE_FLOOR_Q), "price_cap": ("price", K.PRICE_CAP_Q),
        "median_mileage": ("mileage", 0.5), "median_engine_power": ("engine_power", 0.5), "median_age": ("age_raw", 0.5),
    })


def attach(df: DataFrame, params: DataFrame) -> DataFrame:
    """Add the parameter columns to every row (broadcast of a 1-row frame)."""
    return df.crossJoin(F.broadcast(params.select(*PARAM_COLUMNS)))


def columns() -> dict[str, Column]:
    return {c: F.col(c) for c in PARAM_COLUMNS}
