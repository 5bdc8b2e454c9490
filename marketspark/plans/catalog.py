"""Imports every query module so that the registry is complete."""

from marketspark.plans import (  # noqa: F401
    catalog_bars,
    catalog_features,
    catalog_models,
    catalog_streams,
    catalog_trades,
)
from marketspark.plans.registry import QUERIES

__all__ = ["QUERIES"]
