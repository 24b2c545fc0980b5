"""Imports every query module, so that the registry is full."""

from checks import feature_queries, model_queries, price_queries, silver_queries, source_queries  # noqa: F401

FLAGSHIP = "silver"
