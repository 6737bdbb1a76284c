"""Importing this package fills the registry."""

from sunledger.plans.queries import features, forecasts, ingest, quality, rollups, shaping  # noqa: F401
