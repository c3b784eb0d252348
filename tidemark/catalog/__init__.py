"""Named queries over the given tables."""

from tidemark.catalog.base import CATALOG, Tables
from tidemark.catalog import (  # noqa: F401  (importing registers the queries)
    ingest, features, products, reporting, trust, timeseries, models,
    lifecycle, analysis,
)

__all__ = ["CATALOG", "Tables"]
