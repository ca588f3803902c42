"""Importing this module registers every query."""

from riskloom.plans import (  # noqa: F401
    catalog_clean,
    catalog_drift,
    catalog_features,
    catalog_metrics,
    catalog_models,
    catalog_profile,
    catalog_runs,
    catalog_sampling,
    catalog_sources,
    catalog_trees,
)
from riskloom.plans.registry import ORACLES, QUERIES  # noqa: F401
