"""Imports every catalog module so that all queries are registered."""

from __future__ import annotations

import importlib

MODULES = (
    "strata.plans.catalog_core",
    "strata.plans.catalog_models",
    "strata.plans.catalog_io",
    "strata.plans.catalog_gov",
    "strata.plans.catalog_session",
    "strata.plans.catalog_stream",
    "strata.plans.catalog_text",
    "strata.plans.catalog_ml",
)


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(m)
