"""Registered queries and their DuckDB check SQL."""

import importlib

from pyspark import cloudpickle

import sigloom

MODULES = ["selection", "grounding", "texts", "people", "jobs"]


def load() -> None:
    """Import all query modules.  Python functions travel by value, so workers need no installed package."""
    cloudpickle.register_pickle_by_value(sigloom)
    for m in MODULES:
        importlib.import_module(f"sigloom.registry.{m}")
