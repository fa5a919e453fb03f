"""Importing this module registers every query."""

import importlib
import pkgutil

from isoquilt import plans
from isoquilt.plans.registry import ORACLES, QUERIES

for _module in pkgutil.iter_modules(plans.__path__):
    if _module.name.startswith("queries_"):
        importlib.import_module(f"isoquilt.plans.{_module.name}")

__all__ = ["ORACLES", "QUERIES"]
