"""Queries over the test tables; importing the package fills the registry."""

import importlib
import pkgutil

from tidemark.plans.registry import REGISTRY, Tables, run

for _m in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.startswith("q_")):
    importlib.import_module(f"{__name__}.{_m}")

__all__ = ["REGISTRY", "Tables", "run"]
