"""Every operator bound to the sample tables.  Importing this package fills the registry."""

import importlib

from martloom.catalog.registry import ORACLES, QUERIES

for _module in ("sources", "projections", "joins", "aggregates", "windows", "functions", "streams", "vault", "marts", "statistics", "models"):
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["ORACLES", "QUERIES"]
