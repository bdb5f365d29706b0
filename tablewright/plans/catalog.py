"""Imports every query module, so that all queries are registered."""

from importlib import import_module

MODULES = (
    "sourcing", "projections", "joining", "aggregation", "ranking", "setting", "scalars", "modification",
    "maintaining", "nesting", "checking",
)

for _name in MODULES:
    import_module(f"tablewright.plans.{_name}")

from tablewright.plans.registry import REGISTRY  # noqa: E402

__all__ = ["REGISTRY"]
