"""Registered queries: one per operator of the survey's inventory.

Importing this package imports every plan module, which registers its
queries in ``registry.QUERIES`` / ``registry.ORACLES``.
"""

from importlib import import_module

from plotwise.plans.registry import ORACLES, QUERIES

_MODULES = (
    "flagship", "scans", "cleaning", "validation", "joins", "aggregates",
    "windows", "geometry", "transit", "shapes", "graph", "clustering",
    "modelling", "evaluation",
)

for _m in _MODULES:
    import_module(f"plotwise.plans.{_m}")


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)
