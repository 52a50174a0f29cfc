"""The registered queries and the SQL each one is compared with."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("cleaning", "dates", "fitting", "splitting", "evaluation", "io", "synthesis", "modelling", "boosting")


def all_queries():
    """(queries, oracles), after loading every module that registers some."""
    for module in _MODULES:
        import_module(f"checks.{module}")
    from checks.registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
