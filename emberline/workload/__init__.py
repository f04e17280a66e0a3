"""Every operator as a query over the test tables, with its SQL twin."""

from __future__ import annotations

from importlib import import_module

MODULES = ["cleaning", "features", "areas", "dashboard", "scenario", "monitoring", "gate", "storage", "learning", "streams"]


def load():
    """Import every query module and return the registry."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")
