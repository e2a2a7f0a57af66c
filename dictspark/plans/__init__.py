"""Registered queries over the test tables, each with the SQL that must give the same rows."""

from importlib import import_module
from pkgutil import iter_modules


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for module in iter_modules(__path__):
        if module.name.endswith("_queries"):
            import_module(f"{__name__}.{module.name}")
