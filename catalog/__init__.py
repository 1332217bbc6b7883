"""Queries over the given tables, each next to the SQL it is checked against."""

from importlib import import_module

MODULES = ["spans", "tables", "texts", "trees", "taggings", "layouts", "loads", "storage"]


def load_all() -> None:
    """Import every catalog module so that its queries are registered."""
    for name in MODULES:
        import_module(f"catalog.{name}")
