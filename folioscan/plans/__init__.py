"""End-to-end plans built from the operators, and the registered queries."""

from importlib import import_module

# Modules that register queries.
QUERY_MODULES = ["extraction", "catalogue", "assets", "ingestion"]


def load() -> None:
    for name in QUERY_MODULES:
        import_module(f"folioscan.plans.{name}")
