"""The library applied to the driver's tables, with comparison SQL."""

from importlib import import_module

MODULES = ("ingest", "cleaning", "star", "views", "questions", "derived", "quality")


def load_all() -> None:
    for name in MODULES:
        import_module(f"workload.{name}")
